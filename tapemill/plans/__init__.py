"""Promotions between layers, composed from the operators."""
