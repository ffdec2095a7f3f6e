"""Operators that prepare documents for language-model training, one module each."""
