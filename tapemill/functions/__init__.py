"""Column functions and conditions."""
