"""Column functions and vectorized scalar functions."""
