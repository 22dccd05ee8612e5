"""Operators: cleaning, features, profiling, distributions, encoding, split."""
