"""Operators: pure DataFrame-to-DataFrame functions."""
