"""Operators that prepare documents as training data."""
