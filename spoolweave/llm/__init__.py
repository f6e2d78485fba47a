"""Operators that prepare transcript text for language-model training data."""
