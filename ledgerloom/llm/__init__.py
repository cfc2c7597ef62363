"""Operators for training data and record matching; nothing else in the library imports this package."""
