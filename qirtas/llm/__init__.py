"""Operators on large collections of text for training data. Nothing else in the library imports this subpackage."""
