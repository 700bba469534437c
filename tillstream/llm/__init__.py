"""Operators over text collections for language-model training data."""
