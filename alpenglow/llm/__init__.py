"""Operators for building and filtering training corpora."""
