"""Operators for model training data. Nothing outside this folder imports it."""
