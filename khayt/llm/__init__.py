"""Operators for training data, by problem; nothing outside this package imports it."""
