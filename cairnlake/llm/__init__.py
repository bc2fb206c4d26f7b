"""Operators on text and terms for training data; nothing outside this package imports it."""
