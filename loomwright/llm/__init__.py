"""Operators for training text and learned matching. Nothing outside this package imports it."""
