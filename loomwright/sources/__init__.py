"""Readers for the formats a catalog build takes in."""
