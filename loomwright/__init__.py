"""Catalog analytics as composable DataFrame-to-DataFrame functions on the public Spark API."""
