"""Named queries over the driver tables, each beside its ANSI SQL twin."""
