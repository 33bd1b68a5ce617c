"""Nothing of its own: the session is the one of tests/conftest.py."""
