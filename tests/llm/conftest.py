"""The session and its settings come from tests/conftest.py."""
