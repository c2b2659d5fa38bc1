"""Lazy DataFrame operators. None of them starts a session, reads the clock or collects data."""
