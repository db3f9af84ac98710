"""Puts the repository on the path of tests, however pytest is called."""
