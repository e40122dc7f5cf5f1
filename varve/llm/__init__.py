"""Operators on training text; nothing outside this folder imports it."""
