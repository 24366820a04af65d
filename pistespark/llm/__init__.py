"""Operators for preparing training text: the ten numbered ones, and nothing that the rest of the library needs."""
