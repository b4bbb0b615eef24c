"""Relational operators of the presentation layer."""
