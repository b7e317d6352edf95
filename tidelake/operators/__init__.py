"""Relational operators of loads and checks."""
