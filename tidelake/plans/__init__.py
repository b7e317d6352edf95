"""Logical query plans and the planning of loads."""
