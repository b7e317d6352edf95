"""Identifiers and literals in SQL text."""

from __future__ import annotations


def quoted(name: str, mark: str = "`") -> str:
    """One identifier part in quotes; ``[`` quotes with brackets."""
    close = "]" if mark == "[" else mark
    return f"{mark}{name.replace(close, close * 2)}{close}"


def qualified(*parts: str, mark: str = "`") -> str:
    """Dotted parts, each quoted; a part may itself be a dotted namespace."""
    return ".".join(quoted(p, mark) for part in parts if part for p in part.split("."))


def text_literal(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def table_identifier(schema: str, table: str) -> str:
    """The lake's name of a source table."""
    return f"{schema.lower()}__{table.lower()}"
