"""Errors that callers can tell apart."""

from __future__ import annotations


class QueryError(ValueError):
    """A query that cannot be planned, such as one with an unknown operator."""


class ValidationError(ValueError):
    """A write that breaks a constraint; `paths` names the fields."""

    def __init__(self, message: str, paths: list[str]):
        super().__init__(message)
        self.paths = paths


class ConflictError(RuntimeError):
    """A write that lost against concurrent ones in every attempt."""
