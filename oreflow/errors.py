"""Exceptions a run can end with."""


class FlowError(Exception):
    """Base class of every error raised by this package."""


class SchemaError(FlowError):
    """A required column is missing from a source."""


class IngestionError(FlowError):
    """A source file or table is not there or cannot be read."""


class CommitConflict(Exception):
    """Other writers committed first, again and again."""
