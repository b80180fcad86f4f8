"""Errors that stop a run before anything is published."""


class ChangeDataError(Exception):
    """Base class of every error raised by this package."""


class IncompleteChange(ChangeDataError):
    """A change holds one half of an update pair without the other."""


class LogGap(ChangeDataError):
    """A bookmark points below the oldest log position still retained."""


class MissingPosition(ChangeDataError):
    """A log position that must exist (ceiling, low watermark) is absent."""


class OrderingNotReady(ChangeDataError):
    """Strict ordering was asked for, but a table has no command id."""


class ReservedColumn(ChangeDataError):
    """A captured column carries the name of a metadata field."""


class BookmarkConflict(ChangeDataError):
    """Another run has moved the same bookmarks, or holds the next version without finishing it."""


class MissingRows(ChangeDataError):
    """A snapshot is due, but the run was given no current rows of the table."""


class MissingTable(ChangeDataError):
    """No captured table matches what the run was told to read."""
