"""Exceptions raised before or during a sync."""


class ConfigurationError(ValueError):
    """An option or argument is missing, blank or still a placeholder."""


class EmptySourceError(RuntimeError):
    """A staged folder holds no data files and empty folders are not allowed."""


class MappingError(ValueError):
    """The staged columns cannot be mapped onto the declared target columns."""


class DuplicateKeyError(ValueError):
    """A row set that must be unique on its key holds a key twice."""


class CommitConflictError(RuntimeError):
    """Another writer committed the same version of a table first."""
