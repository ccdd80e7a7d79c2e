"""Typed errors raised by the jobs."""

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

# What a failing Spark action raises: most Java errors are translated, a few,
# such as an unknown file system, are not.
SPARK_ERRORS = (PySparkException, Py4JError)


class MillraceError(RuntimeError):
    """Base class."""


class EmptySource(MillraceError):
    """A source path is absent or holds no rows."""


class NothingIngested(MillraceError):
    """Every dataset of an ingest run was skipped or failed."""


class BadRegistry(MillraceError):
    """An ingest registry entry is not a (reference, short name) tuple."""


class TableMoved(MillraceError):
    """Another writer committed first what this one was about to change."""


class SchemaChanged(MillraceError):
    """Rows for a table have another type in one of its columns."""


class ScratchNotConfigured(MillraceError):
    """A cluster session names no shared folder in spark.checkpoint.dir."""


class ValidationFailed(MillraceError):
    """A gate found failed checks; ``failed`` holds their report rows."""

    def __init__(self, failed):
        self.failed = failed
        names = ", ".join(f"{r['check']}({r['column']})" for r in failed)
        super().__init__(f"failed checks: {names}")
