"""Errors a pipeline stage reports to its caller, and those a failed Spark job raises."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# Some causes of a failed job, such as an unreadable file, reach Python unconverted.
JOB_ERRORS = (PySparkException, Py4JJavaError)


class StageError(ValueError):
    """A stage refused its input or could not verify its output."""


class MissingUpstreamError(StageError):
    """A table that an earlier stage publishes does not exist yet."""


class SourceError(StageError):
    """A source file is missing, unreadable or not shaped as agreed."""
