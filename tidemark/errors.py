"""The one exception type for problems that are not data-quality findings."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

#: What a failing read or write raises; Java exceptions that PySpark does not translate included.
ENGINE_ERRORS = (PySparkException, Py4JJavaError)


class InputError(Exception):
    """A parameter or input problem: nothing could be checked (verdict code 2).

    ``details`` is a frame with all findings, where the message can only name a few.
    """

    code = 2

    def __init__(self, message: str, details=None):
        super().__init__(message)
        self.details = details
