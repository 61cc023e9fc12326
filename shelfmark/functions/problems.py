"""What went wrong, in one line."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError


def first_cause(problem: Exception) -> str:
    """The first line of what went wrong at the bottom of a Java error, without its stack trace."""
    if isinstance(problem, Py4JJavaError):
        cause = problem.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        text = cause.getMessage() or cause.getClass().getName()
    else:
        text = str(problem)
    return next((line.strip() for line in text.splitlines() if line.strip()), type(problem).__name__)
