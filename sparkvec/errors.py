"""Result codes of per-document writes and the exceptions for misuse.

Data problems never raise: they become rows with a ``code`` and a ``message``.
Only a wrong call (bad schema, missing collection, unsafe filter) raises.
"""

# The code names callers match on.
OK = "ok"
CODES = (
    OK,
    "invalid_argument",
    "failed_precondition",
    "not_found",
    "already_exists",
    "permission_denied",
    "resource_exhausted",
    "unavailable",
    "not_supported",
    "internal_error",
    "unknown",
)


class CollectionError(Exception):
    """Base class; ``code`` is one of :data:`CODES`."""

    code = "unknown"


class InvalidArgument(CollectionError, ValueError):
    code = "invalid_argument"


class FailedPrecondition(CollectionError):
    code = "failed_precondition"


class NotFound(CollectionError):
    code = "not_found"


class AlreadyExists(CollectionError):
    code = "already_exists"


class NotSupported(CollectionError):
    code = "not_supported"
