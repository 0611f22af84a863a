"""Vector search and document tables on Spark DataFrames."""

from .errors import AlreadyExists, CollectionError, FailedPrecondition, InvalidArgument, NotFound, NotSupported
from .schema import Field, Index, Schema
from .sources.collection import Collection

__all__ = [
    "AlreadyExists",
    "Collection",
    "CollectionError",
    "FailedPrecondition",
    "Field",
    "Index",
    "InvalidArgument",
    "NotFound",
    "NotSupported",
    "Schema",
]
