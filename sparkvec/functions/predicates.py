"""Filters and default expressions given as text by a caller.

Spark's own expression parser does the parsing. Before it runs, the text is
held to the collection's columns and a list of side-effect-free functions,
because ``expr`` would otherwise accept subqueries and calls into the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument

# What a filter may contain besides column names and literals.
KEYWORDS = frozenset(
    "and or not in between like ilike rlike escape is null true false case when then else end "
    "cast as date timestamp string int integer bigint smallint tinyint float double boolean "
    "decimal binary array distinct".split()
)
FUNCTIONS = frozenset(
    "abs array array_contains array_max array_min array_position arrays_overlap cast ceil ceiling "
    "coalesce concat contains date date_add date_sub day decimal element_at endswith floor greatest "
    "if ifnull in isnan isnotnull isnull least left length lower ltrim month nullif nvl pmod pow "
    "power right round rtrim size sqrt startswith substr substring timestamp trim try_add "
    "try_cast try_divide try_element_at try_multiply try_subtract upper year and or not when then "
    "else between like".split()
)

_QUOTED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`""", re.S)
_WORD = re.compile(r"[^\W\d]\w*")
_NUMBER = re.compile(r"(?<![\w.])(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?:[lLdDfFsSyY]|[bB][dD])?(?!\w)")
_PLAIN = re.compile(r"[\s\w().,+\-*/%<>=!|&~\[\]]*\Z")


def guard(text: str, columns: Iterable[str]) -> str:
    """Return ``text`` if it is a plain expression over ``columns``."""
    if not isinstance(text, str) or not text.strip():
        raise InvalidArgument("expression must be a non-empty string")
    names = {c.lower() for c in columns}

    def literal(found: re.Match) -> str:
        quoted, before = found.group(), text[: found.start()][-1:]
        if before.isalnum() or before in ("_", "'", '"', "`"):
            # A prefix (as in r'..') would change where the literal ends.
            raise InvalidArgument("expression contains an unsupported literal")
        if quoted[0] == "`" and quoted[1:-1].lower() not in names:
            raise InvalidArgument(f"unknown column '{quoted[1:-1]}' in expression")
        return " 0 "

    rest = _QUOTED.sub(literal, text)
    if "--" in rest or "/*" in rest or not _PLAIN.match(rest):
        raise InvalidArgument("expression contains an unsupported character")
    rest = _NUMBER.sub(" 0 ", rest)
    for found in _WORD.finditer(rest):
        word = found.group().lower()
        called = rest[found.end() :].lstrip().startswith("(")
        if called and word not in FUNCTIONS:
            raise InvalidArgument(f"function '{word}' is not allowed in expression")
        if not called and word not in KEYWORDS and word not in names:
            raise InvalidArgument(f"unknown column '{word}' in expression")
    return text


def predicate(df: DataFrame, text: str | Column | None, columns: Iterable[str] | None = None) -> Column | None:
    """A filter column for ``df``; a Column is trusted and passed through."""
    if text is None or isinstance(text, Column):
        return text
    return F.expr(guard(text, df.columns if columns is None else columns))


def where(df: DataFrame, text: str | Column | None) -> DataFrame:
    condition = predicate(df, text)
    return df if condition is None else df.where(condition)


def blanked(text: str) -> str:
    """A guarded expression with its literals blanked, of the same length."""
    return _QUOTED.sub(lambda m: m.group() if m.group()[0] == "`" else " " * len(m.group()), text)


def names_in(text: str) -> set[str]:
    """The words of a guarded expression outside literals, in lower case."""
    return {m.group().lower() for m in _WORD.finditer(blanked(text).replace("`", " "))}
