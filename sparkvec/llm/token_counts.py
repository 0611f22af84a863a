"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie of bytes. A node whose text cannot be matched any further has a
failure link to the node that holds the rest of its text after the longest-match pieces
are taken off, and the number of those pieces. Reading a word follows trie edges, and
failure links where there is none, adding the stored numbers: each byte is read once and
no piece is built. A word stands behind a blank, as vocabularies write word starts, and
every byte is a piece, so all texts can be counted.

Counting needs nothing but the text: one pass, no shuffle. A task remembers the counts
of the first words it meets, a bounded number.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .text import chunks

VOCABULARY = "byte_bpe_50k.tiktoken"
MARK = b" "
_REMEMBERED = 300_000


def vocabulary(path: str) -> Iterable[bytes]:
    """The pieces of a file of ranks, or of a name that ``public_tokenizers`` knows."""
    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines]


class Automaton(dict):
    """Word -> its number of pieces; remembers the first words it is asked for."""

    _by_path: dict[str, Automaton] = {}

    def __init__(self, pieces: Iterable[bytes]):
        self._next: dict[int, int] = {}
        whole, above = [False], [(0, 0)]
        for piece in sorted({*pieces, *(bytes([b]) for b in range(256))} - {b""}):
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self._next:
                    self._next[key] = len(whole)
                    whole.append(False)
                    above.append((node, byte))
                node = self._next[key]
            whole[node] = True
        self._fail, self._popped = [0] * len(whole), [0] * len(whole)
        # A node comes after the one above it once they are ordered by depth.
        depth = [0] * len(whole)
        for node in range(1, len(whole)):
            depth[node] = depth[above[node][0]] + 1
        for node in sorted(range(1, len(whole)), key=depth.__getitem__):
            if whole[node]:
                self._fail[node], self._popped[node] = 0, 1
                continue
            parent, byte = above[node]
            popped, at = self._popped[parent], self._fail[parent]
            while at << 8 | byte not in self._next:  # the root has an edge for every byte
                popped, at = popped + self._popped[at], self._fail[at]
            self._fail[node], self._popped[node] = self._next[at << 8 | byte], popped

    @classmethod
    def at(cls, path: str) -> Automaton:
        if path not in cls._by_path:
            cls._by_path[path] = cls(vocabulary(path))
        return cls._by_path[path]

    def count(self, text: bytes) -> int:
        follow, fail, popped = self._next.get, self._fail, self._popped
        node = total = 0
        for byte in text:
            after = follow(node << 8 | byte)
            while after is None:
                total += popped[node]
                node = fail[node]
                after = follow(node << 8 | byte)
            node = after
        while node:
            total += popped[node]
            node = fail[node]
        return total

    def __missing__(self, word: bytes) -> int:
        n = self.count(MARK + word)
        if len(self) < _REMEMBERED and len(word) < 64:
            self[word] = n
        return n


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Automaton.at(path).__getitem__
        for whole in batches:
            for a, b in chunks(whole, "text"):
                part = whole.slice(a, b - a)
                words, tokens = [], []
                for text in pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist():
                    found = text.split()
                    words.append(len(found))
                    tokens.append(sum(map(of, found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.array(words, np.int64)), pa.array(np.array(tokens, np.int64))],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` for each row of ``docs``.

    Words are runs of bytes other than ASCII white space; a word is split greedily into
    the longest piece that fits, from its start mark on. Null and empty texts have none.
    Rows may repeat, ids may be of any type and null. Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spec = StructType([docs.schema["doc_id"]]).add("n_words", "long").add("n_tokens", "long")
    return docs.mapInArrow(_counter(path), spec)


def sql(path: str = VOCABULARY) -> str:
    """The same counts in DuckDB: words peel off their longest piece until none is left."""
    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    return f"""
        WITH RECURSIVE
        pieces AS MATERIALIZED (
            SELECT hex(from_base64(split_part(line, ' ', 1))) AS piece
            FROM (SELECT unnest(string_split(trim(content, chr(10)), chr(10))) AS line FROM read_text('{path}'))
        ),
        words AS MATERIALIZED (
            SELECT doc_id, w FROM (
                SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w FROM documents
            )
        ),
        peeled(w, rest, n) AS (
            SELECT DISTINCT w, '20' || hex(encode(w)), 0 FROM words
            UNION ALL
            SELECT p.w, substr(any_value(p.rest), 1 + max(length(piece))), any_value(p.n) + 1
            FROM (
                SELECT w, rest, n, unnest(range(2, least(length(rest), 256) + 1, 2)) AS size FROM peeled WHERE rest <> ''
            ) p JOIN pieces ON piece = substr(p.rest, 1, p.size)
            GROUP BY p.w
        ),
        counted AS (SELECT w, max(n) AS n FROM peeled GROUP BY w)
        SELECT d.doc_id, count(words.w) AS n_words, CAST(coalesce(sum(counted.n), 0) AS BIGINT) AS n_tokens
        FROM documents d LEFT JOIN words USING (doc_id) LEFT JOIN counted USING (w)
        GROUP BY d.doc_id
    """
