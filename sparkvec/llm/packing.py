"""Packing token sequences: first-fit decreasing over a tournament tree of bin room.

Texts are tokenized where they are read; what moves is one narrow row per piece. A
document is cut only at multiples of the sequence length, so each piece but its last
fills a sequence alone. The last pieces are dealt to groups of a set number of
documents by a hash of their row, and each group is packed by itself: pieces from
long to short, each into the first bin with room. The tree holds the largest room of
each half, so the first fitting bin is found in as many steps as the tree is deep.
Groups are alike in size whatever ids or lengths the rows have.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .text import chunks

LENGTH = 2048
GROUP = 4096
VOCABULARY = "byte_bpe_50k.tiktoken"
END = 1
#: The mark that the vocabulary's JSON file adds as a special token; its id follows the last rank.
MARK = "<|endoftext|>"

# Encoding never looks across the start of a run of white space that follows another
# character, so a text is encoded as a chain of runs, and each distinct run once.
_RUNS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")
# White space as the vocabulary's pattern knows it. The pattern recurses in a run of a
# million; all of a run but the last character before a word is one piece, so long runs
# are encoded without it.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_REMEMBERED = 300_000


class Encoder(dict):
    """Run of text -> its ids as little-endian 32-bit bytes; remembers the first runs it meets.

    Reads a file of ranks, whose ids are those of the JSON file with the same
    vocabulary. The mark in a text is one special token in :meth:`whole`; runs and
    :meth:`ids` take text without marks.
    """

    _by_path: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.mark = np.array([max(ranks.values()) + 1], "<u4").tobytes()
        encoding = tiktoken.Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._encode, self._one_piece = encoding.encode_ordinary, encoding._encode_single_piece

    @classmethod
    def at(cls, vocabulary: str) -> Encoder:
        """The encoder of a file of ranks, or of a name that ``public_tokenizers`` knows."""
        if "/" not in vocabulary:
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        if vocabulary not in cls._by_path:
            cls._by_path[vocabulary] = cls(vocabulary)
        return cls._by_path[vocabulary]

    def direct(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def __missing__(self, run: str) -> bytes:
        ids = self.direct(run)
        if len(self) < _REMEMBERED and len(run) < 64:
            self[run] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text):
            return self.direct(text)
        return b"".join(map(self.__getitem__, _RUNS.findall(text)))

    def unmarked(self, text: str) -> bytes:
        """The ids of a text without marks, whatever white space it has."""
        out, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            out += [self.ids(text[at : run.start()]), np.array(self._one_piece(text[run.start() : stop]), "<u4").tobytes()]
            at = stop
        return b"".join([*out, self.ids(text[at:])])

    def whole(self, text: str) -> bytes:
        """The ids of a text: each part between marks is encoded by itself."""
        return self.mark.join(map(self.unmarked, text.split(MARK)))


def _piece_maker(vocabulary: str, length: int, end: int, keep_ids: bool):
    fields = [(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(vocabulary)
        for whole in batches:
            for a, b in chunks(whole, "text"):
                out: list[list] = [[] for _ in schema.names]
                part = whole.slice(a, b - a)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encoder.whole(text or "") + last
                    n = len(ids) // 4
                    for start in range(0, n, length):
                        piece = ids[4 * start : 4 * (start + length)]
                        row = [doc, start, len(piece) // 4, zlib.crc32(piece), n]
                        for column, value in zip(out, row + [np.frombuffer(piece, "<i4")] * keep_ids, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each item, items given from long to short."""
    n = max(1, len(lengths))
    leaves = 1 << (n - 1).bit_length()
    tree = [room] * (2 * leaves)  # tree[i] is the most room of any bin below node i
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for item, size in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, room - tree[node]
        tree[node] -= size
        node //= 2
        while node:
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
    return bins, offsets


def _packer(length: int, groups: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        bins, offsets = first_fit_decreasing(table["length"].to_numpy(), length)
        table = table.append_column("sequence_id", pa.array(bins * groups + key[0].as_py()))
        return table.append_column("offset", pa.array(offsets)).drop_columns(["grp", "row"])

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    end: int = END,
    group: int = GROUP,
    keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset)`` per piece.

    A document is its ids and then ``end``; a null or empty text is ``end`` alone. Every
    row of ``docs`` is a document of its own, also if its id is repeated or null. Each id
    lies in one piece; ``offset`` is the piece's place in its sequence, without gaps from
    0. ``ids_crc32`` is the checksum of the piece's ids as little-endian 32-bit numbers;
    ``keep_ids`` adds the ids. Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spec = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    pieces = settle(docs.mapInArrow(_piece_maker(vocabulary, length, end, keep_ids), spec))
    groups = max(1, -(-pieces.count() // group))
    # Read from files, a row keeps its number when a task runs again.
    dealt = pieces.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "grp", F.pmod(F.xxhash64("row"), F.lit(groups))
    )
    return dealt.groupBy("grp").applyInArrow(_packer(length, groups), spec + ", sequence_id long, offset long")
