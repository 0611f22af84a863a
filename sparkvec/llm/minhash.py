"""Near-duplicate documents: one-permutation hashing, banded buckets, star edges.

A document's set holds its distinct shingles of five words (fewer words: the whole
sequence as one). One hash per shingle gives both a bin and a value; the smallest
value of each bin is the sketch, and an empty bin copies the bin that its own
sequence of random bins meets first, so every bin of two sets agrees with a chance
equal to their Jaccard similarity however small the sets are. Bands of bins are the
bucket keys.

Bounded pairs: documents with equal sets form one class and only the class's
smallest id goes on. A bucket gives star edges from its smallest id to the others,
never all its pairs. Each edge is confirmed on the full sets. A second pass looks
only at buckets whose members are still in different components, and tests the
members outside the bucket's largest component against the rest. So a pair that
shares a bucket is tested or already connected: nothing is capped, and a bucket of
copies costs its size. The second pass compares sets inside its tasks, in blocks of
bounded size, and only links leave them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import components
from .text import chunks, mix, utf8, word_hashes

SHINGLE = 5
#: Rows of a band and number of bands: at similarity 0.85 a pair shares no bucket with chance 3e-6.
ROWS, BANDS = 8, 40
#: Smallest similarity as a fraction of integers.
NUMERATOR, DENOMINATOR = 85, 100
_STEPS = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x589965CC75374CC3], np.uint64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words, first = word_hashes(*utf8(column))
    steps = _STEPS if size == len(_STEPS) else mix(np.arange(1, size + 1, dtype=np.uint64) * _STEPS[0]) | np.uint64(1)
    grams = np.zeros(0, np.uint64)
    if len(words) >= size:
        grams = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            grams += words[k : len(words) - size + 1 + k] * steps[k]
        grams = mix(grams)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = (words[a:b] * steps[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values for each set; no set may be empty."""
    out = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for i, s in enumerate(sets):
        at = ((s >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))  # sorted hashes: a bin's first is its smallest
        out[i, at[first]] = s[first]
        full[i, at[first]] = True
    # Densification: attempt t of bin b looks at a bin that depends on (b, t) alone.
    row, col = np.nonzero(~full)
    attempt = 1
    while len(row):
        probe = mix(col.astype(np.uint64) + np.uint64(bins * attempt))
        there = (probe % np.uint64(bins)).astype(np.int64)
        hit = full[row, there]
        out[row[hit], col[hit]] = out[row[hit], there[hit]]
        row, col = row[~hit], col[~hit]
        attempt += 1
    return out


def band_keys(values: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch; the band's number is part of it."""
    parts = mix(values.reshape(len(values), bands, rows))
    salt = mix(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    keys = (parts * salt).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _least(size: int, numerator: int, denominator: int) -> int:
    """Sets below this size link only with equal sets: one element more or less is too much."""
    n = 1
    while n * denominator < numerator * (n + 1):
        n += 1
    return max(n, size)


def _sketcher(rows: int, bands: int, least: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "text"):
                batch = whole.slice(a, b - a)
                sets = shingle_sets(batch.column("text"))
                n = np.array([len(s) for s in sets], np.int64)
                f1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                f2 = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1))) if len(s) else 0 for s in sets], np.uint64)
                large = np.flatnonzero(n >= least)
                keys = band_keys(sketch([sets[i] for i in large], rows * bands), rows, bands)
                lengths = np.where(n >= least, bands, 0)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(keys.reshape(-1).view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), listed],
                    schema=schema,
                )

    return run


def _confirmer(numerator: int, denominator: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)  # a star's centre comes many times in a row
        for whole in batches:
            for lo, hi in chunks(whole, "text_b"):
                batch = whole.slice(lo, hi - lo)
                left, keep = batch.column("text_a"), []
                for i, s in enumerate(shingle_sets(batch.column("text_b"))):
                    text = left[i].as_py()
                    if last[0] != text:
                        last = (text, shingle_sets(pa.array([text], pa.string()))[0])
                    t = last[1]
                    if min(len(s), len(t)) * denominator < numerator * max(len(s), len(t)):
                        continue
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if both and both * denominator >= numerator * (len(s) + len(t) - both):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))],
                    schema=schema,
                )

    return run


def _confirm(pairs: DataFrame, texts: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    one = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    two = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    joined = pairs.join(one, "b").join(two, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_confirmer(numerator, denominator), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks the row
    whose id it is. Texts that are null, empty or white space have an empty set and
    link with nothing. Rows that repeat an id are one node with all their texts; a row
    without an id keeps its count, with null as component and false as ``kept``.
    Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spec = "doc_id long, n long, f1 long, f2 long, keys array<long>"
    sketched = settle(docs.mapInArrow(_sketcher(rows, bands, _least(2, numerator, denominator)), spec))
    filled = sketched.where("n > 0 and doc_id is not null")
    # Equal sets have equal keys, so a class takes any member's.
    classes = settle(
        filled.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id"), F.any_value("keys").alias("keys"))
    )
    rows_ = classes.select("id", F.col("n").cast("int").alias("n"), F.explode("keys").alias("key"))
    centres = rows_.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("far")).where("centre < far")
    members = settle(rows_.join(centres.select("key", "centre"), "key"))
    pairs = members.where("centre < id").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    texts = settle(docs.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    links = settle(_confirm(pairs, texts, numerator, denominator))
    found = components(links)
    links = links.unionByName(settle(_second_pass(members, found, texts, numerator, denominator)))
    found = components(links)

    labels = classes.select("f1", "f2", "n", "id").join(found, "id", "left").select(
        "f1", "f2", "n", F.coalesce("component", "id").alias("label")
    )
    return (
        sketched.select("doc_id", "n", "f1", "f2")
        .join(labels, ["f1", "f2", "n"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


#: Rows of one side of a block, and words of their sets.
BLOCK_ROWS, BLOCK_WORDS = 1024, 2_000_000


def _second_pass(members: DataFrame, found: DataFrame, texts: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links between the components of each bucket that still has several.

    The members outside the bucket's largest component meet all its members that belong
    to other components. A block holds a part of the former and a part of all; a bucket
    has as many blocks as its size asks for.
    """
    labelled = members.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("label"))
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("size"), F.sum("n").alias("words"))
    largest = F.struct("size", -F.col("label"))
    open_ = (
        sizes.groupBy("key")
        .agg(
            F.max_by("label", largest).alias("main"),
            F.max_by("words", largest).alias("main_words"),
            F.max("size").alias("main_size"),
            F.count("*").alias("labels"),
            F.sum("size").alias("size"),
            F.sum("words").alias("words"),
        )
        .where("labels > 1")
        .select("key", "main", _blocks("size", "words").alias("of_all"), _blocks("size - main_size", "words - main_words").alias("of_odd"))
    )
    rows = settle(labelled.join(open_, "key"))
    used = rows.select(F.col("id").alias("doc_id")).distinct()
    sets = texts.join(used, "doc_id", "left_semi").mapInArrow(_set_maker, "id long, shingles binary")
    odd = rows.where("label <> main").select(
        "key",
        F.pmod(F.xxhash64("id"), "of_odd").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("of_all") - 1)).alias("j"),
        F.lit(True).alias("odd"),
        "id",
        "label",
        "main",
    )
    rest = rows.select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("of_odd") - 1)).alias("i"),
        F.pmod(F.xxhash64("id"), "of_all").alias("j"),
        F.lit(False).alias("odd"),
        "id",
        "label",
        "main",
    )
    blocks = odd.unionByName(rest).join(sets, "id").groupBy("key", "i", "j")
    return blocks.applyInArrow(_block_linker(numerator, denominator), "a long, b long").distinct()


def _blocks(rows: str, words: str) -> Column:
    return F.expr(f"cast(greatest(1, ceil(({rows}) / {BLOCK_ROWS}), ceil(({words}) / {BLOCK_WORDS})) as int)")


def _set_maker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a, b in chunks(whole, "text"):
            part = whole.slice(a, b - a)
            sets = pa.array([s.tobytes() for s in shingle_sets(part.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], names=["id", "shingles"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set.

    Products of 0/1 matrices over the elements that both sides hold, some columns at a
    time, so memory follows the block and not the number of elements.
    """
    counts = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        sides.append((row, np.concatenate(sets) if sets else np.zeros(0, np.uint64)))
    shared = np.intersect1d(sides[0][1], sides[1][1])
    sides = [(row[k], np.searchsorted(shared, x[k])) for row, x in sides for k in [np.isin(x, shared)]]
    sides = [(row[o], x[o]) for row, x in sides for o in [np.argsort(x, kind="stable")]]
    for start in range(0, len(shared), columns):
        mats = []
        for (row, x), sets in zip(sides, (left, right), strict=True):
            a, b = np.searchsorted(x, [start, start + columns])
            mat = np.zeros((len(sets), columns), np.float32)
            mat[row[a:b], x[a:b] - start] = 1
            mats.append(mat)
        counts += mats[0] @ mats[1].T
    return np.rint(counts).astype(np.int64)


def _block_linker(numerator: int, denominator: int):
    def run(table: pa.Table) -> pa.Table:
        odd = table["odd"].to_numpy(zero_copy_only=False)
        ids, labels, main = (table[c].to_numpy() for c in ("id", "label", "main"))
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"]]
        left, right = np.flatnonzero(odd), np.flatnonzero(~odd)
        both = overlaps([sets[i] for i in left], [sets[i] for i in right])
        n = np.array([len(s) for s in sets], np.int64)
        union = n[left][:, None] + n[right][None, :] - both
        # A pair of two odd members is looked at once, from its smaller id.
        apart = labels[left][:, None] != labels[right][None, :]
        once = (labels[right] == main[right])[None, :] | (ids[left][:, None] < ids[right][None, :])
        a, b = np.nonzero((both * denominator >= numerator * union) & apart & once)
        # One link to each other component is enough to join the two.
        _, first = np.unique(np.stack([a, labels[right][b]]), axis=1, return_index=True)
        a, b = a[first], b[first]
        return pa.table({"a": ids[left][a], "b": ids[right][b]})

    return run
