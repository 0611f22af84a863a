"""Phrase collocations by set-oriented mining (SETM) over occurrence relations.

The relation of a length holds the frequent phrases that begin at each place, in order of
text piece and place, and is written once per length. It is kept as blocks: an array of a
million places in that order, with a gap where a piece ends or no frequent phrase
begins. For the next length the relation is merge-joined with itself on piece and adjacent
place: in sorted arrays these are neighbours. A phrase of k + 1 words is a pair of phrases
of k words that overlap in all but their ends, so only occurrences whose both halves are
frequent are extended.

Groups are counted inside their block before anything is shuffled, and are dealt to buckets
by a hash of their key, so that a block sends one row to each bucket: the keys and counts of
all its groups there, as packed columns. A bucket sums the counts of a group over all
blocks, drops it if it is not frequent, and numbers the rest; the semi-join sends each block
the numbers of its own groups, in the order in which they came. Buckets are as many as the
text is long, so none grows with the table; a phrase that a third of all places hold is one
entry for each block. No phrase table is broadcast by this module or collected, and no
count is approximate.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, settle, written
from .text import chunks, mix

LONGEST, LEAST, BEST = 4, 30, 2000
#: A phrase goes if a longer one with its words has this share of its occurrences, in percent.
COVERED = 80
SCALE = 2_000_000
#: Places of a block and of a step in it, places of a row, and bytes of a text taken apart at a time.
BLOCK, STEP, ROW, SLICE = 1 << 20, 1 << 18, 1 << 16, 1 << 20
#: Bytes of text for each bucket of groups.
BUCKET = 8 << 20
_END = b"."
#: Letters are folded; a tab becomes a blank, and all that ends a piece becomes one mark.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 9)


def _slices(text: bytes, most: int) -> Iterator[bytes]:
    """Parts of a folded text that end with a piece, or at least with a word."""
    at = 0
    while len(text) - at > most:
        stop = max(text.rfind(_END, at, at + most), 0) or max(text.rfind(b" ", at, at + most), 0)
        if stop <= at:
            ends = [x for x in (text.find(_END, at + most), text.find(b" ", at + most)) if x >= 0]
            stop = min(ends, default=len(text) - 1)
        yield text[at : stop + 1]
        at = stop + 1
    yield text[at:]


class _Block:
    """Places of one block, with its words numbered by language and word."""

    def __init__(self, number: int):
        self.number, self.size, self.parts = number, 0, []
        numbers = count()
        self.words: dict[str, defaultdict] = defaultdict(lambda: defaultdict(numbers.__next__, {_END: -1}))

    def add(self, lang: str, part: bytes) -> None:
        tokens = part.replace(_END, b" . ").split()
        self.parts.append(np.fromiter(map(self.words[lang].__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def rows(self, buckets: int) -> pa.RecordBatch:
        ids = np.concatenate([np.zeros(0, np.int32), *self.parts])
        names: list[bytes] = [b""] * sum(len(w) - 1 for w in self.words.values())
        bucket, langs, rank = (np.zeros(len(names), np.int64) for _ in range(3))
        for i, (lang, words) in enumerate(self.words.items()):
            held = sorted(w for w in words if w != _END)
            local = np.fromiter(map(words.__getitem__, held), np.int64, len(held))
            bucket[local] = np.fromiter(map(crc32, held, repeat(crc32(lang.encode()))), np.int64, len(held)) % buckets
            langs[local], rank[local] = i, np.arange(len(held))
            for j, w in zip(local.tolist(), held, strict=True):
                names[j] = w
        order = np.lexsort((rank, langs, bucket))  # in order of the words they are packed best
        number = np.full(len(names) + 1, -1, np.int32)  # the last is read by gaps
        number[order] = np.arange(len(order))
        ids = number[ids]
        seen = np.bincount(ids[ids >= 0], minlength=len(names))
        rows, known = _places(self.number, ids), list(self.words)
        for a, b in _runs(bucket[order] * len(known) + langs[order]):
            line = b" ".join([names[j] for j in order[a:b].tolist()])
            rows.append({
                "block": self.number, "bucket": int(bucket[order[a]]), "base": a, "n": b - a, "lang": known[langs[order[a]]],
                "words": pa.compress(line, "zstd", asbytes=True), "size": len(line), "seen": _pack(seen[a:b]), "total": int(seen[a:b].sum()),
            })
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


#: Rows of a block with its places in order, and rows with its groups in a bucket.
_ARROW = pa.schema({
    "block": pa.int64(), "part": pa.int32(), "n": pa.int32(), "ids": pa.binary(), "bucket": pa.int64(), "base": pa.int32(), "lang": pa.string(),
    "words": pa.binary(), "size": pa.int64(), "first": pa.binary(), "last": pa.binary(), "seen": pa.binary(), "total": pa.int64(),
})
_SCHEMA = (
    "block long, part int, n int, ids binary, bucket long, base int, lang string, words binary, size long, first binary, last binary, seen binary, total long"
)
#: Numbers of a block's groups, and the frequent groups themselves.
_NUMBERED = pa.schema({
    "block": pa.int64(), "base": pa.int32(), "n": pa.int32(), "ids": pa.binary(), "id": pa.int64(), "lang": pa.string(), "word": pa.string(),
    "first": pa.int64(), "last": pa.int64(), "a": pa.int64(),
})
_NUMBERS = "block long, base int, n int, ids binary, id long, lang string, word string, first long, last long, a long"


def _pack(values: np.ndarray, kind: str = "<i8") -> bytes:
    """Whole numbers, byte by byte of all of them, compressed."""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes, n: int, kind: str = "<i8") -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, n * size, "zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _unpacked(table: pa.Table, column: str) -> np.ndarray:
    parts = [_unpack(v, n) for v, n in zip(table[column].to_pylist(), table["n"].to_pylist(), strict=True)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the runs of equal values."""
    if not len(values):
        return []
    at = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(at[:-1], at[1:], strict=True))


def _places(block: int, ids: np.ndarray) -> list[dict]:
    """The rows of a block's places, each run of gaps as one gap."""
    gap = ids < 0
    ids = ids[~(gap & np.append(False, gap[:-1]))]
    parts = [ids[at : at + ROW] for at in range(0, max(len(ids), 1), ROW)]
    return [{"block": block, "part": i, "n": len(x), "ids": _pack(x + 1, "<i4")} for i, x in enumerate(parts)]


def _occurrences(places: int, most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        block = _Block(next(numbers))
        for whole in batches:
            for a, b in chunks(whole, "text"):
                part = whole.slice(a, b - a)
                texts = pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()
                for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
                    for piece in _slices(text.translate(_FOLD), most):
                        block.add(lang, piece)
                        if block.size >= places and piece.endswith(_END):
                            yield block.rows(buckets)
                            block = _Block(next(numbers))
                    block.add(lang, _END)
                if block.size >= places:
                    yield block.rows(buckets)
                    block = _Block(next(numbers))
        yield block.rows(buckets)

    return run


def _extender(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _extended(left, right, buckets)

    return run


def _extended(left: pa.Table, right: pa.Table, buckets: int) -> pa.Table:
    """The next relation of one block: pairs of neighbours whose both groups are frequent."""
    if not left.num_rows or not right.num_rows:
        return _ARROW.empty_table()
    block, left = left["block"][0].as_py(), left.sort_by("part")
    ids = np.concatenate([_unpack(v, n, "<i4") for v, n in zip(left["ids"].to_pylist(), left["n"].to_pylist(), strict=True)]) - 1
    width = int(ids.max(initial=-1)) + 1
    number = np.full(width + 1, -1, np.int64)
    for base, n, held in zip(right["base"].to_pylist(), right["n"].to_pylist(), right["ids"].to_pylist(), strict=True):
        number[base : base + n] = _unpack(held, n) - 1
    held = (number >= 0)[ids]  # a gap reads the last number, which is none
    both = held[:-1] & held[1:]

    def codes(a: int) -> np.ndarray:
        at = np.flatnonzero(both[a : a + STEP]) + a
        return ids[at].astype(np.int64) * width + ids[at + 1]

    # In steps, so that little more than the block itself is held.
    steps = range(0, len(both), STEP)
    pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.unique(codes(a)) for a in steps)]))
    # A group's place in the block is its place among those of its bucket, in order of their first phrases.
    first, last = number[pairs // width] if width else pairs, number[pairs % width] if width else pairs
    bucket = (mix(mix(first.astype(np.uint64)) + last.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((first, bucket))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    found, seen = np.full(len(ids), -1, np.int32), np.zeros(len(pairs), np.int64)
    for a in steps:
        place = rank[np.searchsorted(pairs, codes(a))]
        found[:-1][a : a + STEP][both[a : a + STEP]] = place
        seen += np.bincount(place, minlength=len(pairs))
    first, last, bucket = first[order], last[order], bucket[order]
    rows = _places(block, found)
    for a, b in _runs(bucket):
        packed = {"first": _pack(np.diff(first[a:b], prepend=0)), "last": _pack(last[a:b]), "seen": _pack(seen[a:b])}
        rows.append({"block": block, "bucket": int(bucket[a]), "base": a, "n": b - a, **packed})
    # Workers stay; what earlier blocks took goes back before the next stage needs it.
    pa.default_memory_pool().release_unused()
    return pa.Table.from_pylist(rows, schema=_ARROW)


def _summed(index: np.ndarray, groups: int, seen: np.ndarray, least: int, id_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id of each entry or -1, and which groups are frequent, with their counts."""
    a = np.zeros(groups, np.int64)
    np.add.at(a, index, seen)
    kept = np.flatnonzero(a >= least)
    number = np.full(groups, -1, np.int64)
    number[kept] = id_of(np.arange(len(kept)))
    return number[index], kept, a[kept]


def _numbers(table: pa.Table, ids: np.ndarray) -> pa.Table:
    """A row with the ids of its groups for each row of a bucket."""
    at = np.cumsum([0, *table["n"].to_pylist()])
    held = pa.array([_pack(ids[a:b] + 1) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
    return pa.table({"block": table["block"], "base": table["base"], "n": table["n"], "ids": held})


def _conformed(*tables: pa.Table) -> pa.Table:
    return pa.concat_tables([_NUMBERED.empty_table(), *tables], promote_options="default")


def _word_counter(least: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        bucket, done, out = table["bucket"][0].as_py(), 0, []
        table = table.sort_by("lang")
        langs = np.array(table["lang"].to_pylist(), object)
        for start, stop in _runs(langs):
            lang, part = langs[start], table.slice(start, stop - start)
            lines = [pa.decompress(w, size, "zstd", asbytes=True) for w, size in zip(part["words"].to_pylist(), part["size"].to_pylist(), strict=True)]
            words = pa.array(b" ".join(lines).split(b" "), pa.binary()).dictionary_encode()
            index = words.indices.to_numpy()
            ids, kept, a = _summed(index, len(words.dictionary), _unpacked(part, "seen"), least, lambda k, done=done: (k + done) * buckets + bucket)
            own = {"id": (np.arange(len(kept)) + done) * buckets + bucket, "word": words.dictionary.take(pa.array(kept)).cast(pa.string()), "a": a}
            out += [_numbers(part, ids), pa.table({**own, "lang": pa.array([lang] * len(kept), pa.string())})]
            done += len(kept)
        return _conformed(*out)

    return run


def _pair_counter(least: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        bucket, last = table["bucket"][0].as_py(), _unpacked(table, "last")
        first = np.concatenate([np.cumsum(_unpack(v, n)) for v, n in zip(table["first"].to_pylist(), table["n"].to_pylist(), strict=True)])
        heads, tails = first, last
        if int(first.max(initial=0)) >= (1 << 62) // (int(last.max(initial=0)) + 1):
            heads, tails = (np.unique(x, return_inverse=True)[1] for x in (first, last))
        _, at, index = np.unique(heads * (int(tails.max(initial=0)) + 1) + tails, return_index=True, return_inverse=True)
        ids, kept, a = _summed(index, len(at), _unpacked(table, "seen"), least, lambda k: k * buckets + bucket)
        own = pa.table({"id": np.arange(len(kept)) * buckets + bucket, "first": first[at[kept]], "last": last[at[kept]], "a": a})
        pa.default_memory_pool().release_unused()
        return _conformed(_numbers(table, ids), own)

    return run


def _frequent(relation: DataFrame, key: tuple[str, ...], least: int, buckets: int) -> tuple[DataFrame, str]:
    """``(block, base, n, ids)``: numbers of each block's groups, 0 for those that are not frequent over all blocks;
    and ``(id, key..., a)``: the frequent groups with their counts."""
    counter = _word_counter(least, buckets) if "word" in key else _pair_counter(least, buckets)
    columns = ("lang", "words", "size") if "word" in key else ("first", "last")
    dealt = relation.where("bucket is not null").select("block", "bucket", "base", "n", *columns, "seen").repartition(buckets, "bucket")
    return written(dealt.groupBy("bucket").applyInArrow(counter, _NUMBERS), "groups")


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """``(lang, n)``, and for each length the frequent phrases ``(id, lang, phrase, a, heads, tails, first, last)``.

    ``heads`` and ``tails`` count the phrase's first and last 1, 2, ... words, without the
    whole; ``first`` and ``last`` are the ids of the phrases one word shorter. A relation
    is removed when the next one is written.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    buckets = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET
    relation, path = written(texts.mapInArrow(_occurrences(BLOCK, SLICE, buckets), _SCHEMA), "words")
    totals = settle(relation.where("words is not null").groupBy("lang").agg(F.sum("total").alias("n")))
    levels, key = [], ("lang", "word")
    for size in range(1, longest + 1):
        groups, groups_path = _frequent(relation, key, least, buckets)
        counted = settle(groups.where("id is not null").select("id", *key, "a"))
        levels.append(settle(_described(counted, levels[-1])) if levels else _words(counted))
        following = None
        if size < longest:
            places = relation.where("part is not null").select("block", "part", "n", "ids").repartition(buckets, "block")
            numbers = groups.where("ids is not null").select("block", "base", "n", "ids").repartition(buckets, "block")
            following = written(places.groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(_extender(buckets), _SCHEMA), "phrases")
        for done in (path, groups_path):
            discard(spark, done)
        if following:
            (relation, path), key = following, ("first", "last")
    return totals, levels


def _words(counted: DataFrame) -> DataFrame:
    none = F.array().cast("array<long>")
    return counted.select(
        "id", "lang", F.col("word").alias("phrase"), "a", none.alias("heads"), none.alias("tails"), F.col("word").alias("end"),
        *(F.lit(None).cast("long").alias(c) for c in ("first", "last")),
    )


def _described(counted: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases ``(id, first, last, a)`` with their words and the counts of their parts."""
    head = shorter.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("begin"), F.concat("heads", F.array("a")).alias("heads"))
    tail = shorter.select(F.col("id").alias("last"), "end", F.concat("tails", F.array("a")).alias("tails"))
    return counted.join(head, "first").join(tail, "last").select(
        "id", "lang", F.concat_ws(" ", "begin", "end").alias("phrase"), "a", "heads", "tails", "end", "first", "last"
    )


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``best`` phrases of each language.

    Pieces end at ``. , ; : ! ?`` and line ends; words are what blanks and tabs separate,
    with A to Z folded. Null and empty texts have no words; a null language is ``und``.
    Rows of ``docs`` may repeat and each counts. Ties go to the phrase that comes first in
    byte order. Other columns are not looked at.
    """
    totals, levels = frequent(docs, least, longest, text_col, lang_col)
    found = None
    for shorter, longer in zip(levels[1:], [*levels[2:], None], strict=True):
        if longer is not None:
            over = longer.select(F.explode(F.array("first", "last")).alias("id"), F.col("a").alias("over")).groupBy("id").agg(F.max("over").alias("over"))
            shorter = shorter.join(over, "id", "left").where(f"over is null or 100 * over < {COVERED} * a")
        phrases = shorter.select("lang", "phrase", "a", "heads", "tails")
        found = phrases if found is None else found.unionByName(phrases)
    # Exact: the product is a decimal, and ``div`` rounds down.
    cut = f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) div cast(heads[k - 1] + tails[size(tails) - k] as decimal(20,0))"
    cuts = f"array_min(transform(sequence(1, size(heads)), k -> struct({cut} as score, k, heads[k - 1] as l, tails[size(tails) - k] as r)))"
    scored = found.select("lang", "phrase", "a", F.expr(cuts).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
runs AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3), (4)) lengths(k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY lang, k, phrase HAVING count(*) >= {LEAST}),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE k > 1),
inner_phrases AS (
    SELECT lang, a AS longer, unnest([array_to_string(w[1 : k - 1], ' '), array_to_string(w[2 : k], ' ')]) AS phrase FROM candidates
    UNION ALL SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' '), array_to_string(w[3:4], ' ')]) FROM candidates WHERE k = 4),
covered AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY lang, phrase),
cuts AS (
    SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, CAST({SCALE} AS HUGEINT) * c.a // (x.a + y.a) AS score
    FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM candidates) c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : j], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1 : c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
    FROM lowest LEFT JOIN covered USING (lang, phrase) WHERE coalesce(100 * longer < {COVERED} * a, true))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {BEST}"""
