"""SentencePiece encoding and decoding as joins.

A word is a start mark and its characters. The distinct words of a corpus form a table;
each word is exploded into its substrings up to the longest piece, an equi-join with the
piece table keeps those that are pieces, and the edges of each word are folded in order of
their end into the best path from the start to each place (Viterbi: the largest sum of the
model's scores), with back pointers, for all words of some Arrow batches abreast. A
character that is no piece falls back to the pieces of its bytes. Decoding joins ids to
pieces and puts their bytes together. Between the explosion of a word or of its ids and
the fold nothing is shuffled: what one row was exploded to arrives together, in order.

Words are summed in their tasks before the shuffle, and each distinct word is encoded
once. The piece table is bounded by the vocabulary, so it is broadcast. Words frequent
enough to be among a bounded number go back to the texts as a dictionary, and only the
other words of a text are shuffled; a word that a third of all rows hold never meets in
one task. Words of more than ``RUN`` characters (long addresses, texts without blanks) are
not folded but go whole through the same recursion with back pointers, in an Arrow
function: its time grows with their length, not with its square.

With ``white`` a text is encoded with all its white space, as the library does: no piece
has a mark after another character, so a text may be cut before each run of blanks, and
around each white character that no longer piece holds (line feeds, tabs). What lies
between two cuts is a word: it starts with ``MARK``, or with ``OPEN`` where no blank
precedes it, and has its further blanks as such. The best path of a text is that of its
words end to end.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from ..session import discard, written
from .text import chunks

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
_MARK = MARK.encode()
#: First character of a word that has no blank before it; in the bytes of a split text ``_OPEN``, which UTF-8 never has.
OPEN, _OPEN = "\x00", b"\xff"
_WHITE = b"\t\n\x0b\x0c\r"
RUN = 60
FREQUENT = 200_000
#: Words of one partition while their edges exist.
WORDS_AT_ONCE = 40_000
_FLUSH = 300_000
#: Weights of places in a text's digest repeat after so many words.
_PLACES = 1021


def piece_table(spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(piece, id, score, raw, is_byte)`` of a model file, or of a name that ``public_tokenizers`` knows."""
    import sentencepiece

    if os.path.sep not in vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    rows = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece, byte = model.id_to_piece(i), model.is_byte(i)
        rows.append((piece, i, model.get_score(i), bytes([int(piece[3:5], 16)]) if byte else piece.encode(), byte))
    return spark.createDataFrame(rows, "piece string, id int, score double, raw binary, is_byte boolean")


def body(word: str) -> str:
    """The characters of a word that are encoded: blanks are marks."""
    return word.removeprefix(OPEN).replace(" ", MARK)


def encode_words(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """``(word, ..., ids, path_score)`` for each row of ``words(word, ...)``, which are distinct and marked or open.

    Among paths with equal scores the one whose last piece is longest wins, place by place.
    """
    normal = pieces.where("not is_byte")
    limits = pieces.agg(
        F.max(F.when(~F.col("is_byte"), F.char_length("piece"))).alias("longest"),
        F.min(F.when(F.col("score") > -1e6, F.col("score"))).alias("lowest"),
        F.min(F.when(F.col("is_byte"), F.col("id"))).alias("first_byte"),
    ).first()
    longest, unknown, first_byte = limits["longest"], limits["lowest"] - 10.0, limits["first_byte"]
    spec = StructType(words.schema.fields).add("ids", ArrayType(IntegerType())).add("path_score", "double")
    table = {r["piece"]: (r["score"], r["id"]) for r in normal.collect()}
    inside = F.replace(F.when(F.startswith("word", F.lit(OPEN)), F.substr("word", F.lit(2))).otherwise(F.col("word")), F.lit(" "), F.lit(MARK))
    whole = words.where(F.char_length(inside) > RUN).mapInArrow(_long_encoder(table, longest, unknown, first_byte), spec)
    words = words.where(F.char_length(inside) <= RUN)
    # Dealt by word first, in parts of bounded size: edges are made and folded where their word is.
    words = words.repartition(max(1, -(-words.count() // WORDS_AT_ONCE)), "word")
    spans = words.select(F.struct(*words.columns).alias("row"), inside.alias("body"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), F.char_length("body"))).alias("at"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("body") - F.col("at") + 1))).alias("size"))
    spans = spans.select("row", "at", "size", F.substring("body", F.col("at"), F.col("size")).alias("span")).withColumn("code", F.xxhash64("span"))
    # Joined by a hash of the text, which is a plain long, and then compared with the text itself.
    coded = normal.select("piece", "id", "score", F.xxhash64("piece").alias("code"))
    found = spans.join(F.broadcast(coded), "code", "left").withColumn("held", F.coalesce(F.col("piece") == F.col("span"), F.lit(False)))
    # A word's columns ride on its first edge only. An edge is its id from 1 (0: the bytes of a character), start and end.
    edges = found.where("held or size = 1").select(
        F.when((F.col("at") == 1) & (F.col("size") == 1), F.col("row")).alias("row"),
        (F.when(F.col("held"), F.col("id") + 1).otherwise(0).cast("long") * 65536 + (F.col("at") - 1) * 256 + F.col("at") + F.col("size") - 1).alias("edge"),
        F.when(F.col("held"), F.col("score")).otherwise(F.octet_length("span") * F.lit(unknown)).alias("score"),
    )
    return edges.mapInArrow(_folder(first_byte), spec).unionByName(whole)


def _groups(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[tuple[pa.Table, np.ndarray, list[pa.Array], list[str]]]:
    """Tables of about ``most`` rows with whole groups, their first rows, and the columns in ``row`` of these with their names.

    A group is what one row was exploded to: its rows follow each other, and only the first has a ``row``.
    """
    held: list[pa.RecordBatch] = []

    def group(table: pa.Table, heads: np.ndarray):
        row = table["row"].combine_chunks().take(pa.array(heads))
        return table, heads, row.flatten(), [f.name for f in row.type]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            heads = np.flatnonzero(table["row"].is_valid().to_numpy())
            if len(heads) > 1:
                yield group(table.slice(0, heads[-1]).combine_chunks(), heads[:-1])
            held = table.slice(heads[-1]).combine_chunks().to_batches()
    if any(b.num_rows for b in held):
        table = pa.Table.from_batches(held).combine_chunks()
        yield group(table, np.flatnonzero(table["row"].is_valid().to_numpy()))


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))


def _folder(first_byte: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for edges, heads, rows, names in _groups(batches):
            paths = _fold(edges["edge"].to_numpy(), edges["score"].to_numpy(), heads, rows[names.index("word")], first_byte)
            yield pa.RecordBatch.from_arrays([*rows, *paths], names=[*names, "ids", "path_score"])

    return run


def _fold(edge: np.ndarray, score: np.ndarray, heads: np.ndarray, words: pa.Array, first_byte: int | None) -> tuple[pa.Array, pa.Array]:
    """The ids and the score of the best path of each word: its edges, folded in order of their end, all words abreast.

    Scores and back pointers lie by place, one word after the other.
    """
    word = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(edge))))
    start, end = edge >> 8 & 255, edge & 255
    length = np.maximum.reduceat(end, heads)
    base = np.cumsum(length + 1) - (length + 1)
    place, before = base[word] + end, base[word] + start
    total = int(base[-1] + length[-1]) + 1
    # Of equal scores the first wins, which is that of the longest piece.
    order = np.argsort((end * total + place) * 256 + start)
    place, before, score, end = place[order], before[order], score[order], end[order]
    best, back = np.zeros(total), np.zeros(total, np.int64)
    ends = _runs(end)
    for a, b in zip(ends, np.append(ends[1:], len(end)), strict=True):
        new, at = best[before[a:b]] + score[a:b], place[a:b]
        first = _runs(at)
        top = np.maximum.reduceat(new, first)
        hits = np.flatnonzero(new == np.repeat(top, np.diff(np.append(first, b - a))))
        best[at[first]], back[at[first]] = top, a + hits[np.searchsorted(hits, first)]
    last = base + length
    steps, left, at = [], np.arange(len(heads)), last
    while len(left):
        came = back[at]
        steps.append((left, came))
        at = before[came]
        more = at > base[left]
        left, at = left[more], at[more]
    word = np.concatenate([w for w, _ in reversed(steps)])
    forward = np.argsort(word, kind="stable")
    word, path = word[forward], edge[order[np.concatenate([e for _, e in reversed(steps)])[forward]]]
    ids = (path >> 16) - 1
    # The bytes of characters that are no piece take the place of their edges.
    bare = np.flatnonzero(ids < 0)
    size = np.ones(len(ids), np.int64)
    octets = [body(str(words[w]))[s].encode() for w, s in zip(word[bare].tolist(), (path[bare] >> 8 & 255).tolist(), strict=True)]
    size[bare] = [len(o) for o in octets]
    ids = np.repeat(ids, size)
    if octets:
        ids[ids < 0] = np.frombuffer(b"".join(octets), np.uint8).astype(np.int64) + first_byte
    of_word = np.append(0, np.cumsum(size)[np.cumsum(np.bincount(word)) - 1])
    return pa.ListArray.from_arrays(pa.array(of_word, pa.int32()), pa.array(ids, pa.int32())), pa.array(best[last])


def best_path(word: str, table: dict[str, tuple[float, int]], longest: int, unknown: float, first_byte: int) -> tuple[list[int], float]:
    """The ids and the score of the best path through a word."""
    scores, back = [0.0], [0]
    for end in range(1, len(word) + 1):
        best, origin = None, 0
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            held = table.get(piece)
            if held is None and end - start > 1:
                continue
            score = scores[start] + (held[0] if held else len(piece.encode()) * unknown)
            if best is None or score > best:
                best, origin = score, start
        scores.append(best)
        back.append(origin)
    steps, end = [], len(word)
    while end:
        piece = word[back[end] : end]
        held = table.get(piece)
        steps.append([held[1]] if held else [first_byte + b for b in piece.encode()])
        end = back[end]
    return [i for step in reversed(steps) for i in step], scores[-1]


def _long_encoder(table: dict[str, tuple[float, int]], longest: int, unknown: float, first_byte: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "word"):
                part = whole.slice(a, b - a)
                paths = [best_path(body(word), table, longest, unknown, first_byte) for word in part.column("word").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([p[0] for p in paths], pa.list_(pa.int32())), pa.array([p[1] for p in paths], pa.float64())],
                    names=[*part.schema.names, "ids", "path_score"],
                )

    return run


def decode(encoded: DataFrame, pieces: DataFrame, key: str, *more: str) -> DataFrame:
    """``(key, more..., text)`` of rows with distinct keys and ``ids``: the pieces' bytes, the mark a blank.

    One leading blank, that of the first mark, is dropped. Rows without ids have no result row.
    """
    # A row with many ids is not exploded: each of its rows would carry the key.
    raws = {r["id"]: bytes(r["raw"]) for r in pieces.select("id", "raw").collect()}
    wide = encoded.where(F.size("ids") > 4 * RUN).select(key, *more, "ids")
    whole = wide.mapInArrow(_long_decoder(raws), StructType(wide.schema.fields[:-1]).add("text", "string"))
    encoded = encoded.where(F.size("ids") <= 4 * RUN)
    each = encoded.select(F.struct(key, *more).alias("row"), F.posexplode("ids").alias("place", "id"))
    parts = each.join(F.broadcast(pieces.select("id", "raw")), "id", "left").select(F.when(F.col("place") == 0, F.col("row")).alias("row"), "raw")
    joined = parts.mapInArrow(_joiner, StructType(wide.schema.fields[:-1]).add("raw", "binary"))
    text = F.replace(F.decode("raw", "UTF-8"), F.lit(MARK), F.lit(" "))
    texts = joined.select(key, *more, text.alias("text")).withColumn("text", F.when(F.startswith("text", F.lit(" ")), F.substr("text", F.lit(2))).otherwise(F.col("text")))
    return texts.unionByName(whole)


def _joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces that follow each other, a row for each word: ids stay in their order."""
    for parts, heads, rows, names in _groups(batches):
        raw = pc.fill_null(parts["raw"].combine_chunks().cast(pa.large_binary()), b"")
        _, offsets, octets = raw.buffers()
        bounds = np.frombuffer(offsets, np.int64)[raw.offset :][: len(raw) + 1]
        raw = pa.Array.from_buffers(raw.type, len(heads), [None, pa.py_buffer(bounds[np.append(heads, len(raw))]), octets])
        yield pa.RecordBatch.from_arrays([*rows, raw.cast(pa.binary())], names=[*names, "raw"])


def _long_decoder(raws: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            joined = [b"".join(map(raws.__getitem__, ids)) for ids in part.column("ids").to_pylist()]
            texts = [b.decode("utf-8", "replace").replace(MARK, " ").removeprefix(" ") for b in joined]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "text"])

    return run


def alone(pieces: DataFrame) -> bytes:
    """The white characters besides the blank that no piece of more characters holds."""
    longer = pieces.where("not is_byte").where(F.char_length("piece") > 1)
    held = longer.agg(*(F.max(F.contains("piece", F.lit(chr(c)))).alias(str(c)) for c in _WHITE)).first()
    return bytes(c for c in _WHITE if not held[str(c)])


class Words:
    """The words of a text. A word's key is its bytes without ``MARK``, or ``_OPEN`` and its bytes without ``OPEN``.

    ``cuts`` are the white characters that are words by themselves; None leaves out all white space.
    """

    def __init__(self, cuts: bytes | None):
        self.white = cuts is not None
        # As they stand in a split text: a key of their own.
        self.cuts = {bytes([c]): _OPEN + bytes([c]) for c in cuts or b""}
        self.cut = set(self.cuts.values())
        self.inner = [bytes([c]) for c in _WHITE if c not in (cuts or b"")]

    def keys(self, text: bytes) -> tuple[list[bytes], int]:
        """The keys of all words, and the number of words that have other characters than white ones."""
        if not self.white:
            runs = text.split()
            return runs, len(runs)
        if not text:
            return [], 0
        parted, cuts = text, 0
        for c, key in self.cuts.items():
            if c in text:
                cuts += text.count(c)
                parted = parted.replace(c, b" " + key + b" " + _OPEN)
        parts = parted.split(b" ")
        odd = b"  " in parted or b"\xff " in parted or parted[:1] == b" " or parted[-1:] in (b" ", _OPEN)
        parts = self._joined(parts) if odd else parts
        return parts, len(text.split()) if odd or any(c in text for c in self.inner) else len(parts) - cuts

    def _joined(self, parts: list[bytes]) -> list[bytes]:
        """Blanks go to what follows them, or are a word before a cut and at the end."""
        out, blanks = [], 0
        for part in parts:
            if not part:
                blanks += 1
            elif part in self.cut:
                out.extend([b" " * (blanks - 1)] if blanks else [])
                out.append(part)
                blanks = 0
            elif part != _OPEN:
                out.append(b" " * blanks + part)
                blanks = 0
        return out + ([b" " * (blanks - 1)] if blanks else [])

def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def _word(key: bytes) -> bytes:
    return OPEN.encode() + key[1:] if key[:1] == _OPEN else _MARK + key


def _key(word: str) -> bytes:
    return _OPEN + word[1:].encode() if word[0] == OPEN else word.encode().removeprefix(_MARK)


def _run_counter(split: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(map(_word, seen)), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "seen"])
            seen.clear()
            return out

        for whole in batches:
            for a, b in chunks(whole, "text"):
                for text in _texts(whole.slice(a, b - a).column("text")):
                    seen.update(split.keys(text)[0])
                    if len(seen) > _FLUSH:
                        yield flush()
        yield flush()

    return run


_COLUMNS = ["word", "row", "weight", "times", "doc_id", "n_words", "n_pieces", "digest", "wrong"]


def _assembler(frequent: pa.Table, split: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {_key(w): i for i, w in enumerate(frequent["word"].to_pylist())}
        size, print_, wrong = (np.append(frequent[c].to_numpy(), 0) for c in ("size", "print", "wrong"))
        for whole in batches:
            for a, b in chunks(whole, "text"):
                part = whole.slice(a, b - a)
                out: list[list] = [[] for _ in _COLUMNS]
                for doc, row, text in zip(part.column("doc_id").to_pylist(), part.column("row").to_pylist(), _texts(part.column("text")), strict=True):
                    runs, n_words = split.keys(text)
                    at = np.fromiter(map(index.get, runs, repeat(-1)), np.int64, len(runs))
                    weight = np.arange(len(runs)) % _PLACES + 1
                    # The text's own row has a key that no word can have.
                    own = (f"={row}", row, 0, 0, doc, n_words, int(size[at].sum()), int((print_[at] * weight).sum()), int(wrong[at].sum()))
                    for column, value in zip(out, own, strict=True):
                        column.append(value)
                    rare: dict[bytes, list[int]] = {}
                    for i in np.flatnonzero(at < 0).tolist():
                        held = rare.setdefault(runs[i], [0, 0])
                        held[0] += i % _PLACES + 1
                        held[1] += 1
                    out[0].extend(map(_word, rare))
                    out[1].extend(repeat(row, len(rare)))
                    out[2].extend(v[0] for v in rare.values())
                    out[3].extend(v[1] for v in rare.values())
                    for column in out[4:]:
                        column.extend(repeat(None, len(rare)))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), part.column("doc_id").type, *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=_COLUMNS)

    return run


def lexicon(docs: DataFrame, pieces: DataFrame, text_col: str = "text", split: Words | None = None) -> tuple[DataFrame, str]:
    """``(word, seen, ids, path_score)`` for the distinct words of ``docs``, and the path of this table."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_run_counter(split or Words(None)), "word string, seen long")
    words, path = written(counted.groupBy("word").agg(F.sum("seen").alias("seen")), "words")
    encoded = written(encode_words(words, pieces), "lexicon")
    discard(docs.sparkSession, path)
    return encoded


def encode(docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text", white: bool = False) -> DataFrame:
    """``(row, doc_id, ids)``: all ids of each text, in order; ``row`` numbers the rows of ``docs``.

    Without ``white`` the ids are those of the words with single blanks between them.
    Null and empty texts have no ids. This moves every word of every text to its encoding
    and back; :func:`digest` does not.
    """
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = Words(alone(pieces) if white else None)
    words = lexicon(docs, pieces, split=split)[0].select("word", "ids")
    spec = StructType([docs.schema["row"], docs.schema["doc_id"]]).add("place", "long").add("word", "string")
    each = docs.mapInArrow(_spread(split), spec).join(words, "word", "left")
    placed = F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("place", "ids"))))
    return each.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.flatten(F.transform(placed, lambda x: x["ids"])).alias("ids"))


def _spread(split: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "text"):
                part = whole.slice(a, b - a)
                runs = [list(map(_word, split.keys(t)[0])) or [b"="] for t in _texts(part.column("text"))]
                row = pa.array(np.repeat(np.arange(len(runs)), [len(r) for r in runs]))
                place = np.concatenate([np.arange(len(r)) for r in runs])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(row), part.column("doc_id").take(row), pa.array(place), pa.array([w for r in runs for w in r], pa.string())],
                    names=["row", "doc_id", "place", "word"],
                )

    return run


def digest(
    docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, white: bool = False
) -> DataFrame:
    """``(doc_id, n_words, n_pieces, ids_digest, round_trip)`` for each row of ``docs``.

    ``ids_digest`` sums a 31-bit hash of each word's ids times a weight of its place;
    ``round_trip`` says that the ids of all words decode to the words. With ``white`` no
    white space is left out, so it says that the ids decode to the text, byte by byte;
    without it the words have single blanks between them. Null and empty texts have no
    pieces. Rows may repeat, ids may be of any type and null. Other columns
    are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = Words(alone(pieces) if white else None)
    # All that a text needs of a word is small, so it rides along instead of being joined again.
    lexicon_table, path = lexicon(docs, pieces, split=split)
    encoded = lexicon_table.select(
        "word", "seen", F.size("ids").cast("long").alias("size"), F.pmod(F.xxhash64("ids"), F.lit(1 << 31)).alias("print"), "ids"
    )
    # A mark that the text itself has comes back as a blank.
    own = F.substr("word", F.lit(2))
    same = F.col("text") == (own if white else F.replace(own, F.lit(MARK), F.lit(" ")))
    decoded = decode(encoded, pieces, "word", "seen", "size", "print")
    words, _ = written(decoded.select("word", "seen", "size", "print", F.when(same, 0).otherwise(1).cast("long").alias("wrong")), "pieces")
    discard(docs.sparkSession, path)
    least = least_count(words, frequent)
    common = words.where(F.col("seen") >= least).select("word", "size", "print", "wrong").toArrow()
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    spec = StructType().add("word", "string").add("row", "long").add("weight", "long").add("times", "long").add(docs.schema["doc_id"])
    for name in ("n_words", "n_pieces", "digest", "wrong"):
        spec = spec.add(name, "long")
    texts = numbered.mapInArrow(_assembler(common, split), spec)
    rare = words.where(F.col("seen") < least).select("word", "size", "print", F.col("wrong").alias("odd"))

    def total(own: str, other: Column) -> Column:
        return F.sum(F.coalesce(F.col(own), other, F.lit(0)))

    summed = texts.join(rare, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        total("n_pieces", F.col("size") * F.col("times")).alias("n_pieces"),
        total("digest", F.col("print") * F.col("weight")).alias("ids_digest"),
        total("wrong", F.col("odd") * F.col("times")).alias("n_wrong"),
    )
    return summed.select("doc_id", "n_words", "n_pieces", "ids_digest", (F.col("n_wrong") == 0).alias("round_trip"))


def least_count(words: DataFrame, frequent: int) -> int:
    """The smallest count of a few per doubling that at most ``frequent`` words reach."""
    step = F.floor(F.log2("seen") * 4).cast("int")
    steps = words.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("seen").alias("least")).collect()
    held, least = 0, 1 << 62
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["n"]
        if held > frequent:
            break
        least = r["least"]
    return least
