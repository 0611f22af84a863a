"""Language-model scores of texts: the marginal probability of a lattice of subword pieces.

A word is a start mark and its bytes; its lattice holds an edge for each vocabulary
piece that matches, and for each single byte. The probability of a word is the sum over
all paths of the product of the pieces' unigram probabilities, by a forward recursion in
log space. Piece probabilities start from the scores of an existing vocabulary and are
re-estimated on all distinct training words by expectation-maximisation (each once: the
lattice has to explain rare words), the scores staying as a prior. A word seen in training has one more path, a single edge with the share of its
count; the weight of the two is the Good-Turing estimate of unseen words. A text is its
words and an end.

The corpus is reduced to a table of distinct words and counts, which grows with it and
stays distributed: tasks count their own texts first, then words are summed by a
shuffle. Each distinct word is scored once. Words frequent enough to be among at most
``frequent`` ones travel to the tasks that read texts, as a dictionary of bounded size;
only the remaining words of a text are shuffled to the word table, so a common word
never meets in one task. What reaches the driver is bounded by the vocabulary.
"""

from __future__ import annotations

import math
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import settle
from .pieces import least_count
from .text import chunks

VOCABULARY = "piece_bpe_32k.model"
#: Longer words are done one at a time, their edges found in windows of so many bytes; none is cut.
RUN_BYTES = 240
WINDOW = 1 << 16
MARK = b" "
ROUNDS = 3
#: Tokens that the vocabulary's own scores weigh when probabilities are re-estimated.
PRIOR_TOKENS = 10_000.0
FREQUENT = 200_000
_FLUSH = 300_000


def vocabulary_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, the start mark a blank, and probabilities from the vocabulary's scores.

    A score is minus a rank, and probability falls as one over the rank. Every byte is a
    piece. Pieces with capitals never match folded text and are left out, as are those
    with a mark inside, which no word has.
    """
    import sentencepiece

    if os.path.sep not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece == piece.lower() and MARK not in piece[1:]:
            found[piece] = 1.0 / (10.0 - min(0.0, max(model.get_score(i), -1e6)))
    for byte in range(256):
        found.setdefault(bytes([byte]), 1e-5)
    pieces = sorted(found)
    p = np.array([found[x] for x in pieces])
    return pieces, np.log(p / p.sum())


class Lattice:
    """Matches the pieces in many words at a time."""

    def __init__(self, pieces: list[bytes]):
        keys = np.array([self._hash(x) for x in pieces], np.uint64)
        self.lengths = {len(x) for x in pieces}
        self.longest = max(self.lengths)
        self.size, self.shift = 1 << 18, np.uint64(46)
        for attempt in range(1, 1000):
            factor = np.uint64((0x9E3779B97F4A7C15 * (2 * attempt + 1)) % 2**64)
            if self._fill(keys, factor):
                return
        raise RuntimeError("no table holds these pieces")

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * 0x100000001B3 + b + 1) % 2**64
        return h

    def _fill(self, keys: np.ndarray, factor: np.uint64) -> bool:
        places = ((keys * factor) >> self.shift).astype(np.int64)
        self.keys, self.index = np.zeros(self.size + 3, np.uint64), np.full(self.size + 3, -1, np.int32)
        for i in np.argsort(places, kind="stable"):
            place = next((p for p in range(places[i], places[i] + 3) if self.index[p] < 0), None)
            if place is None:
                return False
            self.keys[place], self.index[place] = keys[i], i
        self.factor = factor
        return True

    def _find(self, h: np.ndarray) -> np.ndarray:
        place = ((h * self.factor) >> self.shift).astype(np.int64)
        out = np.full(h.shape, -1, np.int32)
        for step in range(3):
            hit = self.keys[place + step] == h
            out[hit] = self.index[place + step][hit]
        return out

    def edges(self, runs: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """For each length with a match, the piece that starts at each place of each run, or -1."""
        width = runs.shape[1]
        h, out = np.zeros(runs.shape, np.uint64), []
        for n in range(1, min(self.longest, width) + 1):
            h = h[:, : width - n + 1] * np.uint64(0x100000001B3) + runs[:, n - 1 :].astype(np.uint64) + np.uint64(1)
            if n in self.lengths and ((found := self._find(h)) >= 0).any():
                out.append((n, found))
        return out

    @staticmethod
    def _sum(terms: list[np.ndarray]) -> np.ndarray:
        stacked = np.stack(terms)
        most = stacked.max(axis=0)
        return most + np.log(np.exp(stacked - most).sum(axis=0))

    def forward(self, scores: list[tuple[int, np.ndarray]], width: int) -> np.ndarray:
        """Log probability of all paths to each place: runs x (width + 1)."""
        alpha = np.zeros((scores[0][1].shape[0], width + 1))
        for end in range(1, width + 1):
            alpha[:, end] = self._sum([alpha[:, end - n] + score[:, end - n] for n, score in scores if n <= end])
        return alpha

    def backward(self, scores: list[tuple[int, np.ndarray]], width: int) -> np.ndarray:
        beta = np.zeros((scores[0][1].shape[0], width + 1))
        for start in range(width - 1, -1, -1):
            beta[:, start] = self._sum([beta[:, start + n] + score[:, start] for n, score in scores if n <= width - start])
        return beta

    def windows(self, run: bytes, backward: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, piece) of all edges of a long run in order of start, a window of starts at a time."""
        data = np.frombuffer(run, np.uint8)
        places = range(0, len(data), WINDOW)
        for at in reversed(places) if backward else places:
            found = [(n, edge[0]) for n, edge in self.edges(data[None, at : at + WINDOW + self.longest - 1])]
            starts = [np.flatnonzero(edge[:WINDOW] >= 0) for _, edge in found]
            start = np.concatenate(starts)
            end = np.concatenate([s + n for s, (n, _) in zip(starts, found, strict=True)])
            piece = np.concatenate([edge[s] for s, (_, edge) in zip(starts, found, strict=True)])
            order = np.argsort(-start if backward else start, kind="stable")
            yield start[order] + at, end[order] + at, piece[order]

    def path_sums(self, run: bytes, logs: np.ndarray, backward: bool = False) -> np.ndarray:
        """Log probability of all paths to each place of a long run, or from it."""
        sums = [-math.inf] * (len(run) + 1)
        sums[len(run) if backward else 0] = 0.0
        for start, end, piece in self.windows(run, backward):
            origin, target = (end, start) if backward else (start, end)
            for a, b, score in zip(origin.tolist(), target.tolist(), logs[piece].tolist(), strict=True):
                one, two = sums[a] + score, sums[b]
                sums[b] = max(one, two) + math.log1p(math.exp(-abs(one - two)))
        return np.array(sums)


def runs_by_width(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the word, bytes) of marked words of one width at a time, in blocks of bounded size.

    Words over ``RUN_BYTES`` are left to :func:`long_runs`.
    """
    by_width: dict[int, tuple[list[int], list[bytes]]] = {}
    for i, word in enumerate(words):
        marked = MARK + word
        if len(marked) <= RUN_BYTES:
            which, runs = by_width.setdefault(len(marked), ([], []))
            which.append(i)
            runs.append(marked)
    for width, (which, runs) in by_width.items():
        most = max(1, 200_000 // width)
        for at in range(0, len(runs), most):
            block = runs[at : at + most]
            yield np.array(which[at : at + most]), np.frombuffer(b"".join(block), np.uint8).reshape(len(block), width)


def long_runs(words: list[bytes]) -> Iterator[tuple[int, bytes]]:
    for i, word in enumerate(words):
        if len(MARK + word) > RUN_BYTES:
            yield i, MARK + word


def _scored(edges: list[tuple[int, np.ndarray]], logs: np.ndarray) -> list[tuple[int, np.ndarray]]:
    padded = np.append(logs, -1e30)  # edge -1
    return [(n, padded[e]) for n, e in edges]


def log_probabilities(lattice: Lattice, logs: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    out = np.zeros(len(words))
    for which, runs in runs_by_width(words):
        alpha = lattice.forward(_scored(lattice.edges(runs), logs), runs.shape[1])
        out[which] = alpha[:, -1]
    for i, run in long_runs(words):
        out[i] = lattice.path_sums(run, logs)[-1]
    return out


def expected_counts(lattice: Lattice, logs: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """How often each piece is used, over all paths by their probability."""
    used = np.zeros(len(logs))
    for which, runs in runs_by_width(words):
        width = runs.shape[1]
        edges = lattice.edges(runs)
        scores = _scored(edges, logs)
        alpha, beta = lattice.forward(scores, width), lattice.backward(scores, width)
        for (n, edge), (_, score) in zip(edges, scores, strict=True):
            row, start = np.nonzero(edge >= 0)
            path = alpha[row, start] + score[row, start] + beta[row, start + n] - alpha[row, -1]
            used += np.bincount(edge[row, start], np.exp(path) * counts[which[row]], minlength=len(logs))
    for i, run in long_runs(words):
        to, since = lattice.path_sums(run, logs), lattice.path_sums(run, logs, backward=True)
        for start, end, piece in lattice.windows(run):
            used += np.bincount(piece, np.exp(to[start] + logs[piece] + since[end] - to[-1]) * counts[i], minlength=len(logs))
    return used


def folded(text: bytes) -> list[bytes]:
    """The words of a text: bytes.lower folds A to Z alone, bytes.split cuts at ASCII white space."""
    return text.lower().split()


def held_out(doc_id: object) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def _bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train: Counter = Counter()
    other: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = list(train.keys() | other.keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()), pa.array([other[w] for w in words], pa.int64())],
            names=["word", "train", "other"],
        )
        train.clear()
        other.clear()
        return out

    for whole in batches:
        for a, b in chunks(whole, "text"):
            part = whole.slice(a, b - a)
            for doc, text in zip(part.column("doc_id").to_pylist(), _bytes(part.column("text")), strict=True):
                (other if held_out(doc) else train).update(folded(text))
                if len(train) + len(other) > _FLUSH:
                    yield flush()
    yield flush()


def _estimator(pieces: list[bytes], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, used = Lattice(pieces), np.zeros(len(pieces))
        for batch in batches:
            words = batch.column("word").to_pylist()
            used += expected_counts(lattice, logs, words, np.ones(len(words)))
        found = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(used[found])], names=["piece", "n"])

    return run


def _word_scorer(pieces: list[bytes], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            marginal = log_probabilities(lattice, logs, batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("train"), batch.column("seen"), pa.array(marginal)], names=["word", "train", "seen", "marginal"]
            )

    return run


def _text_scorer(frequent: pa.Table, end: tuple[float, float, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = frequent["word"].to_pylist()
        index = dict(zip(words, range(len(words)), strict=True))
        base, model, known = (np.append(frequent[c].to_numpy(), 0) for c in ("base", "model", "known"))
        for whole in batches:
            for a, b in chunks(whole, "text"):
                part = whole.slice(a, b - a)
                docs = part.column("doc_id").to_pylist()
                rows = part.column("row").to_pylist()
                out: list[list] = [[] for _ in range(9)]
                for doc, row, text in zip(docs, rows, _bytes(part.column("text")), strict=True):
                    tokens = folded(text)
                    at = np.fromiter(map(index.get, tokens, repeat(-1)), np.int64, len(tokens))
                    rare = Counter([tokens[i] for i in np.flatnonzero(at < 0)])
                    # The text's own row has a key that no word can have: a byte that UTF-8 lacks.
                    own = (b"\xff%d" % row, row, 1, doc, held_out(doc), len(tokens) + 1, end[2] + int(known[at].sum()), end[0] + base[at].sum(), end[1] + model[at].sum())
                    for column, value in zip(out, own, strict=True):
                        column.append(value)
                    n = len(rare)
                    out[0].extend(rare.keys())
                    out[1].extend(repeat(row, n))
                    out[2].extend(rare.values())
                    for column in out[3:]:
                        column.extend(repeat(None, n))
                kinds = [pa.binary(), pa.int64(), pa.int64(), part.column("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=_TEXT_COLUMNS)

    return run


_TEXT_COLUMNS = ["word", "row", "times", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"]


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row.

    Rows whose id has remainder 2 are held out of training. ``base_score`` is the sum of
    log10 of add-one smoothed word frequencies, ``score`` the model's log10 probability.
    A null or empty text is an end alone; a null id counts as the text ``None``. Every
    row has one result row, also if ids repeat. Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces, prior = vocabulary_pieces(vocabulary)
    words = settle(
        docs.mapInArrow(_word_counter, "word binary, train long, other long")
        .groupBy("word")
        .agg(F.sum("train").alias("train"), F.sum(F.col("train") + F.col("other")).alias("seen"))
    )
    ends = docs.select(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")).cast("binary")), F.lit(7)).alias("m")).where("m <> 2").count()
    facts = words.agg(F.sum("train").alias("n"), F.count_if(F.col("train") > 0).alias("v"), F.count_if(F.col("train") == 1).alias("once")).first()
    in_words, distinct, once = facts["n"] or 0, facts["v"], facts["once"]
    total = in_words + ends
    smooth = float(total + distinct + (ends > 0) + 1)

    logs = prior
    for _ in range(rounds if in_words else 0):
        used = words.where("train > 0").select("word").mapInArrow(_estimator(pieces, logs), "piece int, n double")
        counts = np.exp(prior) * PRIOR_TOKENS
        for r in used.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            counts[r["piece"]] += r["n"]
        logs = np.log(counts / counts.sum())

    end = (ends + 1) / (total + 2)
    seen_share = (1 - max(once, 1) / in_words) if in_words > 1 else 0.0
    lattice = F.lit(1 - seen_share) * F.exp("marginal")
    whole = F.lit(seen_share / max(in_words, 1)) * F.col("train")
    # Without a count, or a share for counts, the sum is the lattice alone, taken as a logarithm: it may be tiny.
    model = F.when((F.col("train") > 0) & F.lit(seen_share > 0), F.log10(whole + lattice)).otherwise(
        F.col("marginal") / F.lit(float(np.log(10))) + F.lit(float(np.log10(1 - seen_share)))
    )
    scored = settle(
        words.mapInArrow(_word_scorer(pieces, logs), "word binary, train long, seen long, marginal double").select(
            "word",
            "seen",
            (F.col("train") > 0).cast("int").alias("known"),
            F.log10((F.col("train") + 1) / F.lit(smooth)).alias("base"),
            (model + F.lit(float(np.log10(1 - end)))).alias("model"),
        )
    )
    common = scored.where(F.col("seen") >= least_count(scored, frequent)).select("word", "known", "base", "model").toArrow()
    own_end = (float(np.log10((ends + 1) / smooth)), float(np.log10(end)), int(ends > 0))
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    spec = StructType().add("word", "binary").add("row", "long").add("times", "long").add(docs.schema["doc_id"])
    for name, kind in (("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("model", "double")):
        spec = spec.add(name, kind)
    texts = numbered.mapInArrow(_text_scorer(common, own_end), spec)
    rare = scored.select("word", F.col("known").alias("k"), F.col("base").alias("b"), F.col("model").alias("m"))
    summed = texts.join(rare, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.col("k") * F.col("times"), F.lit(0))).alias("n_known"),
        F.sum(F.coalesce("base", F.col("b") * F.col("times"), F.lit(0.0))).alias("base_score"),
        F.sum(F.coalesce("model", F.col("m") * F.col("times"), F.lit(0.0))).alias("score"),
    )
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

