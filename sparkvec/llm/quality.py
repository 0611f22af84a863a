"""A quality classifier without gold labels: voting heuristics, then a hashed linear scorer.

Ten overlapping heuristics look at a text's bytes and words and vote good, bad or
nothing. The votes of all rows are counted by pattern (4^10 patterns at most, which bounds
what the driver sees), and expectation-maximisation on the counts estimates how often
each heuristic votes right, wrong or not at all, and the posterior of each pattern. Posteriors are the soft labels of a
logistic model over hashed features: runs of four bytes of the text, and what the
heuristics measured, in steps. The model is fitted on a bounded sample of rows
(``sample``) and then scores every row.

Texts are read twice and nothing of them is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import settle
from .text import chunks, gram_counts, utf8, word_hashes

LABELLERS = ("symbols", "capitals", "repeats", "variety", "separators", "word_length", "sentences", "top_word", "word_ends", "pairs")
#: Bins of the hashed text and of the hashed measures.
TEXT_BINS, MEASURE_BINS = 1536, 512
#: Rows the scorer is fitted on, about; all rows are voted on, counted and scored.
SAMPLE = 4000
#: Only what is scored clearly bad goes.
THRESHOLD = 0.3
_ROWS = 1000

_LETTER, _UPPER, _SYMBOL, _SPACE, _STOP = (np.zeros(256, np.int32) for _ in range(5))
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1
_UPPER[65:91] = 1
_SPACE[[9, 10, 11, 12, 13, 32]] = 1
_SYMBOL[33:128] = 1 - np.maximum(_LETTER[33:128], np.isin(np.arange(33, 128), list(b"0123456789.,;:'\"-()?")))
_STOP[list(b".!?")] = 1


def measures(column: pa.Array) -> np.ndarray:
    """One row for each text: what the heuristics look at, in the order of ``LABELLERS``, then the words."""
    data, bounds = utf8(column)
    words, first = word_hashes(data, bounds)
    out = np.zeros((len(column), len(LABELLERS) + 1))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        w = words[first[i] : first[i + 1]]
        if not len(w):
            continue
        part = data[a:b]
        seen = np.bincount(part, minlength=256)
        characters = seen.sum() - (seen * _SPACE).sum() - seen[128:192].sum()
        ascii_letters = seen[65:91].sum() + seen[97:123].sum()
        values, counts = np.unique(w, return_counts=True)
        last = part[_ends(part)]
        out[i] = (
            (seen * _SYMBOL).sum() / characters,
            (seen * _UPPER).sum() / max(1, ascii_letters),
            (w[1:] == w[:-1]).sum() / max(1, len(w) - 1),
            len(values) / len(w),
            _alone(part) / len(w),
            characters / len(w),
            _STOP[last].sum() / len(w),
            counts.max() / len(w),
            _SYMBOL[last].sum() / len(w),
            len(np.unique(w[1:] * np.uint64(3) + w[:-1])) / max(1, len(w) - 1),
            len(w),
        )
    return out


def _ends(part: np.ndarray) -> np.ndarray:
    """Places of the last byte of each word."""
    space = _SPACE[part]
    return np.flatnonzero((space == 0) & (np.append(space[1:], 1) == 1))


def _alone(part: np.ndarray) -> int:
    """Symbols with white space or an end on both sides."""
    if len(part) < 3:
        return 0
    space = _SPACE[part]
    return int((space[:-2] & _SYMBOL[part[1:-1]] & space[2:]).sum())


def _never(x: np.ndarray) -> np.ndarray:
    return np.zeros(len(x), bool)


# Bad if, good if, least number of words; in the order of LABELLERS.
_RULES = (
    (lambda x: x > 0.08, _never, 5),
    (lambda x: x > 0.5, _never, 5),
    (lambda x: x > 0.2, lambda x: x < 0.05, 20),
    (lambda x: x < 0.25, lambda x: x > 0.5, 40),
    (lambda x: x > 0.12, _never, 8),
    (lambda x: (x < 2.2) | (x > 7.8), lambda x: (x > 3) & (x < 7.2), 20),
    (lambda x: (x < 0.005) | (x > 0.5), lambda x: (x > 0.02) & (x < 0.3), 40),
    (lambda x: x > 0.25, _never, 20),
    (lambda x: x > 0.3, _never, 8),
    (lambda x: x < 0.4, lambda x: x > 0.8, 20),
)
#: What a labeller can say: bad, good, nothing, or that the text is too short for it.
BAD, GOOD, NOTHING, SHORT = range(4)


def votes(measured: np.ndarray) -> np.ndarray:
    """Rows x labellers."""
    out = np.full((len(measured), len(LABELLERS)), SHORT, np.int64)
    for k, (bad, good, least) in enumerate(_RULES):
        x, enough = measured[:, k], measured[:, -1] >= least
        out[enough, k] = NOTHING
        out[enough & good(x), k] = GOOD
        out[enough & bad(x), k] = BAD
    return out


def pattern_of(voted: np.ndarray) -> np.ndarray:
    return (voted * 4 ** np.arange(voted.shape[1])).sum(axis=1)


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 4 ** np.arange(len(LABELLERS)) % 4


def accuracies(voted: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each vote pattern; P(vote | class) as (2, labellers, 3); the prior.

    Labellers vote independently given the class; saying nothing is a vote too, as a
    heuristic may speak up on one class only, but being too short for one is not. It
    starts from counted votes, a bad one as strong as two good ones, which fixes the
    class that is called good.
    """
    hot = np.stack([voted == v for v in (BAD, GOOD, NOTHING)], axis=2).astype(float)
    post = 1 / (1 + np.exp(-np.clip(2.0 + (voted == GOOD).sum(axis=1) - 2.0 * (voted == BAD).sum(axis=1), -30, 30)))
    rates, prior = np.full((2, voted.shape[1], 3), 1 / 3), 0.5
    for _ in range(rounds if len(voted) else 0):
        both = np.stack([(1 - post) * counts, post * counts])
        prior = float(np.clip(both[1].sum() / counts.sum(), 0.01, 0.99))
        rates = np.einsum("cp,plv->clv", both, hot) + 1.0
        rates /= rates.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,clv->cp", hot, np.log(rates)) + np.log([[1 - prior], [prior]])
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return post, rates, prior


def features(column: pa.Array, measured: np.ndarray) -> np.ndarray:
    """Hashed features: roots of the shares of byte runs, and one mark for each measure's step."""
    grams = np.sqrt(gram_counts(*utf8(column), TEXT_BINS, size=4))
    grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-9)
    marks = np.zeros((len(measured), MEASURE_BINS), np.float32)
    for k in range(len(LABELLERS)):
        step = np.clip(np.floor(measured[:, k] * (2 if k == 5 else 40)), 0, 60).astype(np.int64)
        place = (k * 64 + step) * 2654435761 % 2**32 * MEASURE_BINS >> 32
        marks[np.arange(len(measured)), place] += 0.5
    return np.concatenate([grams, marks, np.ones((len(measured), 1), np.float32)], axis=1).astype(np.float32)


def fit(x: np.ndarray, soft: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient steps; classes weigh alike."""
    weights, ahead = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    if not len(soft):
        return weights
    share = float(np.clip(soft.mean(), 0.02, 0.98))
    balance = soft * 0.5 / share + (1 - soft) * 0.5 / (1 - share)
    rate = 4.0 / (np.einsum("ij,ij->i", x, x).max() * balance.max() + decay)
    for step in range(rounds):
        # In the features' own precision: a product in double would copy all of them.
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30).astype(np.float64)))
        pull = ((p - soft) * balance / len(soft)).astype(np.float32)
        moved = ahead - np.float32(rate) * (pull @ x + np.float32(decay) * ahead)
        ahead = moved + np.float32(step / (step + 3)) * (moved - weights)
        weights = moved
    return weights


def _voter(fraction: float):
    schema = pa.schema([("pattern", pa.int32()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "text", rows=_ROWS):
                part = whole.slice(a, b - a)
                measured = measures(part.column("text"))
                part = part.filter(pa.array(measured[:, -1] > 0))
                measured = measured[measured[:, -1] > 0]
                drawn = part.column("draw").to_numpy() < fraction
                taken = np.flatnonzero(drawn)
                rows = features(part.column("text").take(pa.array(taken)), measured[taken])
                listed: list = [None] * len(measured)
                for i, row in zip(taken, rows, strict=True):
                    listed[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pattern_of(votes(measured)), pa.int32()), pa.array(listed, pa.binary())], schema=schema
                )

    return run


def _scorer(weights: np.ndarray, known: dict[int, float], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "text", rows=_ROWS):
                part = whole.slice(a, b - a)
                measured = measures(part.column("text"))
                empty = measured[:, -1] == 0
                patterns = pattern_of(votes(measured))
                logits = (features(part.column("text"), measured) @ weights).astype(np.float64)
                score = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
                posterior = np.array([known.get(int(p), 0.5) for p in patterns], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(measured[:, -1].astype(np.int64)),
                        pa.array(patterns, pa.int32(), mask=empty),
                        pa.array(posterior, mask=empty),
                        pa.array(score, mask=empty),
                        pa.array((score >= threshold) & ~empty),
                    ],
                    names=["doc_id", "n_words", "votes", "weak_label", "score", "kept"],
                )

    return run


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, n_words, votes, weak_label, score, kept)`` for each row of ``docs``.

    ``votes`` codes the pattern of votes (see :func:`votes_of`), ``weak_label`` is its
    posterior, ``score`` the classifier's probability that the text is good, ``kept``
    whether it reaches ``threshold``. A text without words is not kept and has null for
    the rest. Rows may repeat; equal texts get equal scores. The id may have any type,
    also a struct that carries a whole row. Other columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fraction = sample / max(1, docs.count())
    # Drawn by what the row holds, so a task that runs again draws the same rows.
    draw = (F.pmod(F.xxhash64("doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))), F.lit(1 << 30)) / (1 << 30)).alias("draw")
    voted = settle(docs.select("text", draw).mapInArrow(_voter(fraction), "pattern int, features binary"))
    counted = voted.groupBy("pattern").agg(F.count("*").alias("n")).sort("pattern").collect()
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    post, _, _ = accuracies(votes_of(patterns), np.array([r["n"] for r in counted], float))
    known = dict(zip(patterns.tolist(), post.tolist(), strict=True))
    width = TEXT_BINS + MEASURE_BINS + 1
    drawn = voted.where("features is not null").sort("pattern", "features").limit(2 * sample).toArrow()
    x = np.zeros((drawn.num_rows, width), np.float32)
    for i, row in enumerate(drawn["features"]):
        x[i] = np.frombuffer(row.as_buffer(), np.float32)
    soft = np.array([known[p] for p in drawn["pattern"].to_pylist()])
    del drawn
    weights = fit(x, soft)
    spec = StructType([docs.schema["doc_id"]])
    for name, kind in (("n_words", "long"), ("votes", "integer"), ("weak_label", "double"), ("score", "double"), ("kept", "boolean")):
        spec = spec.add(name, kind)
    return docs.mapInArrow(_scorer(weights.astype(np.float32), known, threshold), spec)
