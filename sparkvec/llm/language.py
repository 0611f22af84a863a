"""Language identification by fusing evidence with Bayes' rule.

Four pieces of evidence about a text: the likelihood of its letter trigrams in each
language, the language its markup declares, the suffix of its address, and a prior from
its host. Trigram models are trained on the declared languages over all rows. How far a
declaration and a suffix can be trusted is the grouped count of their values by the
language that the trigrams alone favour. The prior of a host is smoothed with that of
its domain, and that one with the whole table's, both from grouped counts; a row's own
vote is taken out of its prior.

Texts are read twice and never shuffled. What is shuffled is a row of scores for each
text, joined to the counts of its host: the counts are summed before they move, and the
join may split a host with a third of all rows. Languages are all codes that at least
``LEAST_ROWS`` rows declare, whatever the size of the table; codes have two or three
letters, so models are bounded whatever the column holds. Counts of values are kept for
the languages they were seen with alone.

One more hypothesis, "none of these", has a background model: half the mean of the
languages' models and half all trigrams alike. Its probability is part of the sum that
a language's is divided by, so a text that it explains best is not kept. Trigrams
without a letter (blanks, digits, marks) say nothing about any hypothesis.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .text import chunks, gram_counts, utf8

BINS = 4096
#: A text weighs as many trigrams at most: neighbouring trigrams are not independent.
WEIGHT = 200
#: Rows of the wider group that a host or a domain is smoothed with.
SMOOTH = 10.0
LEAST_ROWS = 3
THRESHOLD = 0.5
_ROWS = 1000


def evidence(
    table: DataFrame, id_col: str, text: Column, declared: Column, host: Column
) -> DataFrame:
    """The columns the operator reads: ``id, text, declared, host, domain, suffix``."""
    name = F.lower(F.trim(host))
    labels = F.split(name, r"\.")
    table = table.select(F.col(id_col).alias("id"), text.alias("text"), F.lower(F.trim(declared)).alias("declared"), name.alias("host"), labels.alias("labels"))
    dotted = F.size("labels") > 1
    return table.select(
        "id",
        "text",
        F.regexp_extract("declared", "^[a-z]{2,3}", 0).alias("declared"),
        "host",
        F.when(dotted, F.concat_ws(".", F.slice("labels", -2, 2))).otherwise(F.col("host")).alias("domain"),
        F.when(dotted, F.element_at("labels", -1)).alias("suffix"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of documents: ``lang`` is the declared language, ``source`` the host."""
    return evidence(docs, "doc_id", F.col("text"), F.col("lang"), F.col("source"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of raw web pages: visible text, the ``lang`` of the markup, the host of the address."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    visible = F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[A-Za-z0-9#]{1,10};", " ")
    declared = F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return evidence(pages, "page_id", visible, declared, F.regexp_replace(host, r"(?i)^(www|m)\.", ""))


#: The bin of the trigram without a letter.
_BLANK = int(np.flatnonzero(gram_counts(*utf8(pa.array(["   "])), BINS, letters_only=True)[0])[0])


def _letter_grams(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the trigrams with a letter, and the number of all trigrams of each text."""
    counts = gram_counts(*utf8(part.column("text")), BINS, letters_only=True)
    n = counts.sum(axis=1, dtype=np.float64)
    counts[:, _BLANK] = 0
    return counts, n


def _gram_counter(languages: list[str]):
    places = {x: i for i, x in enumerate(languages)}
    schema = pa.schema([("language", pa.int32()), ("bin", pa.int32()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for whole in batches:
            for a, b in chunks(whole, "text", rows=_ROWS):
                part = whole.slice(a, b - a)
                counts = _letter_grams(part)[0]
                which = np.array([places.get(x, -1) for x in part.column("declared").to_pylist()])
                for language in np.unique(which[which >= 0]).tolist():
                    total.setdefault(language, np.zeros(BINS))
                    total[language] += counts[which == language].sum(axis=0)
        for language, sums in total.items():
            column = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(column), language), pa.int32()), pa.array(column, pa.int32()), pa.array(sums[column])], schema=schema
            )

    return run


def _scorer(logs: np.ndarray, carried: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in chunks(whole, "text", rows=_ROWS):
                part = whole.slice(a, b - a)
                counts, n = _letter_grams(part)
                lettered = counts.sum(axis=1, dtype=np.float64)
                scores = (counts @ logs.T.astype(np.float32)).astype(np.float64) * (np.minimum(lettered, WEIGHT) / np.maximum(lettered, 1))[:, None]
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1) * logs.shape[0], pa.int32()), pa.array(scores.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried] + [pa.array(n.astype(np.int64)), pa.array(lettered > 0), listed], names=[*carried, "n_grams", "lettered", "scores"]
                )

    return run


def _counts_by(scored: DataFrame, key: str) -> DataFrame:
    """``(key, counts)``: rows of each key by the hypothesis that the text favours, as a map."""
    each = scored.where(F.col(key).isNotNull() & F.col("favoured").isNotNull()).groupBy(key, "favoured").agg(F.count("*").cast("double").alias("n"))
    return each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("favoured", "n"))).alias(f"by_{key}"))


def identify(
    table: DataFrame,
    languages: Sequence[str] | None = None,
    wanted: Sequence[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, language, probability, text_language, declared, n_grams, kept)`` per row of :func:`evidence`.

    ``kept`` rows have text, a language of ``wanted`` (all, if not given) and at least
    the probability ``threshold``. ``language`` is the likeliest language and
    ``probability`` its own, also if "none of these" is likelier; ``text_language`` is
    null where the trigrams favour none. Missing evidence is neutral; a text without a
    trigram that holds a letter says nothing, its language comes from the rest, and it is
    not kept. Ties go to
    the language first in the alphabet. Without any language to choose from, language
    and probability are null. Every row has one result row, also with repeated ids.
    """
    carried = ["id", "declared", "host", "domain", "suffix"]
    if languages is None:
        named = table.where("declared <> ''")
        often = named.groupBy("declared").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS)
        languages = [r["declared"] for r in often.collect()]
    languages = sorted(set(languages))
    if not languages:
        nothing = {"language": "string", "probability": "double", "text_language": "string"}
        return table.select(
            "id", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()), "declared", F.lit(0).cast("long").alias("n_grams"), F.lit(False).alias("kept")
        )
    width = len(languages)
    counted = table.select("text", "declared").mapInArrow(_gram_counter(languages), "language int, bin int, n double")
    grams = np.full((width, BINS), 0.5)
    for r in counted.groupBy("language", "bin").agg(F.sum("n").alias("n")).collect():
        grams[r["language"], r["bin"]] += r["n"]
    models = grams / grams.sum(axis=1, keepdims=True)
    logs = np.log(np.vstack([models, 0.5 * models.mean(axis=0) + 0.5 / BINS]))
    hypotheses = width + 1  # the last is "none of these"
    types = dict(table.dtypes)
    spec = ", ".join(f"{c} {types[c]}" for c in carried) + ", n_grams long, lettered boolean, scores array<double>"
    scored = table.select(*carried, "text").mapInArrow(_scorer(logs, carried), spec)
    scored = settle(
        scored.withColumn("favoured", F.when(F.col("lettered"), F.array_position("scores", F.array_max("scores")).cast("int") - 1))
    )

    overall, named, suffixed = (np.zeros(hypotheses) for _ in range(3))
    voted = scored.where("favoured is not null").groupBy("favoured")
    for r in voted.agg(F.count("*").alias("n"), F.count("declared").alias("d"), F.count("suffix").alias("s")).collect():
        overall[r["favoured"]], named[r["favoured"]], suffixed[r["favoured"]] = r["n"], r["d"], r["s"]
    overall = ((overall + 1) / (overall + 1).sum()).tolist()

    joined = scored
    for key in ("declared", "suffix"):  # few values as a rule: written first, so Spark knows their size
        joined = joined.join(settle(_counts_by(scored, key)), key, "left")
    joined = joined.join(_counts_by(scored, "host"), "host", "left").join(_counts_by(scored, "domain"), "domain", "left")

    def others(counts: str, own: Column, i: Column) -> Column:
        """Rows but the own one that have the value and favour hypothesis i."""
        return F.coalesce(F.try_element_at(F.col(counts), i) - F.when(own == i, 1.0).otherwise(0.0), F.lit(0.0))

    def values(counts: str, own: Column, totals: np.ndarray) -> Column:
        """Log P(value | hypothesis). A share of all rows is added, so rare values say little and unseen ones nothing."""
        each, added = F.array(*(F.lit(float(t + 1)) for t in totals)), SMOOTH / float((totals + 1).sum())
        return F.transform(each, lambda t, i: F.log(others(counts, own, i) / t + F.lit(added)))

    def smoothed(counts: str, own: Column, wider: Column) -> Column:
        rest = F.coalesce(F.aggregate(F.map_values(F.col(counts)), F.lit(0.0), lambda a, x: a + x) - F.when(own.isNotNull(), 1.0).otherwise(0.0), F.lit(0.0))
        return F.transform(
            wider,
            lambda p, i: (others(counts, own, i) + SMOOTH * p) / (rest + SMOOTH),
        )

    own = F.col("favoured")
    joined = joined.withColumn("prior", smoothed("by_domain", own, F.array(*(F.lit(p) for p in overall))))
    joined = joined.withColumn("prior", smoothed("by_host", own, F.col("prior")))
    parts = F.arrays_zip("scores", values("by_declared", own, named).alias("d"), values("by_suffix", own, suffixed).alias("s"), "prior")
    joined = joined.withColumn("parts", parts).withColumn(
        "logs", F.transform("parts", lambda x: x["scores"] + x["d"] + x["s"] + F.log(x["prior"]))
    )
    real = F.slice("logs", 1, width)
    best = F.array_max(real)
    names = F.array(*(F.lit(x) for x in languages))
    out = joined.select(
        "id",
        F.element_at(names, F.array_position(real, best).cast("int")).alias("language"),
        (1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - best))).alias("probability"),
        F.get(names, own).alias("text_language"),
        "declared",
        "n_grams",
        "lettered",
    )
    keep = F.col("lettered") & (F.col("probability") >= threshold)
    if wanted is not None:
        keep &= F.col("language").isin(list(wanted))
    return out.withColumn("kept", F.coalesce(keep, F.lit(False))).drop("lettered")
