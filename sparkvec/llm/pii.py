"""Personal data in texts by weak supervision, in DataFrame functions alone.

Exact patterns give the base spans; wider patterns give further candidates (spelled-out
mail addresses, national phone numbers, long addresses, dotted card numbers). Five
labellers vote on each candidate or abstain: its pattern, a check of its content, cue
words in front of it, the characters around it, and gazetteers of values that belong to
nobody. Expectation-maximisation over the counts of vote patterns estimates how far each
labeller can be trusted; the posteriors of the patterns then train the final classifier,
a naive Bayes model over the shape of a span, which decides on the further candidates.
Base spans always stay.

Both models are functions of one grouped count whose size depends on the number of
labellers and shapes, not on the texts; it is all that reaches the driver. Texts are
read twice, nothing of them is shuffled, and a pattern only runs on texts that hold a
character it needs. Each pattern starts at most once in a run of characters and repeats
groups a bounded number of times, so a text costs time in proportion to its length.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns, each equal to its plain form: a lookbehind keeps a failed match from
# being tried again inside the same run of characters. Labels of a host are a possessive
# group, which Java repeats in a loop and not by recursion, so they need no bound.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # All of a run of digits with single blanks or hyphens, if it has 16 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDER = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}(?: ?[(\[]at[)\]] ?| at )[a-z0-9-]{1,63}(?:(?: ?[(\[]dot[)\]] ?| dot |\.)[a-z0-9-]{2,24}){1,4}(?![a-z0-9-])",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?![0-9.])",
    "phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])|(?<![0-9A-Za-z+().-])00[1-9](?:[\x20.()-]{0,2}[0-9]){7,12}(?![0-9A-Za-z-])",
}
#: A cheap test that every text with a match passes.
_NEEDS: dict[tuple[str, bool], Callable[[Column], Column]] = {
    ("email", True): lambda t: F.contains(t, F.lit("@")),
    ("ip", True): lambda t: t.rlike(r"[0-9]\.[0-9]"),
    ("card", True): lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
    ("phone", True): lambda t: F.contains(t, F.lit("+")),
    ("email", False): lambda t: t.rlike(r"(?i)[(\[]at[)\]]| at [a-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?| dot |\.)[a-z0-9-]"),
    ("ip", False): lambda t: t.rlike(r":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"),
    ("card", False): lambda t: t.rlike(r"[0-9]{4}\.[0-9]{4}"),
    ("phone", False): lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}|00[1-9]"),
}

CUES = {
    "email": "mail|e-mail|contact|write to|kontakt|courriel|correo|adresse",
    "ip": "ip|address|host|server|client|from|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|whatsapp|telefon|handy|appel|llama",
}
ANTI_CUES = "version|isbn|issn|doi|order no|invoice|serial|section|chapter|figure|table"
TOP_LEVEL = "com org net edu gov io co info biz de fr es uk it nl eu us ca at ch".split()
ROLE_NAMES = "noreply no-reply donotreply postmaster webmaster mailer-daemon".split()
VOTES = ("by_pattern", "by_content", "by_cue", "by_edge", "by_gazetteer")
SHAPES = ("f_length", "f_digits", "f_left", "f_right", "f_marks")
ROUNDS = 40

_SPAN = "array<struct<s:int,e:int,v:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value) in code points, left to right.

    The texts between the matches and the matches alternate, so their lengths add up
    to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        found,
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
        lambda m, gap: F.struct(m.alias("m"), F.char_length(gap).alias("gap"), F.char_length(m).alias("n")),
    )

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        return F.struct(
            (start + x["n"]).alias("at"),
            F.concat(done["out"], F.array(F.struct(start.alias("s"), (start + x["n"]).alias("e"), x["m"].alias("v")))).alias("out"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.aggregate(steps, empty, add, lambda done: done["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return luhn(_digits(value))
    return F.char_length(_digits(value)).between(8, 15)


def _spans(text: Column, kind: str, base: bool) -> Column:
    pattern = (BASE if base else WIDER)[kind]
    found = _matches(text, pattern)
    if base:
        found = F.filter(found, lambda x: _valid(kind, x["v"]))
    return F.when(_NEEDS[kind, base](text), found).otherwise(F.array().cast(_SPAN))


def _with_spans(docs: DataFrame) -> DataFrame:
    """Adds ``base_<kind>`` and ``wide_<kind>``; a wider span overlaps no base span."""
    docs = docs.select("*", *(_spans(F.col("text"), k, True).alias(f"base_{k}") for k in KINDS))
    docs = docs.select("*", F.concat(*(F.col(f"base_{k}") for k in KINDS)).alias("base"))

    def apart(x: Column) -> Column:
        return ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))

    return docs.select("*", *(F.filter(_spans(F.col("text"), k, False), apart).alias(f"wide_{k}") for k in KINDS))


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 no opinion; without ``no`` everything but yes is against."""
    if no is None:
        return F.when(yes, 1).otherwise(0)
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _looks(text: Column, kind: str, base: bool, x: Column) -> Column:
    """The votes on a span and its shape, each one of a few small numbers."""
    value, digits = x["v"], _digits(x["v"])
    before = F.lower(F.substring(text, F.greatest(x["s"] - 39, F.lit(1)), F.least(x["s"], F.lit(40))))
    left, right = F.substring(text, x["s"], F.when(x["s"] > 0, 1).otherwise(0)), F.substring(text, x["e"] + 1, F.lit(1))
    if kind == "email":
        names = F.split(F.lower(value), r"@|[(\[]at[)\]]| at ")
        content = F.regexp_extract(F.lower(value), r"([a-z0-9-]+)$", 1).isin(TOP_LEVEL)
        someone = ~F.trim(F.element_at(names, 1)).isin(ROLE_NAMES)
    elif kind == "ip":
        content = ~value.rlike(r"(^|\.)0[0-9]") & ~value.rlike(r"^(0|127|255)\.")
        someone = ~value.rlike(r"^(10|192\.168|169\.254)\.|^(fe80|fc|fd|0000)")
    else:
        content = (luhn(digits) & digits.rlike("^[3-6]")) if kind == "card" else F.char_length(digits).between(10, 13)
        someone = F.size(F.array_distinct(F.split(digits, ""))) > 3

    def side(c: Column) -> Column:
        return F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"^\w$"), 1).when(c.rlike(r"^[,.;:!?()]$"), 2).otherwise(3)

    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(int(base)).alias("base"),
        F.lit(1 if base else -1).alias("by_pattern"),
        _vote(content).alias("by_content"),
        _vote(before.rlike(rf"\b({CUES[kind]})\b"), before.rlike(rf"\b({ANTI_CUES})\b")).alias("by_cue"),
        _vote(~left.rlike(r"[\w=/\"]") & ~right.rlike(r"[\w=/\"]")).alias("by_edge"),
        _vote(someone).alias("by_gazetteer"),
        F.least(F.floor(F.char_length(value) / 4), F.lit(9)).cast("int").alias("f_length"),
        F.least(F.floor(F.char_length(digits) / 2), F.lit(10)).cast("int").alias("f_digits"),
        side(left).alias("f_left"),
        side(right).alias("f_right"),
        F.least(F.size(F.regexp_extract_all(value, F.lit("[^0-9A-Za-z]"), F.lit(0))), F.lit(6)).alias("f_marks"),
    )


def _looks_of_all(text: Column) -> Column:
    def looks(kind: str, base: bool) -> Column:
        return F.transform(f"{'base' if base else 'wide'}_{kind}", lambda x: _looks(text, kind, base, x))

    return F.concat(*(looks(kind, base) for kind in KINDS for base in (True, False)))


def reliabilities(rows: list, rounds: int = ROUNDS) -> tuple[list[float], dict[str, list[tuple[float, float]]], float]:
    """Posterior of each row of counted vote patterns; each labeller's (hits, false alarms); the prior.

    A two-class model in which labellers err independently and may abstain. It starts
    from labellers that are right 4 times in 5, which fixes what class 1 means.
    """
    rates = {v: (0.8, 0.2) for v in VOTES}
    prior, posts = 0.5, [0.5] * len(rows)
    for _ in range(rounds if rows else 0):
        for i, row in enumerate(rows):
            odds = math.log(prior / (1 - prior))
            for v in VOTES:
                hit, false = rates[v]
                if row[v] >= 0:
                    odds += math.log(hit / false) if row[v] else math.log((1 - hit) / (1 - false))
            posts[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(r["n"] for r in rows)
        prior = (sum(p * r["n"] for p, r in zip(posts, rows, strict=True)) + 1) / (total + 2)
        for v in VOTES:
            sums = [[8.0, 10.0], [2.0, 10.0]]  # a weak belief in the start
            for p, r in zip(posts, rows, strict=True):
                if r[v] >= 0:
                    for side, weight in ((0, p), (1, 1 - p)):
                        sums[side][0] += weight * r["n"] * r[v]
                        sums[side][1] += weight * r["n"]
            rates[v] = tuple(min(0.999, max(0.001, a / b)) for a, b in sums)  # type: ignore[assignment]
    return posts, rates, prior


def train(docs: DataFrame) -> dict[str, dict[str, float]]:
    """Log odds of each shape value, by shape, with ``""`` for the prior; from ``docs(text)``."""
    looks = _with_spans(docs.select("text")).select(F.explode(_looks_of_all(F.col("text"))).alias("x")).select("x.*")
    rows = looks.groupBy("kind", "base", *VOTES, *SHAPES).agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: tuple(r))
    posts, _, _ = reliabilities(rows)
    totals = [1.0, 1.0]
    counts: dict[str, dict[str, list[float]]] = {f: {} for f in SHAPES}
    for p, r in zip(posts, rows, strict=True):
        for side, weight in ((0, p * r["n"]), (1, (1 - p) * r["n"])):
            totals[side] += weight
            for f in SHAPES:
                counts[f].setdefault(f"{r['kind']}{r[f]}", [1.0, 1.0])[side] += weight
    weights = {"": {"": math.log(totals[0] / totals[1])}}
    for f, values in counts.items():
        sums = [sum(v[side] for v in values.values()) for side in (0, 1)]
        weights[f] = {key: math.log(yes / sums[0]) - math.log(no / sums[1]) for key, (yes, no) in values.items()}
    return weights


def _score(weights: dict[str, dict[str, float]], look: Column) -> Column:
    score = F.lit(weights[""][""])
    for f in SHAPES:
        if weights[f]:
            table = F.create_map(*(F.lit(x) for pair in sorted(weights[f].items()) for x in pair))
            score += F.coalesce(F.try_element_at(table, F.concat(look["kind"], look[f].cast("string"))), F.lit(0.0))
    return score


def _all(weights: dict[str, dict[str, float]], kind: str) -> Column:
    """The base spans of a kind and the wider ones that the classifier takes."""
    more = F.filter(f"wide_{kind}", lambda x: _score(weights, _looks(F.col("text"), kind, False, x)) > 0)
    return F.concat(F.col(f"base_{kind}"), more)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, base_<kind>..., all_<kind>...)``: arrays of ``(s, e, v)`` spans by kind.

    Places count code points from 0, the end is exclusive, spans are in order of start.
    A null text has no spans; every row of ``docs`` has one result row. Other columns of
    ``docs`` are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    weights = train(docs)

    found = _with_spans(docs)
    return found.select("doc_id", "text", *(f"base_{k}" for k in KINDS), *(F.array_sort(_all(weights, k)).alias(f"all_{k}") for k in KINDS))


def listed(prefix: str) -> Column:
    """The spans of the four columns as ``kind:start:end``, comma-joined, by kind and start."""
    def of(kind: str) -> Column:
        return F.transform(f"{prefix}_{kind}", lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))

    return F.concat_ws(",", F.concat(*(of(k) for k in KINDS)))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digest of the base spans, and the list of all spans, for each row."""
    return find(docs, id_col, text_col).select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("all").alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in angle brackets.

    Overlapping spans of several kinds become one mark of the first kind. Null texts
    stay null; all other columns and rows stay as they are.
    """
    weights = train(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    held = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = _with_spans(held)

    def marks(kind: str) -> Column:
        return F.transform(_all(weights, kind), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k")))

    found = found.select("row", "text", F.array_sort(F.concat(*(marks(k) for k in KINDS))).alias("spans"))

    def add(done: Column, x: Column) -> Column:
        fresh = x["s"] >= done["at"]
        gap = F.substring(F.col("text"), done["at"] + 1, x["s"] - done["at"])
        return F.struct(
            F.greatest(done["at"], x["e"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, F.lit("<"), x["k"], F.lit(">"))).otherwise(done["out"]).alias("out"),
        )

    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add)
    whole = F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.char_length("text")))
    text = F.when(F.size("spans") > 0, whole).otherwise(F.col("row").getField(text_col))
    return found.select(*(text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
