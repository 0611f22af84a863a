"""Licence notices in texts, by a positional index of rare words, in DataFrame functions alone.

A notice is a label, a wording and the key phrases that must stand in it. How rare a
licence word is (its IDF) is counted over all documents. The index lists, for each
notice, the places of its rarest words, and for each key phrase its rarest word. A text
looks up those of its words that the index holds; nothing else of it leaves its row.

* A posting's place in the text less its place in the notice is where the notice would
  begin. Postings that agree on it within half a window (edits shift them) are counted.
* A key phrase is verified word by word around its rare word. Each of its occurrences
  holds that word, so none is missed.

A notice stands where its rare words agree to a share of ``SHARE`` and all its key phrases
are verified in the same window. A notice that is one phrase stands where the phrase does.

The index grows with the notices, not with the texts, and is broadcast; it and the counts
of the notices' words are all that reaches the driver. Lookups of one text are summed in
their task before the shuffle, so a hot text or word sends one row for each window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word of a text in which A to Z are lower-case: all but the other ASCII characters.
#: (Java runs the negated class of several ranges eight times slower.)
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: Rare words looked up for each notice, and the share of them that must agree.
RARE, SHARE = 16, 0.6
#: Words between the first and the last beginning that count as one place.
WINDOW = 32


@dataclass(frozen=True)
class Notice:
    """A wording; ``keys`` are phrases of it. Without keys the whole wording is the key."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return split(self.text)

    @property
    def phrase(self) -> bool:
        return not self.keys


# Phrases of the contract, then public licence notices and their common names.
NOTICES = (
    Notice("gpl", "gnu general public license", base=True),
    Notice("apache", "apache license", base=True),
    Notice("cc-by", "cc by", base=True),
    Notice("mit", "mit license", base=True),
    Notice("agpl", "gnu affero general public license"),
    Notice("bsd", "bsd license"),
    Notice("bsl", "boost software license"),
    Notice("cc-by-nc", "cc by nc"),
    Notice("cc-by-nd", "cc by nd"),
    Notice("cc-by-sa", "cc by sa"),
    Notice("cc0", "cc0 1 0 universal"),
    Notice("epl", "eclipse public license"),
    Notice("isc", "isc license"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mpl", "mozilla public license"),
    Notice("unlicense", "released into the public domain"),
    Notice(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Notice(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
        ("redistribution and use in source and binary forms", "redistributions of source code must retain"),
    ),
    Notice(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Notice(
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS",
        ("except in compliance with the license", "www apache org licenses license 2 0"),
    ),
    Notice(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        ("gnu general public license as published by the free software foundation",),
    ),
    Notice(
        "cc-by",
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this "
        "license, visit http://creativecommons.org/licenses/by/4.0/",
        ("creative commons attribution 4 0", "creativecommons org licenses by 4 0"),
    ),
)


def split(text: str) -> list[str]:
    """The words of a notice, which holds ASCII only."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def words_of(text: Column) -> Column:
    """The words of a text, in order.

    Letters beyond A to Z that have a small form may be written small too; they stay
    letters beyond ASCII. The one whose small form is a plain ``k`` is kept apart.
    """
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))), F.lit(WORD), F.lit(0))


def _place(words: list[str], part: list[str]) -> int:
    for at in range(len(words) - len(part) + 1):
        if words[at : at + len(part)] == part:
            return at
    raise ValueError(f"{' '.join(part)!r} is no part of its notice")


def index_rows(notices: tuple[Notice, ...], seen: dict[str, int]) -> list[tuple]:
    """Postings ``(look, notice, bit, pos, off, key)``; ``off`` and ``key`` are null for rare words.

    ``seen`` is how many documents hold a word. Each posting of a notice has a bit, rare
    words and key phrases on their own.
    """
    rows = []
    for n, notice in enumerate(notices):
        words, rare = notice.words, []
        for word in sorted(set(words), key=lambda w: (seen.get(w, 0), w))[:RARE] if not notice.phrase else []:
            rare += [(at, word) for at, w in enumerate(words) if w == word]
        rows += [(w, n, 1 << bit, at, None, None) for bit, (at, w) in enumerate(rare[:60])]
        for bit, key in enumerate([split(k) for k in notice.keys] or [words]):
            off = min(range(len(key)), key=lambda i: (seen.get(key[i], 0), key[i], i))
            rows.append((key[off], n, 1 << bit, _place(words, key), off, key))
    return rows


def document_counts(docs: DataFrame, notices: tuple[Notice, ...], text_col: str = "text") -> dict[str, int]:
    """How many of ``docs`` hold each word of the notices."""
    held = F.array(*(F.lit(w) for w in sorted({w for n in notices for w in n.words})))
    found = docs.select(F.explode(F.array_intersect(words_of(F.col(text_col)), held)).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _places(docs: DataFrame, notices: tuple[Notice, ...], id_col: str, text_col: str) -> DataFrame:
    """``(row, doc_id, n_words, label, base, start, share, places)``: at least one row for each text.

    Rows whose ``label`` is null are looked-up words that came to nothing.
    """
    spark = docs.sparkSession
    postings = index_rows(notices, document_counts(docs, notices, text_col))
    index = spark.createDataFrame(postings, "look string, notice int, bit long, pos int, off int, key array<string>")
    looks = sorted({p[0] for p in postings})
    reach = max(len(p[5]) for p in postings if p[5])
    words = F.coalesce(words_of(F.col(text_col)), F.array().cast("array<string>"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words.alias("words"))

    def looked(x: Column) -> Column:
        # The words around it that a key phrase can reach, and where they begin.
        begin = F.greatest(x["at"] - reach, F.lit(0))
        return F.struct(x["look"].alias("look"), x["at"].alias("at"), begin.alias("begin"), F.slice("words", begin + 1, x["at"] - begin + reach).alias("near"))

    placed = F.transform("words", lambda w, i: F.struct(w.alias("look"), i.alias("at")))
    hits = F.transform(F.filter(placed, lambda x: x["look"].isin(looks)), looked)
    some = F.arrays_overlap("words", F.array(*(F.lit(w) for w in looks)))
    found = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.explode_outer(F.when(some, hits)).alias("hit"))
    met = found.select("row", "doc_id", "n_words", "hit.*").join(F.broadcast(index), "look", "left")
    # Where the key would begin in ``near``.
    first = F.col("at") - F.col("off") - F.col("begin")
    stands = (first >= 0) & (F.slice("near", F.greatest(first, F.lit(0)) + 1, F.size("key")) == F.col("key"))
    sound = F.col("notice").isNotNull() & (F.col("key").isNull() | F.coalesce(stands, F.lit(False)))
    start = (F.col("at") - F.coalesce("off", F.lit(0))).cast("long")
    diagonal = start - F.col("pos")
    phrase = F.col("notice").isin([n for n, x in enumerate(notices) if x.phrase])
    windows = F.array(2 * F.floor(diagonal / WINDOW), 2 * F.floor((diagonal + WINDOW // 2) / WINDOW) + 1)
    votes = met.select(
        "row", "doc_id", "n_words", F.when(sound, F.col("notice")).alias("notice"),
        F.when(F.col("key").isNull(), F.col("bit")).alias("rare"),
        F.when(F.col("key").isNotNull(), F.col("bit")).alias("verified"),
        F.when(F.col("key").isNotNull(), start).alias("start"),
        F.explode(F.when(~sound, F.array(F.lit(0).cast("long"))).when(phrase, F.array(diagonal)).otherwise(windows)).alias("window"),
    )
    agreed = votes.groupBy("row", "doc_id", "n_words", "notice", "window").agg(
        F.bit_or("rare").alias("rare"), F.bit_or("verified").alias("verified"), F.min("start").alias("start")
    )
    needs = [(n, x.label, x.base, (1 << max(1, len(x.keys))) - 1, sum(p[1] == n and p[5] is None for p in postings)) for n, x in enumerate(notices)]
    needed = spark.createDataFrame(needs, "notice int, name string, is_base boolean, needed long, n_rare int")
    agree = F.when(F.col("n_rare") == 0, 1.0).otherwise(F.bit_count(F.coalesce("rare", F.lit(0).cast("long"))) / F.col("n_rare"))
    held = (F.col("verified") == F.col("needed")) & (agree >= SHARE)
    return agreed.join(F.broadcast(needed), "notice", "left").select(
        "row", "doc_id", "n_words", *(F.when(held, c).alias(n) for n, c in (("label", F.col("name")), ("base", F.col("is_base")), ("start", F.col("start")), ("share", agree)))
    )


def find(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, n_words, found)``: the notices of each text, as sorted structs ``(start, label, base, share)``.

    ``start`` counts words from 0: of a phrase its place, of a longer notice that of its
    first verified key phrase. ``share`` says how much of its rare words agree. A notice
    that stands in two overlapping windows is named once. Null and empty texts have no
    notices. Ids may be null or repeat: rows of ``docs`` are told apart by ``row``. Other
    columns are not looked at.
    """
    one = F.when(F.col("label").isNotNull(), F.struct("start", "label", "base", "share"))
    return _places(docs, notices, id_col, text_col).groupBy("row", "doc_id", "n_words").agg(F.array_sort(F.collect_set(one)).alias("found"))


def summary(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: counts and ends of the base phrases, labels, and a score.

    ``score`` is the largest share of agreeing rare words of a notice that stands in the
    text, 0 without any. Cases as in :func:`find`.
    """
    base = F.col("base")
    places = _places(docs, notices, id_col, text_col).groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return places.drop("row")


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def sql(notices: tuple[Notice, ...] = NOTICES) -> str:
    """The rows of :func:`summary` over ``documents``, as DuckDB text."""
    wordings = ", ".join(f"({n}, '{x.label}', {x.base}, {x.phrase}, {_list(x.words)})" for n, x in enumerate(notices))
    keys = ", ".join(
        f"({n}, {slot}, {_place(x.words, key)}, {_list(key)})"
        for n, x in enumerate(notices)
        for slot, key in enumerate([split(k) for k in x.keys] or [x.words])
    )
    return rf"""
WITH notices(n, label, base, phrase, wording) AS (VALUES {wordings}),
keys(n, slot, pos, phrase) AS (VALUES {keys}),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words
    FROM documents),
occurrences AS (SELECT r, words, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM docs),
seen AS (SELECT word, count(DISTINCT r) AS n_docs FROM occurrences GROUP BY word),
places AS (SELECT n, unnest(wording) AS word, generate_subscripts(wording, 1) - 1 AS pos FROM notices WHERE NOT phrase),
ranked AS (
    SELECT n, word, row_number() OVER (PARTITION BY n ORDER BY coalesce(n_docs, 0), word) AS rarity
    FROM (SELECT DISTINCT n, word FROM places) LEFT JOIN seen USING (word)),
rare AS (SELECT n, word, pos FROM places JOIN ranked USING (n, word) WHERE rarity <= {RARE}),
sizes AS (SELECT n, count(*) AS n_rare FROM rare GROUP BY n),
verified AS (
    SELECT r, k.n, slot, pos, i AS start FROM occurrences o JOIN keys k ON o.word = k.phrase[1]
    WHERE o.words[i + 1 : i + len(k.phrase)] = k.phrase),
votes AS (
    SELECT r, n, i - pos AS diagonal, pos AS rare, NULL AS slot FROM occurrences JOIN rare USING (word)
    UNION ALL SELECT r, n, start - pos, NULL, slot FROM verified JOIN notices USING (n) WHERE NOT notices.phrase),
windows AS (
    SELECT *, unnest([2 * floor(diagonal / {WINDOW}.0), 2 * floor((diagonal + {WINDOW // 2}) / {WINDOW}.0) + 1]) AS w FROM votes),
agreed AS (
    SELECT r, n, count(DISTINCT rare) / any_value(n_rare) AS share FROM windows JOIN sizes USING (n)
    GROUP BY r, n, w HAVING count(DISTINCT slot) = (SELECT count(*) FROM keys WHERE keys.n = windows.n)),
found AS (
    SELECT r, label, share, false AS base, NULL AS start FROM agreed JOIN notices USING (n) WHERE share >= {SHARE}
    UNION ALL SELECT r, label, 1.0, base, start FROM verified JOIN notices USING (n) WHERE notices.phrase),
summed AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
    CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN summed USING (r)"""
