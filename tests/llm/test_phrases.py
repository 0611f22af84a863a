"""Phrase mining against a plain version."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkvec.llm import phrases


def plain(docs, least, best):
    counts, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    held = {p: a for p, a in counts.items() if a >= least and len(p[1]) > 1}
    covered = set()
    for (lang, w), a in held.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= 80 * held[lang, w[i : i + k]]:
                    covered.add((lang, w[i : i + k]))
    found = collections.defaultdict(list)
    for (lang, w), a in held.items():
        if (lang, w) not in covered:
            cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:best], 1)
    }


def made(seed, n):
    rng = random.Random(seed)
    words = ["Aa", "b", "ünï", "cc", "dd\x1cd", "E", "f-f", "g", "zu", "h\xa0h"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!", "?x ", " ; ", "\r\n", "\x0b"]
    out = []
    for _ in range(n):
        w = [rng.choice(words[: rng.randint(2, 10)]) for _ in range(rng.randint(0, 60))]
        out.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(x + rng.choice(gaps) for x in w)))
    return out


def frame(spark, docs):
    df = spark.createDataFrame(docs, "lang string, text string")
    return df.selectExpr("*", "'x' as id", "1 as a", "2 as block", "'y' as word", "'z' as phrase").repartition(3)


def test_phrases_match_plain_version(spark, monkeypatch):
    docs = made(1, 300) + [("en", None), ("en", ""), (None, " . ,\t"), ("de", "rare words only here")]
    for least, best in ((30, 2000), (8, 7)):
        got = phrases.collocations(frame(spark, docs), least=least, best=best).collect()
        assert {tuple(r) for r in got} == plain(docs, least, best) and len(got) == len(plain(docs, least, best))
    monkeypatch.setattr(phrases, "SLICE", 40)
    monkeypatch.setattr(phrases, "BLOCK", 64)
    got = phrases.collocations(frame(spark, docs), least=8, best=50).collect()
    assert {tuple(r) for r in got} == plain(docs, 8, 50)


def test_slices_lose_nothing():
    for text in (b"", b"a" * 100, b"aa bb. cc" * 30, b" " * 50, b"." * 50, b"word " * 20 + b"x" * 90 + b" tail. end"):
        parts = list(phrases._slices(text, 16))
        assert b"".join(parts) == text
        assert b" ".join(parts).replace(b".", b" . ").split() == text.replace(b".", b" . ").split()


def test_long_texts_and_empty_tables(spark, odd_docs, no_docs):
    long = [("en", "x y " * 60_000), ("en", "q" * 300_000)]
    got = {tuple(r) for r in phrases.collocations(frame(spark, long)).collect()}
    assert got == plain(long, 30, 2000)
    odd = [(r.lang, r.text) for r in odd_docs.collect()]
    assert {tuple(r) for r in phrases.collocations(odd_docs).collect()} == plain(odd, 30, 2000)
    assert phrases.collocations(no_docs).collect() == []


def test_products_beyond_64_bits(spark):
    big = 3 * 10**17
    row = spark.createDataFrame([(big,)], "a long").selectExpr(
        f"cast({phrases.SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) div cast(a + a + 1 as decimal(20,0)) as score"
    )
    assert row.first()[0] == 2_000_000 * big // (2 * big + 1)


def test_blocks_send_a_row_to_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 512)
    written, made = phrases.written, []

    def counting(df, name):
        table, path = written(df, name)
        made.append((name, table.count(), table.where("a is not null").count() if "a" in table.columns else 0))
        return table, path

    monkeypatch.setattr(phrases, "written", counting)
    docs = [("en", " ".join(f"w{(i * j) % 40}" for i in range(400))) for j in range(1, 60)]
    got = {tuple(r) for r in phrases.collocations(frame(spark, docs)).collect()}
    assert got and got == plain(docs, 30, 2000)
    # What is sent for the groups is a row for each block (and bucket), not for each of their groups.
    sent = [rows - own for name, rows, own in made if name == "groups"]
    assert len(sent) == 4 and max(sent) <= 20 and max(own for *_, own in made) >= 40


def test_buckets_and_wide_numbers(spark, monkeypatch):
    docs = made(5, 300)
    monkeypatch.setattr(phrases, "BLOCK", 256)
    monkeypatch.setattr(phrases, "BUCKET", 2000)
    got = phrases.collocations(frame(spark, docs), least=8, best=100).collect()
    assert {tuple(r) for r in got} == plain(docs, 8, 100)
    wide = np.array([0, 1, 255, 256, 2**40, 2**62])
    for values, kind in ((wide, "<i8"), (wide[:4], "<i4"), (wide[:0], "<i8")):
        assert phrases._unpack(phrases._pack(values, kind), len(values), kind).tolist() == values.tolist()
    # Ids whose product passes a long are told apart all the same.
    first, last = np.array([5, 2**61, 2**61, 2**61]), np.array([7, 7, 2**60, 7])
    packed = {"first": np.diff(first, prepend=0), "last": last, "seen": np.array([3, 1, 2, 4])}
    row = {"block": 0, "bucket": 3, "base": 0, "n": 4, **{k: phrases._pack(v) for k, v in packed.items()}}
    own = phrases._pair_counter(3, 8)(pa.Table.from_pylist([row], schema=phrases._ARROW)).filter(pc.field("id").is_valid())
    assert {(r["first"], r["last"], r["a"]) for r in own.to_pylist()} == {(2**61, 7, 5), (5, 7, 3)}


def test_many_languages(spark):
    docs = [(f"l{i % 150}", "a b c. " * 20 + f"w{i}") for i in range(600)]
    got = phrases.collocations(frame(spark, docs)).collect()
    assert {tuple(r) for r in got} == plain(docs, 30, 2000) and len({r.lang for r in got}) == 150
