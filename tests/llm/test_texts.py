"""Operators on texts against plain versions, with odd rows and empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from made_texts import prose
from pyspark.sql import functions as F

from sparkvec import session
from sparkvec.llm import language, lattice_lm, minhash, packing, pieces, pii, quality, text, token_counts

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- words -----------------------------------------------------------------------------


def test_words_match_plain_split():
    texts = ["A b\tA", None, "", "  x", "y ", "é É", "b" * 3_000_000 + " A", "A"]
    hashes, first = text.word_hashes(*text.utf8(pa.array(texts)))
    seen: dict = {}
    for i, t in enumerate(texts):
        words = (t or "").encode().lower().split()
        got = hashes[first[i] : first[i + 1]].tolist()
        assert len(got) == len(words)
        for word, h in zip(words, got, strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# --- near-duplicates -------------------------------------------------------------------


def plain_groups(texts: dict) -> dict:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 85 * len(sets[i] | sets[j]) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    return {i: (len(s), group[i]) for i, s in sets.items()}


def test_near_duplicates(spark):
    base = prose(3, 120).split()
    texts = {10: " ".join(base)}
    for k in range(30):  # copies with one to three words changed, so some pairs link and some do not
        w = list(base)
        for j in range(1 + k % 3):
            w[(k * 13 + j * 41) % len(w)] = f"new{k}{j}"
        texts[11 + k] = " ".join(w)
    texts |= {1: "one two three four", 2: "ONE two three four", 3: "one two three", 4: "", 5: prose(8, 300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(minhash.near_duplicates(df))}
    assert got == plain_groups(texts)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = rows(minhash.near_duplicates(odd_docs))
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert len(got) == 10
    assert [r["component_id"] for r in by_id[6]] == [1, 1] and by_id[1][0]["kept"] and not by_id[6][0]["kept"]
    assert all(by_id[i][0]["n_shingles"] == 0 and by_id[i][0]["kept"] for i in (2, 3, 4))
    assert by_id[None][0]["component_id"] is None and not by_id[None][0]["kept"]
    assert rows(minhash.near_duplicates(no_docs)) == []


def test_blocks_count_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 3000).astype(np.uint64)) for _ in range(7)]
    got = minhash.overlaps(sets[:3], sets[3:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:3]]


# --- packing ---------------------------------------------------------------------------


def check_pieces(got, texts, tokenizer):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, t in texts.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            piece = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing(docs, odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    check_pieces(rows(packing.pack(docs)), {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    got = rows(packing.pack(odd_docs.where("doc_id <> 6")))
    check_pieces(got, {r.doc_id: r.text for r in odd_docs.where("doc_id <> 6").collect()}, tokenizer)
    assert sum(r["length"] for r in rows(packing.pack(odd_docs.where("doc_id = 6")))) == 2 * rows(packing.pack(odd_docs.where("doc_id = 1")))[0]["doc_tokens"]
    assert rows(packing.pack(no_docs)) == []
    for t in ("a  b", "\n\n  x  ", "a \t\tc  d", "x\n  y", "don't 'll <|endoftext|>", "a\x1c b \n  c"):
        want = np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.Encoder.at(packing.VOCABULARY).ids(t) == want


def test_packing_of_marks(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = dict(enumerate([f"a{mark}b", mark, f"{mark}{mark}", f"x  {mark}\n\n y {mark} ", f"<{mark}>", "<|endoftext|", f"a\t {mark} b\u2028{mark}", f"word {mark} " * 3000]))
    assert packing.Encoder.at(packing.VOCABULARY).whole(texts[0]) == np.array([64, 50256, 65], "<u4").tobytes()
    check_pieces(rows(packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))), texts, tokenizer)


def test_first_fit_decreasing():
    lengths = np.sort(np.random.default_rng(2).integers(1, 100, 300))[::-1]
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room: list[int] = []
    for size, b, o in zip(lengths, bins, offsets, strict=True):
        fit = next((i for i, r in enumerate(room) if r >= size), len(room))
        if fit == len(room):
            room.append(100)
        assert (b, o) == (fit, 100 - room[fit])
        room[fit] -= size


# --- personal data ---------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(t):
    def luhn(d):
        return sum((2 * int(c) - 9 * (int(c) > 4) if i % 2 else int(c)) for i, c in enumerate(reversed(d))) % 10 == 0

    def valid(kind, v):
        d = re.sub("[^0-9]", "", v)
        if kind == "ip":
            return all(int(x) <= 255 for x in v.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and luhn(d)
        return kind == "email" or 8 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, t or "") if valid(k, m.group())]


ODD = [
    "a@b.c..x@y.z a@b.c_d@e.f",
    "1.2.3.4.5.6.7.8 999.1.1.1 01.2.3.4",
    "4543 2458 0544 4772 1",
    "é4543-2458-0544-4772, +1 (337) 555-3479 x",
    "😀 mail john at mail dot example dot com or call 555-123-4567",
    "a" * 30_000 + " x@y.zz " + "9" * 30_000,
    "1 " * 20_000,
    "4 5 4 3 2 4 5 8 0 5 4 4 4 7 7 2",
    "++12345678  +1 2 3 4 5 6 7 8 9 ",
    " 4543245805444772-",
    None,
    "",
]


def test_personal_data(spark, docs, no_docs, odd_docs):
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd)
    texts = {r.doc_id: r.text for r in both.collect()}
    got = rows(pii.summary(both))
    assert len(got) == len(texts)
    for r in got:
        want = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in want) for k in PLAIN]
        assert set(want) <= set(r["spans"].split(",")) | {""}
    added = next(r for r in got if r["doc_id"] == 10_004)["spans"]
    assert "email:7:39" in added and "phone:48:60" in added
    assert rows(pii.summary(no_docs)) == [] and len(rows(pii.summary(odd_docs))) == 10
    clean = {r["doc_id"]: r["text"] for r in rows(pii.redact(odd))}
    assert clean[10_003] == "é<card>, <phone> x" and clean[10_010] is None and clean[10_011] == ""


def test_mail_addresses_with_many_labels(spark):
    texts = ["a@b" + ".c" * 600, "a@b" + ".c" * 60_000 + "..x@y.z a@b." + "d." * 700]
    got = rows(pii.summary(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert {r["doc_id"]: r["base_sha256"] for r in got} == {i: hashlib.sha256(",".join(plain_spans(t)).encode()).hexdigest() for i, t in enumerate(texts)}


def test_every_wider_match_passes_the_cheap_test(spark):
    joints = {"at": ["(at)", " [at] ", " at ", " AT ", " (At)"], "dot": [".", " dot ", "(dot)", " [DOT] ", "[dot] "]}
    texts = [f"write to jane.doe{a}mail{d}example.com" for a in joints["at"] for d in joints["dot"]]
    texts += [f"x jane{a}example{d}com, y" for a in joints["at"] for d in joints["dot"]]
    texts += ["fe80:0:0:0:1:22:333:4444", "4543.2458.0544.4772", "(555) 123-4567", "555 123 4567", "0049 30 1234567", "001(2)3-4.5 6 7 8 9"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for kind, pattern in pii.WIDER.items():
        seen = docs.select(F.col("text").rlike(pattern).alias("match"), pii._NEEDS[kind, False](F.col("text")).alias("passes"))
        assert [r for r in seen.where("match").collect() if not r.passes] == [] and seen.where("match").count() > 0
    spans = {r["text"]: r["wide_email"] for r in rows(pii._with_spans(docs))}
    assert [s["v"] for s in spans["x jane at example.com, y"]] == ["jane at example.com"]
    assert all(len(v) == 1 for t, v in spans.items() if "jane" in t)


# --- language, quality -----------------------------------------------------------------


def test_language(docs, odd_docs, no_docs):
    got = rows(language.identify(language.document_evidence(docs)))
    want = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(r["language"] == want[r["id"]] for r in got) >= 0.98 * len(want) == 0.98 * len(got)
    odd = rows(language.identify(language.document_evidence(odd_docs)))
    assert len(odd) == 10 and {r["kept"] for r in odd if r["id"] in (2, 3)} == {False}
    assert rows(language.identify(language.document_evidence(no_docs))) == []
    mute = rows(language.identify(language.document_evidence(odd_docs.drop("lang").selectExpr("*", "cast(null as string) as lang"))))
    assert len(mute) == 10 and all(r["language"] is None and not r["kept"] for r in mute)


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "0123 4567 89 " * 20,
    "xqzv kjwq zzxk qwvj pqxz vkqj " * 5 + "wqkxj zvbq",
]


def test_language_none_of_these(spark, docs):
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id id", "text", "lang", "source")
    other = spark.createDataFrame([(-1 - i, t, "en", None) for i, t in enumerate(FOREIGN)], "id long, text string, lang string, source string")
    seen = language.evidence(clean.unionByName(other), "id", F.col("text"), F.col("lang"), F.col("source"))
    got = {r["id"]: r for r in rows(language.identify(seen))}
    assert [i for i in got if i < 0 and got[i]["kept"]] == []
    lost = [i for i in got if i >= 0 and not got[i]["kept"]]
    assert len(lost) <= 0.01 * len(got), lost


def test_rare_languages_do_not_depend_on_table_size(spark):
    rare = [(i, FOREIGN[1] + f" {prose(i, 1)}", "fi", "x.fi") for i in range(4)]
    many = spark.range(100, 6100).selectExpr("id", "concat('the people of the nation and the house ', id % 7, ' went home') text", "'en' lang", "'a.com' source")
    docs = many.unionByName(spark.createDataFrame(rare, "id long, text string, lang string, source string"))
    got = {r["id"]: r for r in rows(language.identify(language.evidence(docs, "id", F.col("text"), F.col("lang"), F.col("source"))))}
    assert len(got) == 6004 and all(got[i]["language"] == "fi" and got[i]["kept"] for i in range(4)) and got[100]["language"] == "en"


def test_language_of_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "not an address", "<html lang=de>"), (-3, "https://u:p@WWW.x.fr:80/a", "")], "page_id long, url string, html string")
    seen = language.page_evidence(pages.unionByName(odd))
    assert [(r.host, r.domain, r.suffix) for r in seen.where("id = -3").collect()] == [("x.fr", "x.fr", "fr")]
    got = {r["id"]: r for r in rows(language.identify(seen))}
    assert len(got) == 53 and sum(r["language"] == r["declared"] for r in got.values()) >= 50


def test_quality_against_labels(spark, odd_docs, no_docs):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r["doc_id"]: r["kept"] for r in rows(quality.classify(docs))}
    assert len(got) == docs.count()
    good = [got[i] for i, q in labels.items() if q == 1]
    bad = [got[i] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1
    odd = rows(quality.classify(odd_docs))
    assert len(odd) == 10 and all(not r["kept"] and r["score"] is None for r in odd if r["n_words"] == 0)
    assert rows(quality.classify(no_docs)) == []


def test_vote_patterns_round_trip():
    voted = np.random.default_rng(3).integers(0, 4, (50, len(quality.LABELLERS)))
    assert (quality.votes_of(quality.pattern_of(voted)) == voted).all()


# --- tokens, pieces, language model ----------------------------------------------------


def test_token_counts(odd_docs, no_docs):
    vocabulary = set(token_counts.vocabulary(token_counts.VOCABULARY))
    automaton = token_counts.Automaton.at(token_counts.VOCABULARY)

    def greedy(s):
        n = 0
        while s:
            size = next(k for k in range(min(len(s), 64), 0, -1) if s[:k] in vocabulary)
            s, n = s[size:], n + 1
        return n

    for i in range(300):
        word = b" " + prose(i, 2).replace(" ", "'").encode()
        assert automaton.count(word) == greedy(word)
    got = rows(token_counts.count_tokens(odd_docs))
    want = sorted((-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode().split())) for r in odd_docs.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"]) for r in got) == want
    assert all(r["n_tokens"] == 0 for r in got if r["n_words"] == 0)
    assert rows(token_counts.count_tokens(no_docs)) == []


def test_pieces(spark, docs, odd_docs, no_docs):
    table = pieces.piece_table(spark)
    scores = {r.piece: (r.id, r.score) for r in table.where("not is_byte").collect()}
    unknown = min(s for _, s in scores.values() if s > -1e6) - 10

    def viterbi(w):
        best = [(0.0, [])]
        for end in range(1, len(w) + 1):
            found = None
            for start in range(max(0, end - 16), end):
                p = w[start:end]
                if p in scores:
                    path = (best[start][0] + scores[p][1], best[start][1] + [scores[p][0]])
                elif end - start == 1:
                    path = (best[start][0] + unknown * len(p.encode()), best[start][1] + [3 + b for b in p.encode()])
                else:
                    continue
                if found is None or path[0] > found[0]:
                    found = path
            best.append(found)
        return best[-1][1]

    some = docs.where("doc_id < 40").union(odd_docs.where("doc_id in (2, 3, 9)").select(docs.columns))
    encoded = pieces.encode(some, table)
    texts = some.collect()
    want = sorted([i for w in (r.text or "").encode().split() for i in viterbi(pieces.MARK + w.decode())] for r in texts)
    assert sorted(r["ids"] for r in rows(encoded)) == want
    back = sorted(r["text"] for r in rows(pieces.decode(encoded, table, "row")))
    assert back == sorted(" ".join(w.decode() for w in r.text.encode().split()) for r in texts if (r.text or "").encode().split())
    got = rows(pieces.digest(some, table))
    assert sum(r["n_pieces"] for r in got) == sum(map(len, want)) and all(r["round_trip"] for r in got)
    few = {r["doc_id"]: r["ids_digest"] for r in rows(pieces.digest(some, table, frequent=10))}
    assert few == {r["doc_id"]: r["ids_digest"] for r in got}
    assert len(rows(pieces.digest(odd_docs, table))) == 10 and rows(pieces.digest(no_docs, table)) == []


def test_pieces_leave_no_scratch_and_decode_without_shuffle(spark, docs, monkeypatch, tmp_path):
    table = pieces.piece_table(spark)
    monkeypatch.setattr(session, "_shared_dir", lambda _: str(tmp_path))
    some = docs.where("doc_id < 20")
    got = rows(pieces.digest(some, table))
    made = sorted(f.name.split("-")[1] for f in tmp_path.iterdir())
    assert len(got) == some.count() and made == ["pieces"]
    # Rows of many Arrow batches, with equal and null keys: every row comes back in its own order.
    ids = {r.piece: r.id for r in table.where("not is_byte").collect()}
    line = [ids[pieces.MARK + "the"], ids["x"], ids["y"]]
    encoded = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id % 5) as k", f"if(id % 2 = 0, array({','.join(map(str, line))}), array({line[1]})) as ids")
    back = pieces.decode(encoded, table, "k")
    assert "Exchange hashpartitioning" not in back._jdf.queryExecution().toString()
    want = collections.Counter((None if i % 3 == 0 else i % 5, "x" if i % 2 else "thexy") for i in range(30_000))
    assert collections.Counter((r.k, r.text) for r in back.collect()) == want


def test_words_of_many_batches_are_folded_whole(spark):
    table = pieces.piece_table(spark)
    scores = {r.piece: (r.score, r.id) for r in table.where("not is_byte").collect()}
    unknown = min(s for s, _ in scores.values() if s > -1e6) - 10
    words = sorted({pieces.MARK + w + str(i) + "é😀𐍈"[i % 4 :] for i, w in enumerate(prose(11, 3000).split())})
    df = spark.createDataFrame([(w, None if i % 2 else i) for i, w in enumerate(words)], "word string, seen long")
    want = {w: (None if i % 2 else i, *pieces.best_path(w, scores, max(map(len, scores)), unknown, 3)) for i, w in enumerate(words)}
    assert {r.word: (r.seen, r.ids, r.path_score) for r in pieces.encode_words(df, table).collect()} == want


def test_lattice_language_model(docs, odd_docs, no_docs):
    names, logs = lattice_lm.vocabulary_pieces(lattice_lm.VOCABULARY)
    known, lattice = dict(zip(names, logs, strict=True)), lattice_lm.Lattice(names)

    def marginal(w):
        w, a = b" " + w, [0.0]
        for end in range(1, len(w) + 1):
            a.append(math.log(sum(math.exp(a[s] + known[w[s:end]]) for s in range(max(0, end - 12), end) if w[s:end] in known)))
        return a[-1]

    words = [b"the", b"nation", "électron".encode(), b"x", b"a" * 60]
    assert np.allclose(lattice_lm.log_probabilities(lattice, logs, words), [marginal(w) for w in words])
    used = lattice_lm.expected_counts(lattice, logs, [b"the"], np.array([2.0]))
    assert math.isclose(sum(n * len(p) for n, p in zip(used, names, strict=True)), 8.0)  # four bytes, twice

    texts = {r.doc_id: r.text for r in docs.collect()}
    counts: collections.Counter = collections.Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t.encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    for frequent in (50, 200_000):
        for r in rows(lattice_lm.score(docs, rounds=1, frequent=frequent)):
            tokens = [*texts[r["doc_id"]].encode().lower().split(), None]
            base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    odd = rows(lattice_lm.score(odd_docs, rounds=1))
    assert len(odd) == 10 and all(r["n_tokens"] == 1 for r in odd if r["doc_id"] in (2, 3, 4))
    assert rows(lattice_lm.score(no_docs)) == []


def test_lattice_is_whole(monkeypatch):
    monkeypatch.setattr(lattice_lm, "WINDOW", 100)
    names, logs = lattice_lm.vocabulary_pieces(lattice_lm.VOCABULARY)
    known, lattice = dict(zip(names, logs, strict=True)), lattice_lm.Lattice(names)
    long_pieces = [n for n in names if len(n) > 12]
    assert len(long_pieces) > 300

    def marginal(w):
        w, a = b" " + w, [0.0]
        for end in range(1, len(w) + 1):
            terms = [a[s] + known[w[s:end]] for s in range(max(0, end - lattice.longest), end) if w[s:end] in known]
            a.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
        return a[-1]

    words = [n.strip() for n in long_pieces[:50]] + [prose(3, 100).replace(" ", "").encode(), b"".join(n.strip() for n in long_pieces), b"x" * 239, b"x" * 240]
    assert np.allclose(lattice_lm.log_probabilities(lattice, logs, words), [marginal(w) for w in words], rtol=1e-9)
    used = lattice_lm.expected_counts(lattice, logs, words, np.ones(len(words)))
    assert math.isclose(sum(n * len(p) for n, p in zip(used, names, strict=True)), sum(len(w) + 1 for w in words), rel_tol=1e-6)


def test_long_words_are_encoded_whole(spark):
    table = pieces.piece_table(spark)
    scores = {r.piece: (r.score, r.id) for r in table.where("not is_byte").collect()}
    unknown = min(s for s, _ in scores.values() if s > -1e6) - 10
    longest = max(map(len, scores))
    words = ["internationalization" * 20, "人人生而自由在尊严和权利上一律平等" * 9, "😀é" * 100, "https://example.com/" + prose(4, 40).replace(" ", "/"), "x" * 20_000]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in rows(pieces.encode(df, table))}
    for i, word in enumerate(words):
        assert got[i] == pieces.best_path(pieces.MARK + word, scores, longest, unknown, 3)[0]
    assert {r["doc_id"]: (r["n_words"], r["n_pieces"], r["round_trip"]) for r in rows(pieces.digest(df, table))} == {i: (1, len(got[i]), True) for i in got}
    # The fold and the recursion with back pointers agree where both apply.
    short = spark.createDataFrame([(pieces.MARK + w,) for w in ["nation", "x1é😀", *prose(7, 20).split(), words[0][:50], words[3][:55]]], "word string")
    for r in rows(pieces.encode_words(short, table)):
        assert (r["ids"], r["path_score"]) == pieces.best_path(r["word"], scores, longest, unknown, 3)
