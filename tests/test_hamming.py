"""The join of bit vectors against brute force, whatever way its rounds take."""

import numpy as np
import pytest

from sparkvec import Collection, Index, InvalidArgument, NotSupported, Schema
from sparkvec.operators import hamming


def plain(queries, members, k):
    out = set()
    for q, a in queries.items():
        near = sorted((sum(bin(x ^ y).count("1") for x, y in zip(a, b, strict=True)), m) for m, b in members.items() if len(b) == len(a))
        out |= {(q, rank, m, round(d**0.5, 9)) for rank, (d, m) in enumerate(near[:k], 1)}
    return out


def codes(rng, n, width, flips):
    base = rng.integers(0, 256, (8, width), dtype=np.uint8)
    out = []
    for i in range(n):
        bits = np.unpackbits(base[i % 8])
        bits[rng.choice(len(bits), rng.integers(0, flips + 1), replace=False)] ^= 1
        out.append(bytes(np.packbits(bits)))
    return out


@pytest.mark.parametrize("width,flips,bits", [(8, 6, None), (8, 40, None), (4, 9, 16), (3, 20, None), (16, 12, 16)])
def test_join_matches_brute_force(spark, monkeypatch, width, flips, bits):
    rng = np.random.default_rng(width * flips)
    if bits:
        monkeypatch.setattr(hamming, "MANY", 0)
    members = dict(enumerate(codes(rng, 200, width, flips)))
    members |= {1000 + i: members[3] for i in range(40)}
    queries = {i: c for i, c in enumerate(codes(rng, 25, width, flips))} | {500: members[3]}
    rows = [*members.items(), (2000, None), (2001, b"x" * (width + 1)), (None, members[1])]
    df = spark.createDataFrame(rows, "m long, b binary").selectExpr("*", "1 as pk", "'x' as words").repartition(3)
    asked = spark.createDataFrame([*queries.items(), *queries.items(), (900, None), (901, b""), (None, members[1])], "q long, b binary")
    for k in (1, 10, 60):
        got = [(r.qid, r.rank, r.pk, round(r.score, 9)) for r in hamming.hamming_join(asked, df, qid="q", pk="m", field="b", k=k).collect()]
        assert set(got) == plain(queries, members, k) and len(got) == len(set(got))
    near = hamming.hamming_join(asked, df, qid="q", pk="m", field="b", k=5, radius=2.0, filter="m < 100").collect()
    assert {(r.qid, r.pk) for r in near} == {(q, m) for q, _, m, d in plain(queries, {m: b for m, b in members.items() if m < 100}, 5) if d <= 2}


def test_few_members_and_misuse(spark):
    df = spark.createDataFrame([(1, b"\x01"), (2, b"\x03")], "m long, b binary")
    got = hamming.hamming_join(df, df, qid="m", pk="m", field="b", k=9).collect()
    assert {(r.qid, r.rank, r.pk, r.score) for r in got} == {(1, 1, 1, 0.0), (1, 2, 2, 1.0), (2, 1, 2, 0.0), (2, 2, 1, 1.0)}
    none = hamming.hamming_join(df, df.where("false"), qid="m", pk="m", field="b")
    assert none.columns == ["qid", "rank", "pk", "score"] and none.count() == 0
    assert hamming.hamming_join(df.where("false"), df, qid="m", pk="m", field="b").count() == 0
    with pytest.raises(InvalidArgument):
        hamming.hamming_join(df, df, qid="m", pk="m", field="b", k=0)
    twice = df.unionByName(spark.createDataFrame([(1, b"\x07")], "m long, b binary"))
    with pytest.raises(Exception, match="repeated"):
        hamming.hamming_join(twice, df, qid="m", pk="m", field="b").collect()


def test_blocks_of_codes():
    rng = np.random.default_rng(1)
    asked, known = rng.integers(0, 2**63, (7, 2)).astype(np.uint64), rng.integers(0, 2**63, (90, 2)).astype(np.uint64)
    known[20:40] = known[5]
    lowest = rng.permutation(90)
    q, c, d = hamming.nearest_codes(asked, known, lowest, 12)
    for i in range(7):
        apart = np.bitwise_count(asked[i] ^ known).sum(axis=1)
        want = sorted(zip(apart.tolist(), lowest.tolist(), range(90), strict=True))[:12]
        assert {(x, y) for x, y in zip(c[q == i].tolist(), d[q == i].tolist(), strict=True)} == {(w[2], w[0]) for w in want}


def test_bits_in_a_collection(spark, tmp_path):
    schema = Schema("b").add("id", "string", primary_key=True).add("n", "int32", nullable=True).add("bits", "vector_binary64", dimension=16)
    rng = np.random.default_rng(3)
    rows = [(f"k{i}", i, c) for i, c in enumerate(codes(rng, 60, 2, 5))]
    c = Collection.create(spark, str(tmp_path / "c"), schema, spark.createDataFrame(rows, "id string, n int, bits binary"))
    held = {k: b for k, _, b in rows}
    got = c.search_many(c.scan(), "bits", qid="id", k=3, filter="n < 30", output_fields=["n"])
    assert got.columns == ["qid", "rank", "pk", "score", "n"]
    assert {(r.qid, r.rank, r.pk, round(r.score, 9)) for r in got.collect()} == plain(held, {k: b for k, n, b in rows if n < 30}, 3)
    one = c.search("bits", rows[7][2], k=4, output_fields=["n"])
    assert [(r.id, round(r.score, 9)) for r in one.collect()] == [(p, s) for _, _, p, s in sorted(plain({"q": rows[7][2]}, held, 4), key=lambda x: x[1])]
    for wrong in (dict(n_probe=1), dict(metric="ip")):
        with pytest.raises(NotSupported):
            c.search_many(c.scan(), "bits", qid="id", **wrong)
    with pytest.raises(NotSupported):
        c.search("bits", rows[7][2], n_probe=1)
    with pytest.raises(InvalidArgument):
        c.search("bits", b"123")
    with pytest.raises((NotSupported, InvalidArgument)):
        c.create_index("bits", Index("ivf", n_list=2))


def test_shared_chunks_are_not_looked_up(spark, monkeypatch):
    rng = np.random.default_rng(11)
    members = dict(enumerate(codes(rng, 400, 8, 3)))
    df = spark.createDataFrame([*members.items()], "m long, b binary")
    join = dict(qid="m", pk="m", field="b", k=5)
    want = plain(members, members, 5)

    def got():
        return {(r.qid, r.rank, r.pk, round(r.score, 9)) for r in hamming.hamming_join(df, df, **join).collect()}

    # Eight clusters: a value of a chunk is that of an eighth of the codes, so pairs grow with their square.
    met, looked_up = [], hamming._looked_up
    monkeypatch.setattr(hamming, "_looked_up", lambda *a: met.append(a) or looked_up(*a))
    for many in (hamming.MANY, 0):
        monkeypatch.setattr(hamming, "MANY", many)
        assert got() == want and not met
    monkeypatch.setattr(hamming, "LOOKUP", 0)
    assert got() == want and met
