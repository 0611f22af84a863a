"""Hard negatives against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.llm import hard_negatives


def plain(data, anchors, positives=5, negatives=3):
    """``data`` lists (id, label, vector); ids may repeat, then as the docstring says."""
    rows = {(i, lab, tuple(math.floor(256 * float(x)) for x in v)) for i, lab, v in data if i is not None and lab is not None and good(v)}
    out = set()
    for a in sorted({r[0] for r in rows} & set(anchors)):
        _, label, mine = min(((r[0], r[1], r[2]) for r in rows if r[0] == a), key=lambda r: (r[1], r[2]))
        score = {(r[0], r[1], sum(x * y for x, y in zip(mine, r[2], strict=True))) for r in rows if r[0] != a and len(r[2]) == len(mine)}
        near = sorted({(-s, i) for i, lab, s in score if lab == label})[:positives]
        for p, i in near:
            far = sorted({(-s, j) for j, lab, s in score if lab != label and -50 * p <= 100 * s <= -95 * p})[:negatives]
            out |= {(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(far, 1)}
    return out


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def frame(spark, data, kind="float"):
    df = spark.createDataFrame(data, f"vec_id long, label int, embedding array<{kind}>").repartition(3)
    return df.selectExpr("*", "'x' as id", "'y' as vector", "1 as dim", "2 as rank", "'z' as rows")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 20))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 6] + rng.normal(size=20) * 0.6).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 4, rows[3][2]) for i in range(40)]  # ties
    rows += [(rows[20][0], 2, rows[20][2]), (rows[20][0], 2, rows[21][2]), (rows[7][0], 3, rows[7][2])]  # repeated ids
    odd = [(None, 1, rows[0][2]), (2000, None, rows[0][2]), (2010, 1, None), (2020, 1, [math.nan] * 20), (2030, 2, [None] * 20)]
    odd += [(2040, 3, [math.inf] * 20), (2050, 9, rows[1][2]), (2060, 1, [0.0] * 20), (2070, 1, [1.0] * 7), (2080, 2, [0.7] * 7), (2090, 1, [])]
    return rows + odd


ASKED = [*range(0, 400, 10), 1000, 1030, 2050, 2060, 2070, 2090]


def test_matches_brute_force(spark, data, monkeypatch):
    asked = F.col("id").isin(ASKED)
    want = plain(data, ASKED)
    assert len(want) > 300
    got = [tuple(r) for r in hard_negatives.mine(frame(spark, data), asked).collect()]
    assert set(got) == want and len(got) == len(want)
    monkeypatch.setattr(hard_negatives, "TILE", 37)
    monkeypatch.setattr(hard_negatives, "SMALL_TILE", 37)
    got = [tuple(r) for r in hard_negatives.mine(frame(spark, data), asked, positives=2, negatives=9).collect()]
    assert set(got) == plain(data, ASKED, 2, 9) and len(got) == len(set(got))


def test_large_components_and_few_rows(spark):
    big = [(i, i % 2, [2.0**40 + i, 3.0, 2.0**-9 * i]) for i in range(12)]
    got = [tuple(r) for r in hard_negatives.mine(frame(spark, big, "double"), F.col("id") % 2 == 0, low=-100, high=100).collect()]
    assert len(got) == len(set(got)) > 0
    exact = {i: [math.floor(256 * x) for x in v] for i, _, v in big}
    for a, p, _, n, ps, ns in got:
        assert ps == min(2**63 - 1, sum(x * y for x, y in zip(exact[a], exact[p], strict=True)))
        assert ns == min(2**63 - 1, sum(x * y for x, y in zip(exact[a], exact[n], strict=True)))
    assert hard_negatives.mine(frame(spark, big[:1], "double"), F.col("id") == 0).collect() == []
    assert hard_negatives.mine(frame(spark, []), F.col("id") == 0).collect() == []


def test_index_loses_no_pair():
    rng = np.random.default_rng(3)
    for width in (1, 5, 40):
        a, x = (np.floor(256 * rng.normal(size=(n, width)) * rng.gamma(1, size=width)) for n in (30, 300))
        x[::7] = 0
        scores = a @ x.T
        for share in (0.99, 0.7, 0.3, 0.0):
            least = np.quantile(scores, share, axis=1)
            found = {(i, j, s) for p in hard_negatives.pairs_above(a, x, least) for i, j, s in zip(*(c.tolist() for c in p), strict=True)}
            assert found == {(i, j, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True)}
        candidates = hard_negatives._candidates(a, hard_negatives._tails(a), x, hard_negatives._tails(x), np.full(30, scores.max() + 1))
        assert width == 1 or len(candidates[0]) < scores.size / 2
