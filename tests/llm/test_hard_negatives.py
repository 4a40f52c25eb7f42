"""Hard negatives against scoring everything, their bounds against exact scores, and their SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import hard_negatives as hn
from sluice.llm.oracle import ORACLE
from sluice.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, label long, vector array<double>"


def brute(rows, is_anchor, k=5, m=10):
    """All results by scoring every pair; ``rows`` are (vec_id, label, vector)."""
    ok = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [[math.floor(256 * x) for x in r[2]] for r in ok]
    place = lambda r: (r is None, r or 0)
    out = []
    for i, a in enumerate(ok):
        if a[0] is None or not is_anchor(a[0]):
            continue
        score = [max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(whole[i], w)))) for w in whole]
        best = sorted((j for j in range(len(ok)) if j != i and ok[j][1] == a[1]), key=lambda j: (-score[j], place(ok[j][0])))[:k]
        for p in best:
            fit = [j for j in range(len(ok)) if ok[j][1] != a[1] and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            fit = sorted(fit, key=lambda j: (-score[j], place(ok[j][0])))[:m]
            out += [(a[0], ok[p][0], r + 1, ok[j][0], score[p], score[j]) for r, j in enumerate(fit)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_embeddings_against_sql(spark, sf):
    df = op12_hard_negatives(spark, f"/root/testdata/{sf}")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = con.execute(ORACLE["op12_hard_negatives"])
    order = [df.columns.index(d[0]) for d in want.description]
    assert sorted(tuple(r[i] for i in order) for r in df.collect()) == sorted(want.fetchall())
    assert dict(df.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}


def clustered(n, spread, seed=0):
    """Vectors of different norms around a few directions, labels mixed among them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    v = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, 12))
    v *= rng.uniform(0.05, 3, n)[:, None] / np.linalg.norm(v, axis=1)[:, None]
    return [(i, int(rng.integers(0, 4)), x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_vectors_of_any_norm_in_several_blocks(spark, spread):
    rows = clustered(600, spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(hn.mined(df, F.col("vec_id") % 20 == 0, block=11)) == brute(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [0.5, 0.25]), (0, 1, [0.5, 0.25]), (100, 1, [0.5, 0.25]), (1, 1, [0.5, 0.3]), (2, 1, [0.5, 0.25, 0.1]), (3, 1, [0.4]), (4, 1, []),
        (5, 2, [0.3, 0.1]), (5, 2, [0.3, 0.1]), (6, 2, [0.3, 0.1]), (None, 2, [0.3, 0.1]), (None, 1, [0.5, 0.25]), (7, 3, [0.25, 0.0]),
        (8, None, [0.5, 0.5]), (9, 2, None), (10, 2, [0.5, None]), (11, 2, [nan, 0.5]), (12, 2, [inf, 0.5]), (13, 2, [0.0, 0.0]), (14, 2, [-0.5, -0.001]),
        (200, 4, [0.0, 0.0]), (201, 4, [1.0, 1.0]), (300, 5, [-1.0, 0.0]), (301, 5, [1.0, 0.0]), (400, 6, [0.7, 0.7]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS score", "3 AS slot", "4 AS rank", "5 AS i", "6 AS n")
    assert found(hn.mined(df, F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)
    assert found(hn.mined(df.limit(0), F.col("vec_id") % 100 == 0)) == []
    assert found(hn.mined(df, F.lit(False))) == []


def test_many_ties_and_copies(spark):
    rows = [(i, i % 3, [0.5, 0.5] if i % 2 else [0.3, 0.31]) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(hn.mined(df, F.col("vec_id") % 300 == 0)) == brute(rows, lambda i: i % 300 == 0)


def test_large_components_are_exact(spark):
    rows = [(0, 1, [1e9, 3.0]), (1, 1, [1e9, 7.0]), (2, 2, [5e8, 1.0]), (3, 2, [5e8, 1.004]), (4, 2, [1e30, 1.0]), (5, 1, [1e30, 0.0]), (6, 2, [4e-10, 2e8])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(hn.mined(df, F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)


@pytest.mark.parametrize("spread", [0.0, 0.02, 0.5, 3.0])
def test_bounds_hold_for_every_score(spread):
    rows = clustered(400, spread, 5)
    m = np.floor(256 * np.array([r[2] for r in rows]))
    m[::50] = 0
    norms = np.sqrt((m**2).sum(axis=1))
    references = hn._references(m, 8)
    angles = hn.angles_to(m, norms, references)
    exact = hn.scores(m, m)
    for lo in range(0, 400, 16):
        w = slice(lo, lo + 16)
        low, high = hn.bounds(norms, angles, norms[w], angles[w])
        assert (low <= exact[:, w].min(axis=1)).all() and (high >= exact[:, w].max(axis=1)).all()


def test_windows_that_point_elsewhere_are_not_scored(spark, monkeypatch):
    """With rows in a few tight directions most pairs of anchor and window are ruled out by their angles."""
    rows = sorted(clustered(4000, 0.01, 2), key=lambda r: (np.argmax(r[2]), r[0]))
    m = np.floor(256 * np.array([r[2] for r in rows]))
    norms = np.sqrt((m**2).sum(axis=1))
    angles = hn.angles_to(m, norms, hn._references(m, 16))
    order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1)))
    exact = hn.scores(m[:50], m)
    bar = np.sort(exact, axis=1)[:, -6]
    tops = [hn.bounds(norms[:50], angles[:50], norms[order[i : i + 64]], angles[order[i : i + 64]])[1] for i in range(0, 4000, 64)]
    assert np.mean(np.array(tops) >= bar) < 0.5
