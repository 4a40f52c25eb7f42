"""Votes, targets, splits and subsequences against plain Python."""

import math
import random

import numpy as np
import pytest

from sluice.llm import decontaminate, mixing, quality_knn


@pytest.mark.parametrize("seed", range(4))
def test_votes(seed):
    rng = np.random.default_rng(seed)
    known, z = (quality_knn.unit(rng.normal(size=(n, 6)).round(1)) for n in (60, 300))
    marks = rng.integers(0, 2, 60).astype(float)
    z[5] = 0
    got = quality_knn.vote(z, known, marks, 7, 0.4)
    for i in range(300):
        cosine = [float(np.dot(z[i], k)) for k in known]
        best = sorted(cosine, reverse=True)[:7]
        if best.count(best[-1]) != cosine.count(best[-1]):
            continue  # which of equally near rows votes is not fixed here
        weights = [(max(c, 0) ** 2, m) for c, m in zip(cosine, marks) if c >= best[-1]]
        total = sum(w for w, _ in weights)
        want = sum(w * m for w, m in weights) / total if total > 1e-9 else 0.4
        assert got[i] == pytest.approx(want, abs=1e-5)


def water_filled(sizes, weights, share, cap):
    """Targets by giving every source its share of what is left until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / total for s in open_} if open_ else {}
        above = [s for s in open_ if target[s] > cap * sizes[s]]
        if not above:
            return target | {s: cap * sizes[s] for s in full}
        for s in above:
            full.add(s)
            left -= cap * sizes[s]


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = rng.sample(["a", "B", "é", "z", "", "日", "web", None], rng.randrange(1, 8))
    sizes = {s: rng.choice([1, 10, 500, 20_000]) for s in names}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    assert got == {s: pytest.approx(t, rel=1e-9) for s, t in water_filled(sizes, (3, 1, 2), 1.5, 2.0).items()}


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_shards_part_the_quotas(shards):
    quotas = np.array([0, 3, 50, 1, 400])
    parts = [mixing.split_quotas(quotas, shards, s, 5) for s in range(shards)]
    assert (parts[0][0] == 0).all() and (parts[-1][1] == quotas).all()
    assert all((a[1] == b[0]).all() for a, b in zip(parts, parts[1:]))
    sizes = [int((end - start).sum()) for start, end in parts]
    assert max(sizes) - min(sizes) <= math.ceil(math.log2(shards)) + 1


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_common_subsequences(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 20, 63, 64]))) for _ in range(9)]
    items = decontaminate._Items(list(enumerate(texts)), 0.25)
    doc = [rng.choice([*words, "other"]) for _ in range(200)]
    raw = np.frombuffer(" ".join(doc).encode(), np.uint8)
    word = items.look_up(decontaminate.Words(raw, np.array([0, raw.size])).hashes())
    start = np.array([rng.randrange(150) for _ in texts])
    size = np.array([rng.randrange(1, 50) for _ in texts])
    bits = decontaminate.common_subsequence(word, start, size, np.arange(len(texts)), items)
    for k, text in enumerate(texts):
        want = longest_common(doc[start[k] : start[k] + size[k]], text.split())
        assert int(np.bitwise_count(bits[k])) == want


def test_whole_items_and_paraphrases_are_found(spark):
    """Every item of the table, whole and with a fifth of its words changed, in the midst of other text."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 800").limit(12).collect()]
    rng, rows, want = random.Random(3), [], {}
    for n, r in enumerate(items.collect()):
        words = r.text.split()
        changed = [w if rng.random() > 0.2 else f"changed{n}x{i}" for i, w in enumerate(words)]
        other = docs[n % len(docs)].split()
        at = rng.randrange(len(other))
        rows += [(2 * n, " ".join(other[:at] + words + other[at:])), (2 * n + 1, " ".join(other[:at] + changed + other[at:]))]
        want[n] = r.item_id
    found = {r.id: r.item_id for r in decontaminate.contaminations(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    whole = [n for n in want if 2 * n in found]
    near = [n for n in want if 2 * n + 1 in found]
    assert len(whole) == len(want) and len(near) >= 0.9 * len(want)
