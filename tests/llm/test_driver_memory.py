"""What the driver's Python holds while an operator prepares its model: a small multiple of that model's matrix."""

import tracemalloc

import numpy as np
import pytest

from sluice.llm import decontaminate, quality_knn


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    return [" ".join(f"w{n}" for n in rng.integers(0, 40_000, 60)) for _ in range(2000)]


def most_held(run) -> tuple[int, object]:
    """Bytes that Python and numpy allocated at most during a call, and what it returned."""
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1], out
    finally:
        tracemalloc.stop()


def test_labelled_sample_is_held_once(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.range(len(texts)).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    held, _ = most_held(lambda: quality_knn.classify(docs, labels))
    assert held < 2 * len(texts) * quality_knn.WIDTH * 4


def test_sketch_is_not_held_as_python_numbers(spark, texts):
    buckets = decontaminate.bucketed(spark.createDataFrame([(t,) for t in texts], "text string"))
    held, (axes, strength) = most_held(lambda: decontaminate.latent_axes(buckets, np.ones(decontaminate.BUCKETS)))
    assert axes.shape == (decontaminate.BUCKETS, decontaminate.RANK) and strength[0] > 0
    assert held < 6 * decontaminate.BUCKETS * (decontaminate.RANK + 8) * 8
