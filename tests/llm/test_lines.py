"""Line rules of long documents in parts, against the same documents whole."""

import random

import numpy as np
import pytest

from sluice.llm import line_rules
from sluice.llm.common import SLICE_BYTES

NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat start end row line_words hash".split()


def measured(text):
    data = np.frombuffer(text.encode(), np.uint8)
    x = line_rules._Lines(data, np.array([0, data.size]))
    return {n: getattr(x, n).tolist() for n in NAMES}


@pytest.mark.parametrize("seed", range(8))
def test_parts_equal_the_whole(seed, monkeypatch):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["word", "Wörd", "#tag", "a 1 b", "same line", "", " \t", "x" * rng.randrange(300), "&&"])
    text = "\n".join(" ".join(pick() for _ in range(rng.randrange(5))) for _ in range(120)) + rng.choice(["", "\n", "\n\n"])
    want = measured(text)
    for size in (1, 40, 200, 1000):
        monkeypatch.setattr(line_rules, "SLICE_BYTES", size)
        assert measured(text) == want


def test_a_very_long_document(spark):
    lines = [f"line {i % 50_000} has some words number{i} in it" for i in range(300_000)]
    text = "\n".join(lines)
    assert len(text) > 5 * SLICE_BYTES
    docs = spark.createDataFrame([(1, text, "s"), (2, "short one", "s"), (3, "y" * (2 * SLICE_BYTES + 9), "s")], "doc_id long, text string, source string")
    got = {r.id: r for r in line_rules.judged(docs).collect()}
    assert (got[1].n_words, got[1].word_chars) == (8 * 300_000, sum(len(w) for x in lines for w in x.split()))
    assert got[1].n_dup_lines == 0 and got[3].n_words == 1 and got[2].base_failed
    assert {r.doc_id: r.text for r in line_rules.without_boilerplate(docs).collect()} == {1: text, 2: "short one", 3: "y" * (2 * SLICE_BYTES + 9)}
