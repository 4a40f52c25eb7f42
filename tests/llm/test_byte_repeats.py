"""Byte repeats over region borders, of long texts, and by brute force on small alphabets."""

import hashlib
import random

import numpy as np
import pytest

from sluice.llm import bucket_dedup


def brute(rows, length):
    first = {}
    for i, t in sorted(rows):
        b = t.encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    out = {}
    for i, t in rows:
        b, gone = t.encode(), np.zeros(len(t.encode()) + 1, bool)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = True
        gone = gone[:-1]
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(spark, rows, length=50):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in bucket_dedup.without_repeats(df, length=length).collect()}


@pytest.mark.parametrize("length", [48, 50, 72])
@pytest.mark.parametrize("seed", range(3))
def test_pieces_of_other_documents(spark, seed, length):
    """Documents pasted from pieces of one another, some of them of two letters alone."""
    rng = random.Random(seed)
    letters = "ab" if seed == 2 else "abcdefgh é"
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 90))) for _ in range(3)]
        for _ in range(rng.randrange(0, 4)):
            source = rng.choice(rows)[1] if rows else ""
            at = rng.randrange(0, len(source) + 1)
            parts.insert(rng.randrange(len(parts) + 1), source[at : at + rng.choice([20, length - 1, length, 130])])
        rows.append((rng.choice([i, 1000 - i]), "".join(parts)))
    rows = list({i: (i, t) for i, t in rows}.values()) + [(5000, "z" * 400), (5001, "z" * 49), (5002, "z" * 90), (5003, "")]
    assert found(spark, rows, length) == brute(rows, length)


def test_long_texts_are_walked_in_regions(spark, monkeypatch):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(900_000))
    rows = [(1, base), (2, base[250_000:270_000] + "".join(rng.choice("qrstuv") for _ in range(400_000)) + base[600_000:700_050]), (3, base[262_100:262_180]), (4, base)]
    assert found(spark, rows) == brute(rows, 50)


def test_a_text_of_fifty_megabytes(spark):
    """Its regions are named one after the other; a short document finds what it shares with the middle."""
    text = np.random.default_rng(1).integers(97, 123, 50 << 20, dtype=np.uint8).tobytes().decode()
    part = text[30_000_000:30_000_400]
    got = found(spark, [(1, text), (2, "#" * 60 + part + "!" * 30), (3, text[:49])])
    assert got[1][:3] == (len(text), 0, 0) and got[2][:3] == (490, 400, 1) and got[3][:3] == (49, 0, 0)


def test_names_do_not_depend_on_the_region(monkeypatch):
    data = np.random.default_rng(0).integers(97, 99, 3000, dtype=np.uint8)
    whole = bucket_dedup._Region(data, np.array([0, 3000]), 50, 0, 3000)
    part = bucket_dedup._Region(data[700:1500], np.array([0, 800]), 50, 100, 600)
    assert (whole.name[700 : 700 + part.name.size] == part.name).all() and (whole.long[700 : 700 + part.long.size] == part.long).all()
    own = part.chosen() + 700
    assert set(own) <= set(whole.chosen()) and set(x for x in whole.chosen() if 830 <= x < 1290) <= set(own)
