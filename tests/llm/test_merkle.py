"""The Merkle manifest against a plain Python tree and its SQL."""

import hashlib
import zlib

import duckdb
import pytest

from llm_helpers import LOWER
from sluice.llm import merkle
from sluice.llm.oracle import merkle_sql
from sluice.llm.queries import op11_merkle_manifest
from sluice.llm.ranking import ranked

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(digests):
    """The root of a list of digests and, per place, the runs passed on the way up as ``(place in run, run)``."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for k, i in enumerate(at):
            paths[k].append((i % 8, runs[i // 8]))
        level, at = [H(*r) for r in runs], [i // 8 for i in at]
    return level[0], paths


def brute(rows):
    """Sorted result rows of a plain walk over everything."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r, leaf_of(*r)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = tree([leaf for _, leaf in by_lang[lang]])
    root, tops = tree([trees[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, paths = trees[lang]
        for (r, leaf), path in zip(by_lang[lang], paths):
            seen = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                seen = leaf_of(*r[:4], None if r[4] is None else r[4].translate(LOWER))
            siblings = ""
            for i, run in path + top:
                siblings += "".join(run[:i] + run[i + 1 :])
                seen = H(*run[:i], seen, *run[i + 1 :])
            out.append((r[0], leaf, subroot, root, H(siblings), seen, seen == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("lang_rank", "n_segments").collect()), key=str)


def test_documents_against_sql(spark):
    df = op11_merkle_manifest(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(merkle_sql())
    order = [df.columns.index(d[0]) for d in want.description]
    assert sorted(tuple(r[i] for i in order) for r in df.collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 8, "b": 9}, {None: 65, "é": 7, "z": 1, "": 600}])
def test_shapes_of_trees(spark, counts):
    rows = [(i, "s", lang, i, f"Text {i}") for k, (lang, n) in enumerate(counts.items()) for i in range(k, 3 * n, 3)]
    assert found(merkle.verified(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_many_languages_make_a_tall_top(spark):
    rows = [(i, None, f"l{i % 70}", i, "T") for i in range(140)]
    assert found(merkle.verified(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (3, "S", "en", 3, "ABC é ß 日本"), (3, "S", "en", 3, "ABC é ß 日本"), (3, "S", "en", 3, "other"),
        (None, "S", "en", 1, "X"), (None, None, "en", None, None), (5, "a:1", "en", -5, "Long " * 200_000), (6, "S", None, 1, "UP"),
        *[(7, "S", "en", 7, "Same row") for _ in range(40)],
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS i", "2 AS n", "3 AS tree", "4 AS digest", "5 AS id", "6 AS root", "7 AS _at", "8 AS path")
    assert found(merkle.verified(df)) == brute(rows)


def test_empty_table(spark):
    df = merkle.verified(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and "folded_root" in df.columns


def test_tampered_rows_alone_fail(spark):
    rows = [(i, "S", "en", 1, "Text") for i in range(100)] + [(i, "S", "de", 1, "lower") for i in range(100, 200)]
    out = {r.id: r.verified for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, ok in out.items() if not ok} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_a_request_for_some_leaves_reads_only_their_nodes(spark):
    """Two requests below one root: the path of each equals the one it has among all requests."""
    leaves = spark.range(1000).selectExpr("'t' AS tree", "id AS i", "1000L AS n", "unhex(sha2(CAST(id AS STRING), 256)) AS digest")
    trees = merkle.forest(leaves, "test-merkle")
    starts = trees.roots().selectExpr("*", "CAST(array() AS array<struct<left: binary, right: binary>>) AS path")
    everything = {r.i: (r.digest, r.path) for r in merkle.descended(trees, starts, leaves.select("tree", "i")).collect()}
    some = merkle.descended(trees, starts, leaves.select("tree", "i").where("i IN (3, 999)")).collect()
    assert {r.i: (r.digest, r.path) for r in some} == {i: everything[i] for i in (3, 999)}
    assert everything[3][0].hex() == hashlib.sha256(b"3").hexdigest()


def test_ranks_of_one_hot_group(spark):
    df = spark.range(2000).selectExpr("IF(id < 1900, NULL, 'x') AS g", "id % 7 AS o", "id")
    out = ranked(df, ["g"], ["o"], "test-ranks").collect()
    for g, n in ((None, 1900), ("x", 100)):
        own = sorted((r.i, r.o) for r in out if r.g == g)
        assert [i for i, _ in own] == list(range(n)) and [o for _, o in own] == sorted(o for _, o in own)
        assert {r.n for r in out if r.g == g} == {n}
