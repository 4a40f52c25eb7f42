"""DuckDB SQL for the corpus queries that SQL can state."""

from __future__ import annotations

#: crc32 of a decimal text, bit by bit; 3988292384 is the reversed polynomial.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(_field(f) for f in fields) + ")"


def _tree(name: str, heights: int) -> str:
    """Levels ``{name}0 ..`` of nodes over ranked leaves, and the siblings of every node of each level."""
    out = []
    for k in range(heights):
        out.append(f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, (n + 7) // 8 AS n, sha256(string_agg(digest, '' ORDER BY i)) AS digest FROM {name}{k} WHERE n > 1 GROUP BY tree, i // 8, n)")
        beside = "coalesce(string_agg(digest, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN {0}), '')"
        before, after = beside.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), beside.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        out.append(f"{name}side{k} AS (SELECT tree, i, {before} AS a, {after} AS b FROM {name}{k} WHERE n > 1)")
    roots = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE n = 1" for k in range(heights + 1))
    return ",\n".join(out) + f",\n{name}roots AS ({roots})"


def merkle_sql(heights: int = 7, top: int = 3) -> str:
    """Trees of up to ``8**heights`` leaves each over up to ``8**top`` languages."""
    steps = [("l", k, "r.tree", f"r.i // {8**k}") for k in range(heights)] + [("t", k, "0", f"o.i // {8**k}") for k in range(top)]
    names = [f"{t}side{k}" for t, k, _, _ in steps]
    joins = "\n".join(f"LEFT JOIN {n} ON {n}.tree IS NOT DISTINCT FROM {tree} AND {n}.i = {i}" for n, (_, _, tree, i) in zip(names, steps))
    fold = ", ".join(f"CASE WHEN {n}.a IS NULL THEN f{k} ELSE sha256({n}.a || f{k} || {n}.b) END AS f{k + 1}" for k, n in enumerate(names))
    siblings = " || ".join(f"coalesce({n}.a || {n}.b, '')" for n in names)
    return f"""
WITH own AS (SELECT doc_id, lang AS tree, {_leaf('text')} AS leaf,
  CASE WHEN {_CRC32.format('CAST(doc_id AS VARCHAR)')} % 3 = 0
    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS seen FROM documents),
ranks AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM own),
l0 AS (SELECT tree, i, n, leaf AS digest FROM ranks),
{_tree('l', heights)},
o AS (SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM lroots),
t0 AS (SELECT 0 AS tree, i, n, digest FROM o),
{_tree('t', top)},
folds AS (SELECT doc_id, leaf, o.digest AS subroot, tr.digest AS root, sha256({siblings}) AS proof_sha256,
  coalesce(seen, leaf) AS f0, {fold}, r.i AS lang_rank
FROM ranks r JOIN o ON o.tree IS NOT DISTINCT FROM r.tree CROSS JOIN troots tr
{joins})
SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(names)} AS folded_root, f{len(names)} = root AS verified, lang_rank FROM folds"""


_NEGATIVES = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranks AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranks WHERE rank <= 10"""

ORACLE = {"op11_merkle_manifest": merkle_sql(), "op12_hard_negatives": _NEGATIVES}
