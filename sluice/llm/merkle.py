"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs found by descending it.

Every row is a leaf. Leaves of one language stand in order of their ids; runs of ``FANOUT`` digests
are hashed to the digest above until one is left, and the languages' digests likewise to one root. The
store holds a record ``digest -> children`` per inner node, one table for each height. A request names
a leaf by the digits of its place. All requests go down from the root together, one row per distinct
node they still share: the record of the node is looked up by its digest, the request's next digit
picks a child, and the children before and after it are the next segment of the path. Read from its
end, the path is the proof. No task sees more than a node's children, however large a language is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import dropped, saved
from sluice.llm.ranking import ranked

FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
#: Bytes of a digest; the children of a node are kept one after the other in one binary value.
SIZE = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def hashed(digests: Column) -> Column:
    """The digest of digests, which are hashed as their hex text."""
    return F.unhex(F.sha2(as_hex(digests), 256))


def leaf_digest(*fields: Column) -> Column:
    """A row's digest: each field as ``bytes:value``, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


@dataclass(frozen=True)
class Forest:
    """Trees over ranked leaves: ``levels[h]`` holds ``tree, i, n, digest`` and, above the leaves, ``children``."""

    levels: list[DataFrame]

    @property
    def height(self) -> int:
        return len(self.levels) - 1

    def roots(self) -> DataFrame:
        """``tree, height, digest`` of every tree; the only leaf of a tree is its root."""
        tops = [df.where("n = 1").select("tree", F.lit(h).alias("height"), "digest") for h, df in enumerate(self.levels)]
        out = tops[0]
        for df in tops[1:]:
            out = out.unionByName(df)
        return out

    def store(self, height: int) -> DataFrame:
        """The records of one height, each digest once: equal digests have equal children."""
        return self.levels[height].select("digest", "children").dropDuplicates(["digest"])


def forest(leaves: DataFrame, label: str) -> Forest:
    """Hash ranked leaves (``tree, i, n, digest``) upwards, one written table per height.

    Only trees of several nodes go on. A height has an eighth of the nodes of the one below, so all of
    them together cost little more than the first.
    """
    none = F.lit("").cast("binary")
    levels, most = [leaves.select("tree", "i", "n", "digest")], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = levels[-1].where("n > 1").withColumn("n", F.shiftright(F.col("n") + (FANOUT - 1), FANOUT_BITS))
        run = F.array_sort(F.collect_list(F.struct("i", "digest")))
        nodes = below.groupBy("tree", F.shiftright("i", FANOUT_BITS).alias("up"), "n").agg(run.alias("run"))
        children = F.concat(*[F.coalesce(F.get("run", F.lit(k))["digest"], none) for k in range(FANOUT)])
        nodes = nodes.select("tree", F.col("up").alias("i"), "n", children.alias("children"))
        levels.append(saved(nodes.withColumn("digest", hashed(F.col("children"))), f"{label}-{len(levels)}"))
        most = -(-most // FANOUT)
    return Forest(levels)


def descended(trees: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """Go down from ``starts`` to the leaves that ``requests`` ask for.

    ``starts`` has ``tree, height, digest, path`` and may have more columns; ``requests`` has ``tree``
    and ``i``, the place of a leaf, and may have more. Both keep theirs. ``path`` grows by a struct of
    the children ``left`` and ``right`` of the one taken, highest first. Requests share every node
    above: at each height there is one row per node that any of them passes.
    """
    carried = [c for c in starts.columns if c not in ("tree", "height", "digest", "path")]
    wanted = [requests]
    for _ in range(trees.height):
        wanted.append(wanted[-1].select("tree", F.shiftright("i", FANOUT_BITS).alias("i")).distinct())

    def entering(height: int) -> DataFrame:
        here = starts.where(F.col("height") == height).select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_i"), "digest", "path", *carried)
        return here

    def matched(asked: DataFrame, found: DataFrame, place: Column) -> DataFrame:
        return asked.join(found, F.col("tree").eqNullSafe(F.col("_tree")) & (place == F.col("_i")))

    digit = F.col("i").bitwiseAND(FANOUT - 1).cast("int") * SIZE
    frontier = entering(trees.height)
    for h in range(trees.height, 0, -1):
        nodes = frontier.join(trees.store(h), "digest").drop("digest")
        taken = matched(wanted[h - 1], nodes, F.shiftright("i", FANOUT_BITS))
        kept = wanted[h - 1].columns
        segment = F.struct(F.substring("children", 1, digit).alias("left"), F.substring("children", digit + (SIZE + 1), F.lit(FANOUT * SIZE)).alias("right"))
        taken = taken.select(*kept, F.substring("children", digit + 1, F.lit(SIZE)).alias("digest"), F.array_append("path", segment).alias("path"), *carried)
        if h > 1:
            down = taken.select(F.col("tree").alias("_tree"), F.col("i").alias("_i"), "digest", "path", *carried)
            frontier = down.unionByName(entering(h - 1))
    alone = matched(requests, entering(0), F.col("i")).select(*requests.columns, "digest", "path", *carried)
    return taken.unionByName(alone) if trees.height else alone


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(F.reverse(path), leaf, lambda at, s: hashed(F.concat(s["left"], at, s["right"])))


def proof(path: Column) -> Column:
    """Hex text of all siblings of a path, lowest first."""
    return F.array_join(F.transform(F.reverse(path), lambda s: as_hex(F.concat(s["left"], s["right"]))), "")


def verified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree_col: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Build the manifest of ``docs`` and check every row, some of them tampered with, against its root.

    A row is tampered with where 3 divides the crc32 of its id as text: its text has A-Z lowered. Every
    row requests its proof. Returns per row ``id, leaf, subroot, root, proof_sha256`` (of the rows as
    they are), ``folded_root`` (from the row as it was found), ``verified``, ``lang_rank`` and
    ``n_segments``, digests as lowercase hex.

    Nulls hash as ``-``; an empty text is ``0:``; a null language is a tree of its own, before the
    others; a row with a null id comes first in its tree and is never tampered with. Rows with equal
    ids follow one another by digest, and each has its own place, equal rows too. Texts of any length
    are hashed whole, in one pass. Other columns are ignored, whatever their names. An empty table
    gives an empty one.
    """
    row = F.struct(*[F.col(f).alias(f"f{k}") for k, f in enumerate(fields)])
    at = {f: F.col(f"row.f{k}") for k, f in enumerate(fields)}
    own = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(tree_col).alias("tree"))
    tampered = F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 0
    lowered = at | {text_col: F.translate(at[text_col], _UPPER, _LOWER)}
    seen = F.when(tampered & at[text_col].rlike("[A-Z]"), leaf_digest(*lowered.values()))
    hashes = saved(own.select("id", "tree", leaf_digest(*at.values()).alias("leaf"), seen.alias("seen")), "merkle-leaves")
    rows = saved(ranked(hashes, ["tree"], ["id", "leaf"], "merkle-dealt"), "merkle-ranked")
    dropped(hashes)
    trees = forest(rows.withColumnRenamed("leaf", "digest"), "merkle-nodes")
    tops = trees.roots()
    order = ranked(saved(tops, "merkle-subroots").select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "height", "digest"), ["tree"], ["name"], "merkle-top")
    order = saved(order, "merkle-order")
    top = forest(order, "merkle-top-nodes")
    empty = F.expr("CAST(array() AS array<struct<left: binary, right: binary>>)")
    start = top.roots().select("*", empty.alias("path"), F.col("digest").alias("root"))
    subroots = descended(top, start, order.select("tree", "i", "name", F.col("height").alias("below")))
    starts = subroots.select(F.col("name").alias("tree"), F.col("below").alias("height"), "digest", "path", "root", F.col("digest").alias("subroot"))
    found = descended(trees, starts, rows)
    back = folded(F.coalesce("seen", "leaf"), F.col("path"))
    found = found.select(
        "id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), as_hex(F.col("root")).alias("root"),
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), as_hex(back).alias("folded_root"),
        F.col("i").alias("lang_rank"), F.size("path").alias("n_segments"),
    )
    return found.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "lang_rank", "n_segments")
