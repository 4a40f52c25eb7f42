"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source has a target number of words: its weight's share of the whole mix, at most ``cap`` times
what it has, the excess shared again by weight. Its documents fall by hash into blocks. Whole passes
take every block; the rest of the target takes blocks in a permuted order and the last block document
by document. That gives every source an exact quota of blocks. A binary tree over the output shards
splits the quotas: at each node the left half draws its blocks of all sources at once from the
multivariate hypergeometric distribution, the right half gets the others. A shard thus holds a run
of each source's permuted blocks that no other shard has, and shuffles its documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Words, mapped, saved, text_slices

#: A source has at most so many blocks, of at least so many words each (but for its last words).
MOST_BLOCKS, LEAST_WORDS = 4096, 1 << 14


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(id, source, size)`` per row: words between ASCII white space of the whole text."""

    def count(batches):
        for batch in batches:
            for lo, hi, data, bounds in text_slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(Words(data, bounds).count, pa.int64())], names=["id", "source", "size"])

    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, source_col)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return mapped(rows, count, f"id {kinds[0]}, source {kinds[1]}, size long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``: the level to which weights fill.

    A source is full when its weight times the level exceeds ``cap`` times its size. Sources are sorted
    by the level at which they fill, and the level is the one where full sources and the rest add up.
    """
    by_code_point = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.pmod(F.row_number().over(by_code_point) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    fill = Window.orderBy("full_at", F.col("source").isNull(), "source")
    rows = sizes.withColumn("weight", weight).withColumn("full_at", cap * F.col("source_size") / F.col("weight"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    rows = rows.withColumn(
        "level",
        (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(cap)) / F.sum("weight").over(onward),
    )
    # The first source, in this order, that the level of its own row does not fill sets the level of all.
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(every)["level"]
    target = F.least(F.col("weight") * F.coalesce(level, F.lit(float("inf"))), cap * F.col("source_size"))
    return rows.select("source", "source_size", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end place, per source, of one shard's blocks: its path down the splitting tree."""
    start, counts = np.zeros_like(quotas), quotas.copy()
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(counts.sum())
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(counts, total * (mid - lo) // (hi - lo), method="marginals") if total else np.zeros_like(counts)
        if shard < mid:
            counts, hi = left, mid
        else:
            start, counts, lo = start + left, counts - left, mid
    return start, start + counts


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def draws(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5, cap: float = 2.0, shards: int | None = None, seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes: ``(id, source, epoch, shard)``, and per row ``(id, source, size, source_size, target)``.

    Rows of one id and source are drawn together, each as often. A null text has no words; null ids and
    sources are values like others. Documents without words are never drawn. Targets are words; a
    source's draws differ from its target by less than its longest document. Equal input gives equal
    draws whatever the partitioning. An empty table draws nothing.
    """
    spark = docs.sparkSession
    rows = saved(word_counts(docs, id_col, text_col, source_col), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = saved(targets(sizes, weights, share, cap), "targets")
    per_row = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(rows["id"], rows["source"], "size", "source_size", "target")

    units = per_row.where("size > 0").groupBy("id", "source", "source_size", "target").agg(F.sum("size").alias("words"))
    n_blocks = F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("source_size") / LEAST_WORDS)).cast("long")
    units = saved(units.withColumn("block", F.pmod(_hash(seed, "source", "id"), n_blocks)), "units")
    blocks = units.groupBy("source", "source_size", "target", "block").agg(F.sum("words").alias("words"))
    # Whole passes are epochs 0 .. passes - 1, what is left of the target is the epoch after them.
    passes = F.floor(F.col("target") / F.col("source_size")).cast("int")
    blocks = blocks.withColumn("passes", passes).withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
    whole = blocks.where("passes > 0").select("source", "block", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("epoch"), F.lit(None).cast("double").alias("room"))
    order = Window.partitionBy("source").orderBy(_hash(seed + 1, "source", "block"), "block")
    part = blocks.withColumn("before", F.sum("words").over(order) - F.col("words")).where(F.col("before") < F.col("left"))
    part = part.select("source", "block", F.col("passes").alias("epoch"), F.when(F.col("before") + F.col("words") > F.col("left"), F.col("left") - F.col("before")).alias("room"))
    chosen = whole.unionByName(part)
    place = F.row_number().over(Window.partitionBy("source").orderBy(_hash(seed + 2, "source", "epoch", "block"), "epoch", "block")) - 1
    chosen = saved(chosen.withColumn("place", place.cast("long")), "chosen")

    # One number per source: the state of the splitting tree.
    quotas = chosen.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.col("source").isNull(), "source").collect()
    names, counts = [r["source"] for r in quotas], np.array([r["n"] for r in quotas], dtype=np.int64)
    if shards is None:
        shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def paths(batches):
        for pdf in batches if names else ():
            for shard in pdf["id"]:
                start, end = split_quotas(counts, shards, int(shard), seed)
                yield pd.DataFrame({"source": names, "shard": int(shard), "start": start, "end": end})

    kind = rows.schema["source"].dataType.simpleString()
    ranges = spark.range(shards).mapInPandas(paths, f"source {kind}, shard int, start long, end long").where("end > start")
    spots = ranges.select(F.col("source").alias("s"), "shard", F.explode(F.sequence("start", F.col("end") - 1)).alias("p"))
    dealt = chosen.join(spots, chosen["source"].eqNullSafe(spots["s"]) & (chosen["place"] == spots["p"])).select("source", "block", "epoch", "room", "shard")

    both = units.withColumnRenamed("source", "s").withColumnRenamed("block", "b").join(dealt, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block")))
    taken = both.where("room IS NULL").select("id", "source", "epoch", "shard")
    # Inside the one block of a source that is not taken whole: documents while at least half of the
    # next fits, those long beside the target last.
    inside = Window.partitionBy("source", "block", "epoch").orderBy(F.col("words") * 200 > F.col("target"), _hash(seed + 3, "id"), "id")
    cut = both.where("room IS NOT NULL").withColumn("upto", F.sum("words").over(inside))
    taken = taken.unionByName(cut.where(F.col("upto") - F.col("words") / 2 <= F.col("room")).select("id", "source", "epoch", "shard"))
    return taken, per_row


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as rows of ``docs`` in all their columns, repeated as drawn, shard by shard in shuffled order.

    Each shard is one hash partition of the result; a hot shard does not arise, as shards hold equal
    numbers of blocks.
    """
    taken, _ = draws(docs, id_col, text_col, source_col, **options)
    # The row travels as one value, so that none of its columns can meet one of the draw's.
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row")[id_col].eqNullSafe(F.col("id")) & F.col("row")[source_col].eqNullSafe(F.col("source"))
    both = rows.join(taken, same)
    seed = options.get("seed", 17)
    dealt = both.repartition("shard").sortWithinPartitions("shard", _hash(seed + 4, "epoch", "id"), "epoch", "id")
    return dealt.select("row.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row: the words the mix takes of it, repeats counted."""
    taken, per_row = draws(docs, **options)
    times = taken.groupBy("id", "source").agg(F.count("*").alias("times")).select(F.col("id").alias("i"), F.col("source").alias("s"), "times")
    both = per_row.join(times, F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")), "left")
    return both.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.coalesce("times", F.lit(0)) * F.col("size")).alias("taken"))
