"""Connected components and splitting of large groups, by joins and aggregates only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm._scratch import discard, persist, trimmed


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    Large-star and small-star steps in turn until no edge changes. Each round is
    written to the shared folder, so that its lineage does not grow. Only a count
    and a checksum reach the driver.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e = persist(e, "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        last = e
        e = persist(small.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        discard(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def split_groups(rows: DataFrame, group: str, spread: Column, size: int, weight: Column | None = None, single: bool = True) -> DataFrame:
    """Rows with side, lo and hi: groups above `size` (rows, or their weight) are cut into slices, and pairs of slices.

    A task that gets the rows of one (group, lo, hi) compares all its rows if lo = hi,
    else those of side lo with those of side hi. So every pair of a group meets once,
    and no task holds more than about two slices. With `single` only the large groups are
    listed, at most as many as the weight of all rows over `size`; without it groups of one
    row are left out here, which pays where most groups are and rows get wider later.
    """
    counts = rows.groupBy(group).agg(F.sum(weight if weight is not None else F.lit(1)).alias("_n"), F.count("*").alias("_rows"))
    parts = F.ceil(F.col("_n") / size).cast("int").alias("_s")
    if single:
        listed = persist(counts.where(F.col("_n") > size).select(F.col(group).alias("_g"), parts), "large")
    else:
        listed = counts.where("_rows > 1").select(F.col(group).alias("_g"), parts)
    out = rows.join(listed, F.col(group) == F.col("_g"), "left" if single else "inner").withColumn("_s", F.coalesce("_s", F.lit(1))).withColumn("side", F.pmod(spread, F.col("_s")).cast("int"))
    out = out.withColumn("_o", F.explode(F.when(F.col("_s") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_s") - 1))))
    return out.withColumns({"lo": F.least("side", "_o"), "hi": F.greatest("side", "_o")}).drop("_g", "_s", "_o")


def whole_groups(batches, key: list[str], at_least: int):
    """Tables of sorted rows that never cut a group, of at_least rows or what is left."""
    held: list[pa.RecordBatch] = []
    n = 0
    for rb in batches:
        if not rb.num_rows:
            continue
        held.append(rb)
        n += rb.num_rows
        if n < at_least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        cut = int(group_starts(t, key)[-1])
        if cut:
            yield t.slice(0, cut)
        held, n = t.slice(cut).to_batches(), t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(t: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in key:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n items reaches by the links i - j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            return label
        label = new


def link_within_groups(rows: DataFrame, key: list[str], link: Callable, node: str, at_least: int = 50_000) -> DataFrame:
    """Edges (a, b) that connect what link() links, as few as connect it.

    link(table, starts) gives index pairs of linked rows of a table of whole groups.
    """

    def run(batches):
        for t in whole_groups(batches, key, at_least):
            i, j = link(t, group_starts(t, key))
            label = forest(t.num_rows, i, j)
            node_of = t.column(node).to_numpy()
            off = np.flatnonzero(label != np.arange(len(label)))
            off = off[node_of[off] != node_of[label[off]]]
            yield pa.RecordBatch.from_arrays([pa.array(node_of[off]), pa.array(node_of[label[off]])], names=["a", "b"])

    dealt = rows.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(trimmed(run), "a long, b long")
