"""Sharding by histogram sort: shards of near equal bytes in one exchange.

Rows are ordered by a hash of the text, then by a hash of the id. Candidate
boundaries are probed: every partition counts exactly how many bytes of it lie below
each, the counts are added up, and probes close in on the places where the next shard
has to begin until all are within the tolerance. A boundary lies between texts, so
equal texts are one group and stay in one shard. Then rows move once.

Texts whose rows together weigh more than the tolerance are found by an exact sum; there
are at most n_shards / tolerance of them. They are given to shards first, the heaviest
first, each whole to the shard that has least so far. If that makes shards more even, texts
of several rows for which no shard has room are taken apart, at first only those that weigh
more than a shard: rows that are heavy
themselves are given to shards one by one, and the light rest is cut between ids into
pieces that fill the shards with the most room. A single row is never cut. The light
texts then fill shards up to one level. All boundaries are probed together, a job a round,
so the number of jobs does not grow with the number of texts.

Results for odd input: a null text weighs as an empty one; a null id is an id like
others and stays null; rows equal in id and text are one unit and stay in one shard;
an empty table gives no rows. Other columns ride along; one that is named like an added
one gives way to it.
"""

from __future__ import annotations

import bisect
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from siltstone.llm._scratch import persist, shuffle_width

SPAN = 1 << 64
HALF = 1 << 63
PROBES = 24
ADDED = ("size", "text_crc32", "shard", "slot")
HI, LO, FINE, COUNT = "_silt_hi", "_silt_lo", "_silt_fine", "_silt_n"


def _keys(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias(HI), F.xxhash64(F.col(id_col)).alias(LO), (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32")]


def _as_bytes(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Keys that compare as bytes do; a last byte keeps zeros at the end from being lost."""
    out = np.ones((len(hi), 17), np.uint8)
    out[:, :8] = (hi.astype(np.int64).view(np.uint64) ^ np.uint64(HALF)).astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8:16] = (lo.astype(np.int64).view(np.uint64) ^ np.uint64(HALF)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S17").ravel()


def bytes_below(keys: DataFrame, probes: list[int]) -> list[int]:
    """Exact sum of size over all keys below each probe."""
    asked = np.frombuffer(b"".join(p.to_bytes(16, "big") + b"\0" for p in probes), "S17")

    def run(batches):
        total = np.zeros(len(asked), np.int64)
        for rb in batches:
            k = _as_bytes(rb.column(0).to_numpy(), rb.column(1).to_numpy())
            order = np.argsort(k)
            sums = np.concatenate([[0], np.cumsum(rb.column(2).to_numpy()[order])])
            total += sums[np.searchsorted(k[order], asked)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked), dtype=np.int32)), pa.array(total)], names=["p", "n"])

    rows = keys.select(HI, LO, "size").mapInArrow(run, "p int, n long").groupBy("p").agg(F.sum("n").alias("n")).collect()
    found = {r.p: r.n for r in rows}
    return [found.get(i, 0) for i in range(len(probes))]


def find_splitters(keys: DataFrame, targets: list[int], allowed: int, step: int = SPAN, given: dict[int, int] | None = None) -> list[int]:
    """For each target a key of 128 bits below which about so many bytes lie; boundaries are multiples of step (SPAN: between texts). given: sums below keys that are known already."""
    if not targets:
        return []
    total = keys.agg(F.sum("size")).first()[0] or 0
    known = {0: 0, SPAN * SPAN: total} | (given or {})
    n = 8 * (len(targets) + 1)
    probes = [] if given else sorted({SPAN * SPAN * i // n // step * step for i in range(1, n)} - known.keys())
    while True:
        for at in range(0, len(probes), 1 << 16):
            some = probes[at : at + (1 << 16)]
            known.update(zip(some, bytes_below(keys, some), strict=True))
        order = sorted(known)
        sums = [known[k] for k in order]
        new: set[int] = set()
        for t in targets:
            i = min(bisect.bisect_right(sums, t) - 1, len(order) - 2)
            if min(t - sums[i], sums[i + 1] - t) <= allowed // 2:
                continue
            a, z = -(-(order[i] + 1) // step), (order[i + 1] - 1) // step
            n = z - a + 1
            # hashes are even over their range: look closest where the target should be
            at = a + (n - 1) * (t - sums[i]) // max(sums[i + 1] - sums[i], 1)
            near = [at + sign * (n >> (4 * e)) for e in range(1, PROBES // 4) for sign in (-1, 1)]
            even = [a + (n - 1) * j // max(PROBES - 1, 1) for j in range(PROBES)]
            new.update(p * step for p in (*near, at, *even) if a <= p <= z)
        probes = sorted(new - known.keys())
        if not probes:
            break
    out = []
    for t in targets:
        i = min(bisect.bisect_left(sums, t), len(sums) - 1)
        out.append(order[i] if i == 0 or sums[i] - t <= t - sums[i - 1] else order[i - 1])
    return out


def place_groups(groups: list[tuple[int, int, list[tuple[int, int]], int]], share: int, n_shards: int, allowed: int, apart_from: int = 0) -> tuple[dict[int, int], dict[tuple[int, int], int], dict[int, list[tuple[int, int]]], list[int]]:
    """Heavy texts to shards, heaviest first, each to the one with least.

    groups: key, bytes, heavy rows (key, bytes) and number of rows. A text of several rows
    is taken apart if it does not fit and weighs more than apart_from. Returns the shard of
    each whole text, that of each heavy row of texts that are taken apart, pieces
    (shard, bytes) of what is left of these, and the bytes of each shard.
    """
    used = [(0, s) for s in range(n_shards)]
    heapq.heapify(used)
    whole: dict[int, int] = {}
    single: dict[tuple[int, int], int] = {}
    todo = [(-weight, key, None, tuple(rows), n) for key, weight, rows, n in groups]
    heapq.heapify(todo)
    fluid: list[tuple[int, int]] = []
    while todo:
        weight, key, row, rows, n = heapq.heappop(todo)
        weight = -weight
        have, s = used[0]
        if row is None and n > 1 and weight > apart_from and have + weight > share + allowed:
            for r, w in rows:
                heapq.heappush(todo, (-w, key, r, (), 1))
            if rest := weight - sum(w for _, w in rows):
                fluid.append((key, rest))
            continue
        heapq.heapreplace(used, (have + weight, s))
        if row is None:
            whole[key] = s
        else:
            single[key, row] = s
    pieces: dict[int, list[tuple[int, int]]] = {}
    for key, left in sorted(fluid, key=lambda g: (-g[1], g[0])):
        while left > 0:
            have, s = used[0]
            # the last piece may go over the share by the tolerance
            part = left if have >= share or left <= share - have + allowed else share - have
            pieces.setdefault(key, []).append((s, part))
            heapq.heapreplace(used, (have + part, s))
            left -= part
    return whole, single, pieces, [w for w, _ in sorted(used, key=lambda u: u[1])]


def fill_to_level(used: list[int], more: int) -> list[int]:
    """How much of `more` each shard gets, so that all that get any end at one level."""
    order = sorted(range(len(used)), key=lambda s: used[s])
    level, spare = used[order[0]], more
    for i, s in enumerate(order):
        need = i * (used[s] - level)
        if need > spare:
            break
        level, spare, n = used[s], spare - need, i + 1
    out = [0] * len(used)
    for i, s in enumerate(order[:n]):
        out[s] = level - used[s] + spare // n + (i < spare % n)
    return out


def plan(keys: DataFrame, n_shards: int, tolerance: float) -> tuple[list[tuple[int, list[tuple[int, int]], list[tuple[int, int]]]], list[int]]:
    """Of heavy texts (hash, [(first id hash, shard)] of pieces, [(id hash, shard)] of rows); the splitters of all others."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    allowed = max(1, int(total / n_shards * tolerance))
    # rows equal in id and text are one
    rows = keys.groupBy(HI, LO).agg(F.sum("size").alias("w"))
    large = F.filter(F.collect_list(F.when(F.col("w") > allowed, F.struct(F.col(LO).alias("lo"), "w"))), lambda x: x.isNotNull())
    # at most n_shards / tolerance texts, and as many heavy rows
    heavy = [(r[HI], r["n"], [(x["lo"], x["w"]) for x in r["large"]], r["rows"]) for r in rows.groupBy(HI).agg(F.sum("w").alias("n"), F.count("*").alias("rows"), large.alias("large")).where(F.col("n") > allowed).collect()]
    share, rest = -(-total // n_shards), total - sum(h[1] for h in heavy)
    ways = [place_groups(heavy, share, n_shards, allowed, most) for most in (total, share, 0)]
    after = [[u + x for u, x in zip(used, fill_to_level(used, rest), strict=True)] for *_, used in ways]
    spread = [max(a) - min(a) for a in after]
    # texts are taken apart, first those above a share, only if that makes shards more even
    whole, single, pieces, used = next(w for w, x in zip(ways, spread, strict=True) if x <= min(spread) + allowed)
    spark = keys.sparkSession
    told: dict[int, tuple[list, list]] = {k: ([(-HALF, s)], []) for k, s in whole.items()}
    for (k, lo), s in single.items():
        told.setdefault(k, ([], []))[1].append((lo, s))
    if pieces:
        ends = {k: np.cumsum([w for _, w in parts]).tolist() for k, parts in pieces.items()}
        apart = spark.createDataFrame([(k,) for k in pieces], f"{HI} long")
        own = keys.join(F.broadcast(apart), HI, "left_semi")
        if single:
            taken = spark.createDataFrame(list(single), f"{HI} long, {LO} long")
            own = own.join(F.broadcast(taken), [HI, LO], "left_anti")
        known, targets, base = {}, [], 0
        for k in sorted(pieces):
            known[(k + HALF) * SPAN] = base
            targets += [base + e for e in ends[k][:-1]]
            base += ends[k][-1]
            known[(k + HALF + 1) * SPAN] = base
        cuts = iter(find_splitters(own, targets, allowed, 1, known))
        for k in sorted(pieces):
            first = [-HALF] + [min(max(next(cuts) - (k + HALF) * SPAN, 0), SPAN - 1) - HALF for _ in pieces[k][1:]]
            told.setdefault(k, ([], []))[0].extend(zip(first, (s for s, _ in pieces[k]), strict=True))
    light = keys.join(F.broadcast(spark.createDataFrame([(h[0],) for h in heavy], f"{HI} long")), HI, "left_anti") if heavy else keys
    ends = np.cumsum(fill_to_level(used, rest)).tolist()
    return [(k, *lists) for k, lists in told.items()], find_splitters(light, ends[:-1], allowed) if rest else [SPAN * SPAN] * (n_shards - 1)


def shard_of(splitters: list[int]) -> Column:
    """How many splitters are at or below the key: first among groups of them, then within one."""
    n = max(1, int(len(splitters) ** 0.5))
    # one at the very end is above every key
    keys = [(s // SPAN - HALF, s % SPAN - HALF) for s in splitters if s < SPAN * SPAN]
    groups = [keys[i : i + n] for i in range(0, len(keys), n)]
    if not groups:
        return F.lit(0)
    kind = "array<struct<hi:long,lo:long>>"
    at = F.struct(F.col(HI).alias("hi"), F.col(LO).alias("lo"))
    listed = lambda g: F.array(*(F.struct(F.lit(h).cast("long").alias("hi"), F.lit(x).cast("long").alias("lo")) for h, x in g)).cast(kind)
    below = lambda a: F.size(F.filter(a, lambda s: s <= at))
    group = below(listed([g[0] for g in groups]))
    inside = F.element_at(F.array(*(listed(g) for g in groups)), group)
    return F.when(group == 0, 0).otherwise((group - 1) * n + below(inside)).cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.0025, rows_per_task: int = 100_000) -> DataFrame:
    """Adds size, text_crc32, shard (from 0) and slot (gapless from 0 in each shard) to docs."""
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c.lower() not in ADDED]
    keyed = docs.select(F.struct(*carried).alias("row"), *_keys(id_col, text_col))
    keys = persist(keyed.select(HI, LO, "size"), "keys")
    told, splitters = plan(keys, n_shards, tolerance)
    kind = "array<struct<lo:long,shard:int>>"
    # at most n_shards / tolerance texts, rows and pieces
    listed = spark.createDataFrame(told, f"{HI} long, pieces {kind}, rows {kind}").select(HI, F.sort_array("pieces").alias("pieces"), "rows")
    by_piece = F.coalesce(F.get(F.filter("rows", lambda p: p["lo"] == F.col(LO)), F.lit(0))["shard"], F.get(F.reverse(F.filter("pieces", lambda p: p["lo"] <= F.col(LO))), F.lit(0))["shard"])
    by_key = shard_of(splitters)

    def place(df: DataFrame) -> DataFrame:
        known = df.join(F.broadcast(listed), HI, "left") if told else df.withColumns({"pieces": F.lit(None).cast(kind), "rows": F.lit(None).cast(kind)})
        return known.withColumns({"shard": F.when(F.col("pieces").isNotNull(), by_piece).otherwise(by_key), FINE: F.pmod(F.xxhash64(LO, HI), F.lit(fine)).cast("int")}).drop("pieces", "rows")

    fine = max(-(-keys.count() // (n_shards * rows_per_task)), -(-2 * shuffle_width(spark) // n_shards))
    counts = place(keys).groupBy("shard", FINE).count()
    before = counts.withColumn(COUNT, F.sum("count").over(W.Window.partitionBy("shard").orderBy(FINE)) - F.col("count")).drop("count")
    within = W.Window.partitionBy("shard", FINE).orderBy(HI, LO)
    placed = place(keyed).withColumn("number", F.row_number().over(within)).join(before, ["shard", FINE])
    return placed.select("row.*", "size", "text_crc32", "shard", (F.col(COUNT) + F.col("number") - 1).alias("slot"))
