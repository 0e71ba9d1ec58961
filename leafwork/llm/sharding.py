"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows are dealt into blocks by a hash of their contents. How many rows of each block go to each cell of the target
(a cell is a part of a shard) is drawn exactly as a uniform permutation would have it: a matrix whose row sums are
the blocks' sizes and whose column sums are the cells' sizes. Rows are permuted in their block, cut up by the
matrix, exchanged, and permuted again in their cell. The matrix is drawn by halving the blocks again and again: what
the halves send to each cell are hypergeometric numbers. The driver draws the first halves, tasks the others.

Law `rows`: the shards' row counts are at most one apart. All random choices follow from the seed and the rows'
contents, so a task that runs again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import e, floor, isqrt, lgamma, log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwork.llm.common import cut

#: Blocks that a task draws the rest of the matrix for; entries of the matrix that may be broadcast.
BLOCKS, MOST_BROADCAST = 64, 2_000_000


def communication_matrix(sizes: list[int], targets: list[int], seed: int) -> np.ndarray:
    """counts[block, cell]: what a uniform permutation of all rows sends from each block to each cell."""
    if sum(sizes) != sum(targets):
        raise ValueError("sizes and targets must have the same sum")
    out = np.zeros((len(sizes), len(targets)), dtype=np.int64)
    for first, _, needs in halved(0, list(sizes), np.array(targets, np.int64), seed, 1):
        out[first] = needs
    return out


def halved(first: int, sizes: list[int], needs: np.ndarray, seed: int, least: int) -> list[tuple[int, list[int], np.ndarray]]:
    """The blocks (their sizes, from number `first` on) halved until `least` are left together, each half with what it
    sends to each cell. Each half draws with a seed of its own, so the halves can be halved on, anywhere."""
    if len(sizes) <= least:
        return [(first, sizes, needs)]
    half = len(sizes) // 2
    rng = np.random.default_rng([seed, first, len(sizes)])
    want, rest, left = sum(sizes[:half]), int(needs.sum()), np.zeros_like(needs)
    for c, n in enumerate(needs.tolist()):  # one hypergeometric draw for each cell, given what is settled
        rest -= n
        left[c] = got = draw(rng, n, rest, want)
        want -= got
    return halved(first, sizes[:half], left, seed, least) + halved(first + half, sizes[half:], needs - left, seed, least)


def draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric number: how many of the sample are good. numpy draws it for populations below 1e9."""
    if good == 0 or sample == 0:
        return 0
    if bad == 0 or sample == good + bad:
        return min(good, sample)
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    return draw_large(rng, good, bad, sample)


def _log_step(x: int, d: int) -> float:
    """log((x + d)!) - log(x!) - d * log(x), without the loss of digits that the logarithms of large factorials have."""
    if min(x, x + d) < 64:
        return lgamma(x + d + 1) - lgamma(x + 1) - d * log(max(x, 1))
    return (x + d + 0.5) * log1p(d / x) - d + 1 / (12 * (x + d)) - 1 / (12 * x)


def draw_large(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """The same for any size, by the ratio-of-uniforms rejection for unimodal laws (Stadlober 1989)."""
    total = good + bad
    few, taken = min(good, bad), min(sample, total - sample)
    mean = taken * few / total
    spread = sqrt(mean * (total - few) / total * (total - taken) / (total - 1))
    mode = (taken + 1) * (few + 1) // (total + 2)
    low, high = max(0, taken - (total - few)), min(taken, few)
    width = 2 * sqrt(2 / e) * sqrt(spread * spread + 0.5) + 3 - 2 * sqrt(3 / e)
    corners = mode, few - mode, taken - mode, total - few - taken + mode
    slope = log(max(corners[0], 1)) - log(max(corners[1], 1)) - log(max(corners[2], 1)) + log(max(corners[3], 1))
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = floor(mean + 0.5 + width * (v - 0.5) / u)
        if not low <= k <= high:
            continue
        d = k - mode
        chance = -d * slope - sum(_log_step(x, y) for x, y in zip(corners, (d, -d, -d, d)))
        if 2 * log(u) <= chance:
            break
    k = k if good <= bad else taken - k
    return k if taken == sample else good - k


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Row counts that are at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _runs(spark: SparkSession, sizes: list[int], cells: list[int], seed: int) -> DataFrame:
    """The matrix as rows: block, and its cells' ends among the block's places, in chunks of about the root of their number.

    The driver halves the blocks down to groups of BLOCKS; tasks draw the rest.
    """
    step = max(1, round(len(cells) ** 0.5))
    groups = [(first, list(map(int, part)), needs.tolist()) for first, part, needs in halved(0, sizes, np.array(cells, np.int64), seed, BLOCKS)]
    kinds = {"first": pa.int64(), "sizes": pa.list_(pa.int64()), "needs": pa.list_(pa.int64())}
    table = pa.table({name: pa.array([g[k] for g in groups], kind) for k, (name, kind) in enumerate(kinds.items())})

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.to_pylist():
                for block, _, needs in halved(g["first"], g["sizes"], np.array(g["needs"], np.int64), seed, 1):
                    ends = np.cumsum(needs)
                    chunks = [ends[i : i + step].tolist() for i in range(0, len(ends), step)]
                    heads = pa.array([[c[-1] for c in chunks]], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), heads, pa.array([chunks], pa.list_(pa.list_(pa.int64())))], names=["_block", "_heads", "_ends"])

    found = spark.createDataFrame(table).repartition(max(1, len(groups))).mapInArrow(expand, "_block long, _heads array<long>, _ends array<array<long>>")
    # Drawn once: the rows below are joined with it more than once.
    return cut(found)


def shuffle_into_shards(df: DataFrame, key: str, shards: int, seed: int = 8, rows_per_block: int = 1024) -> DataFrame:
    """Adds law (`rows`), shard (from 0), slot (gapless from 0 in each shard) and grown_shard (null) to each row.

    df should be narrow: its rows are shuffled twice. Blocks and cells have rows_per_block rows, or 16 times the root of
    the number of rows where that is more: so the matrix has a 256th of the rows as entries at most, and tasks grow with
    the root only. Rows are ordered by hashes of all their columns, so equal rows are interchangeable and nothing depends
    on the partitions of df. An empty table gives no rows. Columns of df with the added names are replaced.
    """
    df = cut(df.drop("law", "shard", "slot", "grown_shard"))
    spark, n = df.sparkSession, df.count()
    size = max(rows_per_block, 16 * isqrt(n))
    blocks, parts = max(1, n // size), max(1, n // shards // size)
    cells = [c for s in shard_sizes(n, shards) for c in shard_sizes(s, parts)]
    starts = np.concatenate([np.cumsum([0, *cells[i : i + parts - 1]]) for i in range(0, len(cells), parts)])
    own = [F.col(f"`{c}`") for c in df.columns]
    block, h, again = (F.xxhash64(F.lit(seed + k), *own) for k in range(3))
    rows = df.select(F.struct(*own).alias("row"), F.pmod(block, F.lit(blocks)).alias("_block"), h.alias("_h"), again.alias("_again"))
    counted = {r["_block"]: r["count"] for r in rows.groupBy("_block").count().collect()}
    runs = _runs(spark, [counted.get(b, 0) for b in range(blocks)], cells, seed)
    runs = F.broadcast(runs) if blocks * len(cells) <= MOST_BROADCAST else runs
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy("_block").orderBy("_h", "row")) - 1).join(runs, "_block")
    before = lambda ends: F.size(F.filter(ends, lambda c: c <= F.col("_place")))
    chunk = before(F.col("_heads"))
    cell = chunk * max(1, round(len(cells) ** 0.5)) + before(F.get("_ends", chunk))
    rows = rows.select("row", "_again", cell.cast("int").alias("_cell"))
    first = spark.createDataFrame(pa.table({"_cell": pa.array(np.arange(len(cells)), pa.int32()), "_first": pa.array(starts, pa.int64())}))
    first = F.broadcast(first) if len(cells) <= MOST_BROADCAST else first
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_cell").orderBy("_again", "row")) - 1).join(first, "_cell")
    shard = F.floor(F.col("_cell") / parts).cast("int").alias("shard")
    return rows.select("row.*", F.lit("rows").alias("law"), shard, (F.col("_first") + F.col("_nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
