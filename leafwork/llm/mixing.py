"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks. A source of weight w releases its block j at floor(j / w) and needs it placed
by ceil((j + 1) / w). Earliest deadline first, among released blocks, gives every slot to one block so that at all
times each source has had its weight's share of the slots to within less than one block.

The windows are those of the given weights, taken as exact fractions, so the bound holds for them over any number of
slots. The driver makes the schedule slot by slot: time in proportion to the number of blocks, and four numbers and a
name for each block. When a source runs out, the weights of the others are renewed and a new phase begins; there are
at most as many phases as sources. All documents are kept.
"""

from __future__ import annotations

from array import array
from fractions import Fraction
from heapq import heappop, heappush
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwork.llm.common import cut

def exact_weights(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the proportion of the weights."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    whole = lcm(*(x.denominator for x in exact.values()))
    return {k: int(x * whole) for k, x in exact.items()}


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> tuple[list[str], dict[str, array]]:
    """The sources, and for each slot its source (by its place in that list), block, phase, release and deadline.

    Each phase ends with the slot in which a source places its last block. Sources that have placed nothing in a
    phase wait in the order of their weights, which is that of their first deadlines, so that a new phase costs
    nothing for them.
    """
    share = exact_weights(weights)
    names = sorted((k for k, n in blocks.items() if n), key=lambda k: (-share[k], k))
    share, left = [share[k] for k in names], [blocks[k] for k in names]
    placed = [0] * len(names)
    following, before = [*range(1, len(names)), -1], [*range(-1, len(names) - 1)]  # of the sources that are not used up
    first, total = 0 if names else -1, sum(share)
    out = {"source": array("i"), "block": array("q"), "phase": array("i"), "release": array("q"), "deadline": array("q")}
    start = phase = 0
    while first >= 0:
        fresh = first
        ready: list[tuple[int, int, int, int]] = []
        releases: dict[int, list[tuple[int, int]]] = {}
        slot, ended = 0, -1
        while ended < 0:
            for k, j in releases.pop(slot, ()):
                heappush(ready, (-(-(j + 1) * total // share[k]), k, j, j * total // share[k]))
            waiting = (-(-total // share[fresh]), fresh, 0, 0) if fresh >= 0 else None
            if waiting and (not ready or waiting < ready[0]):
                d, k, j, r = waiting
                fresh = following[fresh]
            else:
                d, k, j, r = heappop(ready)
            if not r <= slot < d:
                raise AssertionError("a block missed its window")
            for name, v in (("source", k), ("block", placed[k]), ("phase", phase), ("release", start + r), ("deadline", start + d)):
                out[name].append(v)
            placed[k] += 1
            slot += 1
            if placed[k] == left[k]:
                ended = k
            else:
                releases.setdefault(max(slot, (j + 1) * total // share[k]), []).append((k, j + 1))
        a, b = before[ended], following[ended]
        if a >= 0:
            following[a] = b
        else:
            first = b
        if b >= 0:
            before[b] = a
        total -= share[ended]
        start, phase = start + slot, phase + 1
    return names, out


#: Rows of a table that may be broadcast: about 100 MB at most.
MOST_BROADCAST = 2_000_000


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast if its number of rows has the bound; else Spark joins it by key."""
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def _numbered(rows: DataFrame, counts: dict[str | None, int], per_bucket: int) -> tuple[DataFrame, DataFrame]:
    """Rows (with stream and _mix) dealt into buckets of about per_bucket rows by ranges of _mix, so that none is large;
    and for each stream and bucket how many of the stream's rows come before it."""
    # Only streams of more than one bucket are named, so at most one for each 2 * per_bucket rows.
    named = [(k, n // per_bucket) for k, n in counts.items() if n >= 2 * per_bucket]
    buckets = rows.sparkSession.createDataFrame(named, "_s string, _buckets long")
    rows = rows.join(_bounded(buckets, len(named)), F.col("stream") == F.col("_s"), "left").drop("_s").withColumn("_buckets", F.coalesce("_buckets", F.lit(1)))
    at = F.floor(F.col("_mix") / F.lit(float(1 << 63)) * F.col("_buckets"))
    rows = rows.withColumn("_bucket", F.least(at, F.col("_buckets") - 1).cast("long")).drop("_buckets")
    tally = cut(rows.groupBy("stream", "_bucket").count().withColumn("_group", F.floor(F.col("_bucket") / 1024)))
    coarse = tally.groupBy("stream", "_group").agg(F.sum("count").alias("_rows"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("_before", F.coalesce(F.sum("_rows").over(upto(Window.partitionBy("stream").orderBy("_group"))), F.lit(0)))
    inside = F.sum("count").over(upto(Window.partitionBy("stream", "_group").orderBy("_bucket")))
    offsets = tally.withColumn("_in", F.coalesce(inside, F.lit(0))).join(coarse, ["stream", "_group"])
    return rows, offsets.select("stream", "_bucket", (F.col("_before") + F.col("_in")).alias("_offset"))


def _scheduled(df: DataFrame, source: str, weights: dict[str, float] | None, temperature: float) -> tuple[Column, dict[str, int], dict[str, float]]:
    """The stream of each row, the streams' rows and their weights. Stream names are marked, so no source can be taken
    for the rest: `=name`, or `*` for the rest."""
    named = F.concat(F.lit("="), F.col(source).cast("string"))
    if weights is not None:
        wanted = df.sparkSession.createDataFrame([(f"={k}",) for k in weights], "s string")
        known = {r["s"] for r in df.select(named.alias("s")).distinct().join(wanted, "s", "left_semi").collect()}
        named = F.when(named.isin(sorted(known)), named) if known else F.lit(None).cast("string")
    stream = F.coalesce(named, F.lit("*"))
    counts = {r["stream"]: r["count"] for r in df.groupBy(stream.alias("stream")).count().collect()}
    weights = {k: n**temperature for k, n in counts.items()} if weights is None else {f"={k}": w for k, w in weights.items()}
    least = min([w for w in weights.values() if w > 0], default=1.0)
    return stream, counts, {k: weights.get(k, 0) or least for k in counts}


def _slots(spark: SparkSession, counts: dict[str, int], weights: dict[str, float], documents_per_block: int) -> DataFrame:
    """The schedule as a table: stream, block, phase, release, deadline and slot of each block."""
    names, plan = schedule({k: -(-n // documents_per_block) for k, n in counts.items()}, weights)
    number = {n: pa.array(plan[n], pa.int32() if plan[n].typecode == "i" else pa.int64()) for n in plan}
    stream = pa.array(names, pa.string()).take(number.pop("source"))
    table = pa.table({"stream": stream, **number, "slot": pa.array(range(len(stream)), pa.int64())})
    return _bounded(spark.createDataFrame(table), len(stream))


def _hash(seed: int, columns: list[Column]) -> Column:
    """A number in [0, 2**63) that depends on the seed and the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def mix(df: DataFrame, weights: dict[str, float] | None = None, source: str = "source", documents_per_block: int = 32, temperature: float = 0.5, seed: int = 4) -> DataFrame:
    """Adds stream, block, phase, release, deadline, slot and place (in the block) to each row; order by slot, place.

    weights: by source; other sources share the stream of the rest, whose weight is the least one. Without weights,
    each source gets the weight of its size to the power of the temperature. A stream is the source's name, or null for
    the rest; a null source belongs to the rest. Any number of sources is scheduled; the driver has one row
    for each. The order within a source is a permutation by a hash of all columns, so rows with one id, or none, are
    dealt like any others; equal rows are interchangeable. An empty table gives no rows. Columns of df with the added
    names are replaced.
    """
    df = df.drop("stream", "block", "phase", "release", "deadline", "slot", "place")
    own = [F.col(f"`{c}`") for c in df.columns]
    stream, counts, weights = _scheduled(df, source, weights, temperature)
    rows, offsets = _numbered(df.select(F.struct(*own).alias("row"), stream.alias("stream"), _hash(seed, own).alias("_mix")), counts, 1024)
    order = Window.partitionBy("stream", "_bucket").orderBy("_mix", "row")
    rows = rows.join(offsets, ["stream", "_bucket"]).withColumn("_n", F.col("_offset") + F.row_number().over(order) - 1)
    rows = rows.withColumns({"block": F.floor(F.col("_n") / documents_per_block).cast("long"), "place": (F.col("_n") % documents_per_block).cast("int")})
    rows = rows.join(_slots(df.sparkSession, counts, weights, documents_per_block), ["stream", "block"])
    name = F.when(F.col("stream") != "*", F.substring("stream", 2, 1 << 30)).alias("stream")
    return rows.select("row.*", name, "block", "phase", "release", "deadline", "slot", "place")


def in_order(
    df: DataFrame, parts: int, weights: dict[str, float] | None = None, source: str = "source", documents_per_block: int = 32, temperature: float = 0.5, seed: int = 4
) -> DataFrame:
    """The rows of df in the order of the schedule of `mix`, in `parts` partitions of about the same number of slots.

    Whole rows are moved once: which part a row belongs to follows from its hash, by the part's first hash in each
    stream, and its slot from its number among the stream's rows in the part. Parts and slots are found on the hashes
    alone. The rows keep their columns, whatever these are called.
    """
    spark = df.sparkSession
    own = [F.col(f"`{c}`") for c in df.columns]
    stream, counts, weights = _scheduled(df, source, weights, temperature)
    if not counts:
        return df
    slots = cut(_slots(spark, counts, weights, documents_per_block))
    blocks = sum(-(-n // documents_per_block) for n in counts.values())
    slots = _bounded(slots, blocks)
    rows, offsets = _numbered(df.select(F.struct(*own).alias("row"), stream.alias("stream"), _hash(seed, own).alias("_mix")), counts, 1024)
    offsets = cut(offsets)
    hashes = rows.select("stream", "_bucket", "_mix").join(offsets, ["stream", "_bucket"])
    # Rows with one hash have the number of the first of them, so that they stay in one part.
    number = F.col("_offset") + F.rank().over(Window.partitionBy("stream", "_bucket").orderBy("_mix")) - 1
    placed = hashes.withColumn("_n", number).withColumn("block", F.floor(F.col("_n") / documents_per_block).cast("long")).join(slots, ["stream", "block"])
    # Ranges of slots finer than the parts, which sampling then cuts evenly.
    part = F.floor(F.col("slot") * (4 * parts) / blocks).cast("int")
    cuts = cut(placed.groupBy("stream", "_bucket", part.alias("_part")).agg(F.min("_mix").alias("_mix"), F.min("_n").alias("_first")))
    firsts = cut(cuts.groupBy("stream", "_part").agg(F.min("_first").alias("_first")))
    found = cuts.groupBy("stream", "_bucket").agg(F.sort_array(F.collect_list(F.struct("_mix", "_part"))).alias("_cuts"))
    rows = rows.join(_bounded(found, offsets.count()), ["stream", "_bucket"])
    inside = F.filter("_cuts", lambda c: c["_mix"] <= F.col("_mix"))
    rows = rows.select("row", "stream", "_mix", F.element_at(inside, -1)["_part"].alias("_part")).repartitionByRange(parts, "_part")
    nth = F.row_number().over(Window.partitionBy("_part", "stream").orderBy("_mix", "row")) - 1
    rows = rows.withColumn("_nth", nth).join(_bounded(firsts, firsts.count()), ["stream", "_part"])
    rows = rows.withColumn("_n", F.col("_first") + F.col("_nth")).withColumn("block", F.floor(F.col("_n") / documents_per_block).cast("long"))
    rows = rows.join(slots.select("stream", "block", "slot"), ["stream", "block"])
    return rows.sortWithinPartitions("slot", (F.col("_n") % documents_per_block)).select("row.*")
