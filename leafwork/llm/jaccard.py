"""Exact n-gram Jaccard join: a blocked sparse matrix product with size-derived bounds.

The documents are the rows of a sparse incidence matrix, the shingles its columns. Overlap counts of two rows add up
over the columns that they share; what two sets of given sizes must share to link gives all bounds.

Prefix. Of a set's n shingles, in one order for all sets, two sets that link share one among the first
n - share * n + 1. Only these columns are multiplied at first. The order puts shingles that are frequent in a sample
last, by how frequent they are; it changes the cost and not the result.

Products. Rows that share a column form a group. In small groups the shared columns of all pairs are counted, and a
pair below what its sizes ask for is discarded. Then rows are multiplied in full: each with one other at first. Where
all of a group link, they are one class and no other pair matters. Where classes remain apart, the pairs across them
are multiplied: those counted in small groups pair by pair, those of large groups block by block, there again first
the prefix columns and then, for what is not discarded, all. Blocks hold rows of similar sizes, and a block gives back
a forest of links, not one row a pair. So no link that could join two classes is lost, and large groups of copies cost
a few products a row.

Sets are known by 64-bit hashes of their shingles' 64-bit hashes: two of n different sets get the same id with
probability n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import cut, cut_small, release, small_batches, unit_hash

#: Odd multipliers of the hash functions: fixed values.
A, M1, M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
WORDS_KEPT = 100_000
BITMAP_WORDS = 1 << 17
#: Entries of the two sides of a block product: the left one is held by a task, the right one is read in slices.
LEFT, RIGHT = 400_000, 2_000_000


@dataclass(frozen=True)
class Bound:
    """What links: 100 * overlap >= share * union, of sets of `width`-word shingles.

    small: in groups of up to so many rows the pairs across classes are listed, half as many a row at most; larger ones
    are multiplied by blocks. frequent: sorted shingles that come late in the order, ranks: how late. These three
    change the cost, not the result.
    """

    width: int = 3
    share: int = 90
    small: int = 32
    frequent: np.ndarray | None = None
    ranks: np.ndarray | None = None

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The set's prefix: the columns by which it meets all sets that it may link to."""
        if not len(s):
            return s
        if self.frequent is not None and len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)
            late = np.where(self.frequent[at] == s, self.ranks[at], 0)
            if late.any():
                s = s[np.argsort(late, kind="stable")]
        return s[: len(s) - -(-self.share * len(s) // 100) + 1]

    def sizes_allow(self, na: str, nb: str) -> Column:
        """Whether the sizes allow the overlap."""
        return F.least(na, nb) * 100 >= F.greatest(na, nb) * self.share

    def least_shared(self, na: str, nb: str) -> Column:
        """How many prefix columns two sets of these sizes share at least if they link.

        Of the prefix whose last shingle comes first in the order, only shingles that the other set lacks are not
        shared, and by the sizes there are few of those.
        """
        overlap = F.ceil(self.share * (F.col(na) + F.col(nb)) / (100 + self.share))
        shared = [overlap - F.ceil(self.share * F.col(n) / 100) + 1 for n in (na, nb)]
        return F.greatest(F.lit(1), F.least(*shared))

    def may_hold(self, shared: np.ndarray, na: int, nb: np.ndarray) -> np.ndarray:
        """The same bound for counts of shared prefix columns, with that of the sizes."""
        overlap = -(-self.share * (na + nb) // (100 + self.share))
        least = overlap + 1 - np.maximum(-(-self.share * na // 100), -(-self.share * nb // 100))
        return (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * self.share) & (shared >= np.maximum(1, least))

    def holds(self, overlap: np.ndarray, na: np.ndarray | int, nb: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.share * (na + nb - overlap)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * M1
    x = (x ^ (x >> np.uint64(33))) * M2
    return x ^ (x >> np.uint64(33))


_words: dict[bytes, int] = {}


def shingle_set(text: str | None, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of the whole sequence if it is shorter; empty without words."""
    words = (text or "").encode().lower().split()  # of bytes: only A-Z change, only 09 to 0D and space separate
    if not words:
        return np.zeros(0, np.int64)
    if len(_words) > WORDS_KEPT:
        _words.clear()
    ids = []
    for w in words:
        i = _words.get(w)
        if i is None:
            i = _words[w] = xxhash.xxh3_64_intdigest(w)
        ids.append(i)
    x = np.array(ids, dtype=np.uint64)
    n = max(1, len(x) - width + 1)
    h = np.full(n, min(len(x), width), np.uint64)
    for k in range(min(len(x), width)):
        h += x[k : k + n] * np.uint64(pow(int(A), k + 1, 1 << 64))
    return np.unique(mixed(h).view(np.int64))


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit id of the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _texts(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[list[tuple]]:
    """Rows (id, text, ...) in lists of bounded size."""
    rows: list = []
    size = 0
    for batch in batches:
        for pair in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(pair)
            size += len(pair[1] or "")
            if len(rows) >= most_rows or size >= most_bytes:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


KINDS = "kind byte, key long, a long, b long, na long, nb long"
_NAMES = ["kind", "key", "a", "b", "na", "nb"]
DOCUMENT, EDGE, GROUP = 0, 1, 2


def incidence(df: DataFrame, key: str, text_col: str, bound: Bound) -> DataFrame:
    """One pass over the texts. Rows of kind DOCUMENT: key a hash of its text, a its set (null if empty), b its key,
    na its set's size. Rows of
    kind EDGE: for each group of sets that share a block (key), edges from one of them (a) to the others (b).

    Edges inside a task are made there, and only one set of each group travels by the block's key, so a group of
    many copies sends a row from each task at most.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _texts(batches, 4096, 1 << 24):
            sizes, keys, owners, ids = {}, [], [], []
            for _, text, _ in rows:
                s = shingle_set(text, bound.width)
                own = set_id(s) if len(s) else None
                ids.append((own, len(s)))
                if len(s) and own not in sizes:
                    k = bound.keys(s)
                    keys.append(k)
                    owners.append(np.full(len(k), own))
                if own is not None:
                    sizes[own] = len(s)
            n = len(rows)
            number = lambda x: pa.array(x, pa.int64())
            owned, ids, hashes = ([o for o, _ in ids], [x for _, x in ids]), [i for i, _, _ in rows], [h for _, _, h in rows]
            yield _batch(number(np.arange(n)), DOCUMENT, number(hashes), number(owned[0]), number(ids), number(owned[1]), pa.nulls(n, pa.int64()))
            if keys:
                yield from _stars(np.concatenate(keys), np.concatenate(owners), sizes, True)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the group that may go on in the next batch: its key, center and the center's size
        for b in batches:  # in order of the route, which is a group's key
            group = b.column("kind").to_numpy() == GROUP
            if not group.all():
                other = pa.array(~group)
                yield pa.RecordBatch.from_arrays([c.filter(other) for c in b.columns[1:]], names=_NAMES)
            if group.any():
                keys, owners, ns = (b.column(c).filter(pa.array(group)).to_numpy() for c in ("key", "a", "na"))
                if last is not None and last[0] == keys[0]:
                    keys, owners, ns = (np.append(x, y) for x, y in zip(last, (keys, owners, ns)))
                yield from _stars_with(keys, owners, ns)
                first = np.searchsorted(keys[::-1] != keys[-1], True)  # rows of the last group
                last = (keys[-1], owners[len(keys) - first], ns[len(keys) - first])

    rows = df.select(F.col(key).cast("long"), F.col(text_col), F.xxhash64(text_col)).mapInArrow(local, "route long, " + KINDS)
    return rows.repartition("route").sortWithinPartitions("route", "a").mapInArrow(joined, KINDS)


def _batch(route: pa.Array | None, kind: int, *columns: pa.Array) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(columns[0]), kind, np.int8)), *columns]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES) if route is None else pa.RecordBatch.from_arrays([route, *arrays], names=["route", *_NAMES])


def _stars_with(keys: np.ndarray, owners: np.ndarray, ns: np.ndarray, routed: bool = False) -> Iterator[pa.RecordBatch]:
    """Edges from the smallest set of each group to its others, of rows sorted by key and set; routed: also a row for
    each group, on its way by its key."""
    keep = np.ones(len(keys), bool)
    keep[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners, ns = keys[keep], owners[keep], ns[keep]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    center = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))[~first]
    number = lambda x: pa.array(x, pa.int64())
    if len(center):
        b = number(owners[~first])
        yield _batch(b if routed else None, EDGE, number(keys[~first]), number(owners[center]), b, number(ns[center]), number(ns[~first]))
    if routed:
        k = number(keys[first])
        none = pa.nulls(len(k), pa.int64())
        yield _batch(k, GROUP, k, number(owners[first]), none, number(ns[first]), none)


def _stars(keys: np.ndarray, owners: np.ndarray, sizes: dict[int, int], routed: bool) -> Iterator[pa.RecordBatch]:
    if not len(keys):
        return
    order = np.lexsort((owners, keys))
    owners = owners[order]
    change = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    runs = np.diff(np.append(change, len(owners)))
    yield from _stars_with(keys[order], owners, np.repeat([sizes[i] for i in owners[change].tolist()], runs), routed)


def _rows(batch: pa.RecordBatch, column: str = "row") -> list[np.ndarray]:
    """The entries of each row of the matrix in the batch."""
    lists = batch.column(column)
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the ids: a row of it that is not set names none of them."""
    h = F.xxhash64("id")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int"))
    words = ids.groupBy(F.pmod(h, F.lit(BITMAP_WORDS)).alias("w")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(BITMAP_WORDS, np.int64)
    for r in words.toLocalIterator():  # at most BITMAP_WORDS rows
        out[r["w"]] = r["bits"]
    return out


def set_rows(wanted: DataFrame, sets: DataFrame, df: DataFrame, key: str, text_col: str, bound: Bound) -> DataFrame:
    """set, row: the hashes of each wanted set, from the texts read again; only those that the bitmap lets through are parsed."""
    reps = cut_small(sets.where("set is not null and id is not null").groupBy("set").agg(F.min("id").alias("id")).join(wanted, "set"))
    bitmap = df.sparkSession.sparkContext.broadcast(_bitmap(reps))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for b in batches:
            h = b.column(2).to_numpy()
            hit = (bits[h & (BITMAP_WORDS - 1)] >> ((h.view(np.uint64) >> np.uint64(58)).astype(np.int64))) & 1
            taken = b.filter(pa.array(hit.astype(bool)))
            for rows in _texts(iter([taken]), 512, 1 << 24):
                found = [shingle_set(t, bound.width) for _, t, _ in rows]
                ids, sets = (pa.array(x, pa.int64()) for x in ([i for i, _, _ in rows], [set_id(s) for s in found]))
                yield pa.RecordBatch.from_arrays([ids, sets, pa.array(found, pa.list_(pa.int64()))], names=["id", "set", "row"])

    source = df.select(F.col(key).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(key).cast("long")).alias("h")).where("id is not null")
    found = source.mapInArrow(needed, "id long, set long, row array<long>")
    # Dealt once, by the set: neither the duplicates nor a join by the set move the rows again.
    return found.join(reps.select("set", F.col("id").alias("rep")), "set").where("id = rep").dropDuplicates(["set"]).select("set", "row")


def products(pairs: DataFrame, rows: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (a, b) that link: all rows b of an a are multiplied with it, in blocks.

    A set with many pairs is copied so that each task multiplies a bounded number of rows with it.
    """
    per_task = 256
    counts = cut_small(pairs.groupBy("a").agg((F.floor(F.count("*") / per_task) + 1).cast("int").alias("salts")))
    centers = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    members = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("set"))
    sides = members.select("a", "salt", "set", F.lit(1).alias("side")).unionByName(centers.select("a", "salt", F.col("a").alias("set"), F.lit(0).alias("side")))
    sides = sides.join(rows, "set").repartition("a", "salt").sortWithinPartitions("a", "salt", "side")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, own, block, size = None, None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if block:
                lengths = np.array([len(s) for _, s in block])
                entries = np.concatenate([s for _, s in block])
                at = np.searchsorted(own, entries)
                hits = own[np.minimum(at, len(own) - 1)] == entries
                overlap = np.add.reduceat(hits, np.cumsum([0, *lengths[:-1]]), dtype=np.int64)
                good = [b for (b, _), ok in zip(block, bound.holds(overlap, len(own), lengths)) if ok]
                if good:
                    yield pa.RecordBatch.from_arrays([pa.array([center] * len(good), pa.int64()), pa.array(good, pa.int64())], names=["a", "b"])
                block.clear()
                size = 0

        for batch in batches:
            for a, s, side, entries in zip(*(batch.column(i).to_pylist() for i in range(3)), _rows(batch)):
                if side == 0:
                    yield from flush()
                    center, own = a, entries.copy()
                else:
                    block.append((s, entries))
                    size += len(entries)
                    if size >= 1 << 16:
                        yield from flush()
            yield from flush()  # the entries are the batch's own

    return sides.select("a", "set", "side", "row").mapInArrow(multiply, "a long, b long")


def block_products(nodes: DataFrame, label: str, test: Callable[[np.ndarray, int, np.ndarray], np.ndarray], share: int) -> DataFrame:
    """a, b: labels that pairs of rows join which pass the test and belong to different classes; of the pairs in a
    block only as many as connect what they connect.

    nodes: cluster, set, n, root (the class), row and the label. In each cluster the rows outside its largest class are
    multiplied with all its rows. Only rows whose sizes allow a link meet: sizes fall into ranges, and a block of the
    left side meets rows of the same and the neighbouring ranges. A task holds one left block of LEFT entries, whose
    columns are in order, and reads the right one in slices.
    """
    sized = F.floor(F.log(F.col("n").cast("double")) / (1.001 * float(np.log(100 / share)))).cast("int")
    nodes = nodes.select("cluster", "set", "n", "root", F.col(label).alias("label"), "row", sized.alias("range"))
    most = nodes.groupBy("cluster", "root").agg(F.count("*").alias("m")).groupBy("cluster").agg(F.max_by("root", F.struct("m", "root")).alias("most"))
    nodes = nodes.join(most, "cluster").withColumn("left", F.col("root") != F.col("most")).drop("most")
    entries = F.size("row") + 64
    lefts = nodes.where("left").groupBy("cluster", "range").agg(F.ceil(F.sum(entries) / LEFT).cast("int").alias("us"))
    near = lefts.select("cluster", F.col("range").alias("of"), "us", F.explode(F.array(*[F.col("range") + k for k in (-1, 0, 1)])).alias("range"))
    rights = nodes.join(near.select("cluster", "range", "of"), ["cluster", "range"]).groupBy("cluster", "of").agg(F.ceil(F.sum(entries) / RIGHT).cast("int").alias("rs"))
    tasks = cut_small(near.join(rights, ["cluster", "of"]))
    of = lambda seed, count: F.pmod(F.xxhash64("set", F.lit(seed)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["label", "root", "n", "row"]
    left = nodes.where("left").join(tasks.where("of = range"), ["cluster", "range"])
    left = left.select("cluster", "of", of(0, "us").alias("u"), every("rs").alias("r"), F.lit(0).alias("side"), *columns)
    right = nodes.join(tasks, ["cluster", "range"]).select("cluster", "of", every("us").alias("u"), of(1, "rs").alias("r"), F.lit(1).alias("side"), *columns)
    both = left.unionByName(right).repartition("cluster", "of", "u", "r").sortWithinPartitions("cluster", "of", "u", "r", "side")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, index, trees = None, [], None, Forest()
        for batch in batches:
            found: list[tuple[int, int]] = []
            for c, of, u, r, side, name, root, n, entries in zip(*(batch.column(k).to_pylist() for k in range(8)), _rows(batch)):
                if (c, of, u, r) != task:
                    task, held, index, trees = (c, of, u, r), [], None, Forest()
                if side == 0:
                    held.append((name, root, n, entries.copy()))
                    continue
                if index is None and not held:
                    continue
                if index is None:  # the block's columns: its entries in order, and the row of each
                    names, roots, sizes = (np.array([x[k] for x in held], np.int64) for k in range(3))
                    columns = np.concatenate([x[3] for x in held])
                    owner = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
                    order = np.argsort(columns, kind="stable")
                    index, held, tops = (columns[order], owner[order]), [], names.copy()
                low = np.searchsorted(index[0], entries)
                times = np.searchsorted(index[0], entries, "right") - low
                at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
                overlap = np.bincount(index[1][at], minlength=len(names))
                passed = test(overlap, n, sizes) & (roots != root)
                for top in np.unique(tops[passed]).tolist() if passed.any() else ():
                    if x := trees.join(name, top):
                        found.append((name, top))
                        tops[tops == x[0]] = x[1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return both.select("cluster", "of", "u", "r", "side", *columns).mapInArrow(multiply, "a long, b long")


def _in_clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes that the edges reach, each with its component as the cluster."""
    return nodes.join(components(edges).select(F.col("node").alias("set"), F.col("root").alias("cluster")), "set")


def class_links(opened: DataFrame, members: DataFrame, rows: Callable[[DataFrame], DataFrame], bound: Bound) -> DataFrame:
    """Links between classes (their roots, a and b) that are left in large groups with several classes.

    opened: key, set, n, root of such groups, members: key and set of all groups, rows: the full rows of given
    sets. Groups that share sets form a cluster. First only prefix columns are multiplied: a pair that shares fewer
    than its sizes ask for is discarded. What is left falls into smaller clusters, which are multiplied in full.
    """
    edges = opened.groupBy("key").agg(F.min("set").alias("a")).join(opened.select("key", F.col("set").alias("b")), "key").select("a", "b")
    nodes = cut_small(_in_clusters(opened.select("set", "n", "root").distinct(), edges))
    keys = members.join(nodes.select("set"), "set", "left_semi").groupBy("set").agg(F.sort_array(F.collect_list("key")).alias("row"))
    near = cut_small(block_products(cut(nodes.join(keys, "set")), "set", bound.may_hold, bound.share))
    if near.isEmpty():
        return near
    nodes = cut_small(_in_clusters(nodes.drop("cluster"), near))
    full = cut(nodes.join(rows(nodes.select("set")), "set"))
    return block_products(full, "root", bound.holds, bound.share)


class Forest:
    """Sets of numbers that are joined, each known by its smallest one."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    def join(self, x: int, y: int) -> tuple[int, int] | None:
        """Of two trees that become one the former and the remaining top; None if they were one."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return None
        high, low = max(x, y), min(x, y)
        self.parent[high] = low
        return high, low


def _forest(edges: DataFrame) -> DataFrame:
    """u, v: stars with the smallest node of each component that the edges of one partition make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Forest()
        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                trees.join(u, v)
        pairs = [(x, r) for x in list(trees.parent) if (r := trees.find(x)) != x]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(links: DataFrame, rows_per_part: int = 200_000) -> DataFrame:
    """node, root: the smallest node that each node of the links reaches.

    Each partition of at most about rows_per_part links makes a forest of stars. Where that is all of them, it is the
    result; else large and small stars in turn bring the forests together until nothing changes: each turn moves nodes
    to smaller ones only, so it ends, and as a rule after a few turns, the logarithm of the nodes squared at most.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    edges = cut_small(_forest(cut_small(links, rows_per_part)), rows_per_part)
    alone = edges.count() < rows_per_part
    if alone:
        edges = cut(_forest(edges))
    settled = alone
    while not settled:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        new = cut_small(small.distinct(), rows_per_part)
        same = new.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        was = edges.distinct().agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        edges, settled = new, same == was
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def counted_pairs(sized: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (a, b), a < b, in small groups that share as many columns as their sizes ask for.

    sized: key, set, n and m (rows of the group). Shared columns with large groups are not counted here, so as many as a
    set has of these may be missing.
    """
    large = sized.where(F.col("m") > bound.small).groupBy("set").agg(F.count("*").alias("more"))
    small = sized.where(F.col("m") <= bound.small)
    x, y = (small.select("key", F.col("set").alias(side), F.col("n").alias(f"n{side}")) for side in "ab")
    pairs = x.join(y, "key").where((F.col("a") < F.col("b")) & bound.sizes_allow("na", "nb"))
    pairs = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
    for side in "ab":
        pairs = pairs.join(large.select(F.col("set").alias(side), F.col("more").alias(f"m{side}")), side, "left")
    missing = F.least(F.coalesce("ma", F.lit(0)), F.coalesce("mb", F.lit(0)))
    return pairs.where(F.col("shared") + missing >= bound.least_shared("na", "nb")).select("a", "b")


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose sets are in different classes."""
    for side in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
    return pairs.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def open_groups(large: DataFrame, roots: DataFrame) -> DataFrame:
    """key, set, n, root of the rows of groups that hold several classes."""
    members = large.select("key", "set", "n").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    keys = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return cut_small(members.join(keys, "key"))


def with_order(bound: Bound, df: DataFrame, text_col: str, share: float = 0.1, most_texts: int = 1_000_000, least: int = 2, most: int = 500_000) -> Bound:
    """The bound with an order of the shingles from a sample of the texts, a share of all and about most_texts at most:
    those in `least` or more of them (the `most` commonest) come late, by the logarithm of their number. Only the order
    depends on the sample, no result does."""
    share = min(share, most_texts / max(1, df.count()))
    sample = df.select(F.lit(None).cast("long"), text_col).where(unit_hash(text_col, seed=9) < F.lit(share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _texts(batches, 1024, 1 << 24):
            h, m = np.unique(np.concatenate([shingle_set(t, bound.width) for _, t, *_ in rows]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(m)], names=["h", "m"])

    counted = sample.mapInArrow(run, "h long, m long").groupBy("h").agg(F.sum("m").alias("m")).where(F.col("m") >= least).orderBy(F.desc("m"), "h").limit(most)
    counted = counted.select("h", F.least(F.floor(F.log2("m")), F.lit(100)).cast("byte").alias("late")).orderBy("h").toArrow()
    return replace(bound, frequent=counted["h"].to_numpy(), ranks=counted["late"].to_numpy().astype(np.uint8))


def jaccard_join(df: DataFrame, key: str = "doc_id", text_col: str = "text", bound: Bound = Bound()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest key reachable by links), n_copies (rows with the same set),
    class_id (the same for all rows that links join, null for an empty set) and text_hash (xxhash64 of the text).

    Rows with a null key are returned with their own size and no component. A null text has no words; sets without
    elements link to nothing. Rows with the same key are one document's parts: they share its component only if
    their texts link. An empty table gives no rows. Other columns of df, whatever their names, are not looked at.
    """
    spark = df.sparkSession
    small_batches(spark)
    bound = with_order(bound, df, text_col)
    found = cut(incidence(df, key, text_col, bound))
    release(spark)
    sets = found.where(F.col("kind") == DOCUMENT).select(F.col("b").alias("id"), F.col("na").alias("n"), F.col("a").alias("set"), F.col("key").alias("text_hash"))
    groups = found.where(F.col("kind") == EDGE).drop("kind")
    every = groups.select("key", F.col("a").alias("set"), F.col("na").alias("n")).unionByName(groups.select("key", F.col("b").alias("set"), F.col("nb").alias("n"))).distinct()
    every = every.join(every.groupBy("key").agg(F.count("*").alias("m")), "key")
    every = cut_small(every, 500_000)
    large = cut_small(every.where(F.col("m") > bound.small))
    rows = lambda wanted: set_rows(wanted, sets, df, key, text_col, bound)
    sides = lambda pairs: pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    counted = cut_small(counted_pairs(every, bound))
    release(spark)
    # First each set with one other: that of its small groups with the smallest id, and the center of each large group.
    stars = large.join(large.groupBy("key").agg(F.min(F.struct("set", "n")).alias("c")), "key")
    stars = stars.select(F.col("c.set").alias("a"), F.col("set").alias("b"), F.col("c.n").alias("na"), F.col("n").alias("nb")).where(F.col("a") < F.col("b"))
    first = counted.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    pairs = cut_small(first.unionByName(stars.where(bound.sizes_allow("na", "nb")).select("a", "b")).distinct())
    links = cut_small(products(pairs, rows(sides(pairs)), bound))
    roots = cut_small(components(links))
    release(spark)
    more = cut_small(across(counted.join(pairs, ["a", "b"], "left_anti"), roots))
    if not more.isEmpty():
        links = cut_small(links.unionByName(products(more, rows(sides(more)), bound)))
        roots = cut_small(components(links))
    members = open_groups(large, roots)
    release(spark)
    if not members.isEmpty():
        links = cut_small(links.unionByName(class_links(members, every.select("key", "set"), rows, bound)))
        roots = cut_small(components(links))
    release(spark)
    lowest = sets.where("set is not null and id is not null").groupBy("set").agg(F.min("id").alias("low"), F.count("*").alias("n_copies"))
    lowest = cut_small(lowest.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set")))
    whole = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = lowest.join(whole, "root").select("set", "component_id", "n_copies", F.col("root").alias("class_id"))
    out = sets.join(classes, "set", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("class_id", "set").alias("class_id"),
        "text_hash",
    )
