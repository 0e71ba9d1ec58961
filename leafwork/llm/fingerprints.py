"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

Every five-word shingle is hashed once. The top eight bits of the hash name its bin, and each bin keeps its
smallest hash. An empty bin takes over the value of another one by optimal densification: it probes bins in an
order of its own until it meets one that was filled by a shingle, so that two documents that share their filled
bins also share the filled-in ones. A fingerprint is the lowest four bits of the 256 bins, one hexadecimal digit
each; the likeness of two of them is the share of equal digits, corrected for the 1/16 that agree by chance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, BITS, SHINGLE = 256, 4, 5
PER_LONG = 64 // BITS
PRIME = 257
#: Constants of the probing orders, one pair for each of the first probes: fixed values.
PROBES = ((73, 19), (151, 101), (229, 197), (45, 60), (187, 149), (101, 7))
SPACE = "[\\x20\\x09-\\x0D]+"
EMPTY = "-"


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but space and the controls 09 to 0D; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def shingles_of(words: str) -> Column:
    """The five-word shingles as structs, repeats included; fewer words are one shingle, none give an empty array."""
    n = F.size(words)
    names = [f"w{k}" for k in range(SHINGLE)]
    zipped = F.arrays_zip(*[F.slice(words, F.lit(k + 1), F.greatest(n - (SHINGLE - 1), F.lit(0))).alias(names[k]) for k in range(SHINGLE)])
    kind = "array<struct<" + ",".join(f"{x}:string" for x in names) + ">>"
    short = F.array(F.struct(F.array_join(words, " ").alias("w0"), *[F.lit(None).cast("string").alias(x) for x in names[1:]]))
    return F.when(n >= SHINGLE, zipped.cast(kind)).when(n > 0, short.cast(kind)).otherwise(F.array().cast(kind))


def densified(rows: DataFrame, filled: str, low: str, out: str) -> DataFrame:
    """Adds `out`: array<bigint> of the packed digits, with every empty bin filled in; empty where no bin is filled.

    `filled` has a bit and `low` BITS bits for each bin, packed into longs. Only empty bins are looked at.
    """
    own = f"_{out}_own"
    bit = lambda i: F.getbit(F.get(filled, F.shiftright(i, 4)), i.bitwiseAND(F.lit(15))) == 1
    full = F.forall(filled, lambda v: v == (1 << PER_LONG) - 1)
    # Behind the probes: of all filled bins the one that is first in the empty bin's own order.
    last = lambda i: F.array_min(F.transform(own, lambda p: F.pmod((p + 1) * (F.pmod(i * 37, F.lit(PRIME - 1)) + 1), F.lit(PRIME)) * BINS + p)) % BINS

    def source(i: Column) -> Column:
        at = last(i)
        for a, c in reversed(PROBES):
            probe = (i * a + c).bitwiseAND(F.lit(BINS - 1))
            at = F.when(bit(probe), probe).otherwise(at)
        return at

    def moved(acc: Column, i: Column, at: Column) -> Column:
        digit = F.call_function("shiftrightunsigned", F.get(low, F.shiftright(at, 4)), F.shiftleft(at.bitwiseAND(F.lit(15)), 2)).bitwiseAND(F.lit((1 << BITS) - 1))
        return acc.bitwiseOR(F.call_function("shiftleft", digit, F.shiftleft(i.bitwiseAND(F.lit(15)), 2)))

    def put(k: Column) -> Column:
        inside = F.sequence(k * PER_LONG, k * PER_LONG + (PER_LONG - 1))
        taken = F.transform(F.filter(inside, lambda i: ~bit(i)), lambda i: F.struct(i.alias("i"), source(i).alias("at")))
        return F.aggregate(taken, F.get(low, k), lambda acc, x: moved(acc, x["i"], x["at"]))

    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    rows = rows.withColumn(own, F.when(full, F.array().cast("array<int>")).otherwise(F.filter(every, bit)))
    packed = F.when(full, F.col(low)).when(F.size(own) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), put))
    return rows.withColumn(out, packed).drop(own)


def binned(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """For each row (told apart by `keys`) the fingerprints of the texts, packed, in columns fp0, fp1, ...

    Shingles are exploded, hashed and reduced to the smallest hash of each bin; rows stay in the partition that the
    keys put them in, so nothing is shuffled where the rows are already dealt by one of the keys.
    """
    for j, t in enumerate(texts):
        rows = rows.withColumn(f"_w{j}", words_of(F.col(t)))
    rows = rows.select(*keys, *[f"_w{j}" for j in range(len(texts))])
    parts = F.array(*[shingles_of(f"_w{j}") for j in range(len(texts))])
    counts = F.array(*[F.greatest(F.size(f"_w{j}") - (SHINGLE - 1), F.least(F.size(f"_w{j}"), F.lit(1))) for j in range(len(texts))])
    rows = rows.select(*keys, F.get(counts, 0).alias("_first"), F.posexplode_outer(F.flatten(parts)).alias("_pos", "_s"))
    if len(texts) > 2:
        raise ValueError("two texts a row at most")
    h = F.xxhash64(*[F.col(f"_s.w{k}") for k in range(SHINGLE)])
    rows = rows.select(*keys, F.when(F.col("_pos") >= F.col("_first"), 1).otherwise(0).alias("_j"), F.when(F.col("_pos").isNotNull(), h).alias("_h"))
    bins = rows.groupBy(*keys, "_j", F.shiftrightunsigned("_h", 56).cast("int").alias("_bin")).agg(F.min("_h").alias("_h"))
    # Sixteen bins make a long of digits; then sixteen longs make a fingerprint.
    at = F.col("_bin").bitwiseAND(F.lit(PER_LONG - 1))
    long_of = lambda value, shift: F.call_function("shiftleft", value, shift)
    parts = bins.groupBy(*keys, "_j", F.shiftright("_bin", 4).alias("_k")).agg(
        F.bit_or(long_of(F.lit(1), at)).alias("_filled"), F.bit_or(long_of(F.col("_h").bitwiseAND(F.lit((1 << BITS) - 1)), F.shiftleft(at, 2))).alias("_low")
    )
    slots = [(j, k) for j in range(len(texts)) for k in range(BINS // PER_LONG)]
    only = lambda j, k, c: F.coalesce(F.bit_or(F.when((F.col("_j") == j) & (F.col("_k") == k), F.col(c))), F.lit(0))
    out = parts.groupBy(*keys).agg(*[only(j, k, c).alias(f"{c}{j}_{k}") for j, k in slots for c in ("_filled", "_low")])
    for j in range(len(texts)):
        for c in ("_filled", "_low"):
            out = out.withColumn(f"{c}{j}", F.array(*[f"{c}{j}_{k}" for k in range(BINS // PER_LONG)]))
    for j in range(len(texts)):
        out = densified(out, f"_filled{j}", f"_low{j}", f"fp{j}")
    return out.select(*keys, *[f"fp{j}" for j in range(len(texts))])


def as_text(packed: str) -> Column:
    """The fingerprint as 256 hexadecimal digits; `-` for a document without words."""
    digits = F.concat(*[F.lpad(F.hex(F.get(packed, k)), 16, "0") for k in range(BINS // PER_LONG)])
    return F.when(F.size(packed) == 0, F.lit(EMPTY)).otherwise(F.lower(digits))


def likeness(p: str, q: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two packed fingerprints, 0 to 1.

    1 for two documents without words, 0 if only one of them has none.
    """
    ones = 0x1111111111111111
    equal = F.lit(0)
    for k in range(BINS // PER_LONG):
        x = F.get(p, F.lit(k)).bitwiseXOR(F.get(q, F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ones))
        equal = equal + (F.lit(PER_LONG) - F.bit_count(x))
    chance = 1.0 / (1 << BITS)
    share = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1.0 - chance))
    return F.when((F.size(p) == 0) & (F.size(q) == 0), 1.0).when((F.size(p) == 0) | (F.size(q) == 0), 0.0).otherwise(share)


def _borders(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Ascending values of the (integer) key that cut its rows into ranges of about the same size; each is in the data."""
    share = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, share, max(100_000, 10 * buckets)).alias("q"), F.max(key).alias("m")).first() if share else None
    if not found or not found["q"]:
        return []
    return sorted({int(x) for x in found["q"] if x is not None and x < found["m"]})


def _with_range(df: DataFrame, key: str, borders: list[int]) -> DataFrame:
    """Adds _range, the number of borders below the key, found in two steps so that few are compared; null keys get -1."""
    step = max(1, int(len(borders) ** 0.5))
    groups = [borders[i : i + step] for i in range(0, len(borders), step)] or [[]]
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups[1:]]).cast("array<bigint>")
    below = lambda values: F.size(F.filter(values, lambda b: b < F.col(key)))
    table = df.sparkSession.createDataFrame(list(enumerate(groups)), "_group int, _borders array<bigint>")
    found = df.withColumn("_group", F.when(F.col(key).isNull(), 0).otherwise(below(heads))).join(F.broadcast(table), "_group")  # 8 bytes a range
    return found.withColumn("_range", F.when(F.col(key).isNull(), -1).otherwise(F.col("_group") * step + below(F.col("_borders"))).cast("int")).drop("_group", "_borders")


def ranges_for(rows: int, rows_per_range: int = 2000, even: int = 4096) -> int:
    """How many ranges: one for each rows_per_range rows up to `even` ranges, then as the root of the rows.

    The driver and each executor hold two numbers a range: 320,000 ranges of 156,000 rows for 5e10 rows.
    """
    n = max(1, rows // rows_per_range)
    return n if n <= even else int((even * n) ** 0.5)


def dealt_with_next(df: DataFrame, key: str, column: str, rows_per_range: int = 2000, even: int = 4096) -> DataFrame:
    """The rows dealt by descending ranges of the key (_range), numbered there (_row), with next_<column>: the value in
    the row that follows by descending key, after the last row that of the first.

    No task sorts all rows. The first row of each range also travels, as an extra (_extra = 1), behind the last one of
    the range before it; it has no next. Rows with equal keys follow each other by the column; rows without key come last.
    """
    n = df.count()
    names = df.columns
    df = _with_range(df, key, _borders(df, key, ranges_for(n, rows_per_range, even)))
    # One row for each range: the bound of ranges_for makes collecting and broadcasting safe.
    tops = sorted(df.groupBy("_range").agg(F.max(key).alias("k")).collect())
    before = [(r["_range"], r["k"], tops[(i + 1) % len(tops)]["_range"]) for i, r in enumerate(tops)]
    heads = df.sparkSession.createDataFrame(before, f"_r int, _k {dict(df.dtypes)[key]}, _before int")
    extra = df.join(F.broadcast(heads), (F.col("_range") == F.col("_r")) & F.col(key).eqNullSafe(F.col("_k")))
    extra = extra.withColumn("_first", F.row_number().over(Window.partitionBy("_r").orderBy(column))).where("_first = 1")
    extra = extra.withColumn("_range", F.col("_before")).select(*names, "_range", F.lit(1).alias("_extra"))
    w = Window.partitionBy("_range").orderBy("_extra", F.col(key).desc_nulls_last(), column)
    return df.select(*names, "_range", F.lit(0).alias("_extra")).unionByName(extra).withColumns({"_row": F.row_number().over(w), f"next_{column}": F.lead(column).over(w)})


def edited(text: str, following: str) -> Column:
    """The text with its last third (rounded down) replaced by as many first code points of the following text."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substr(F.col(text), F.lit(1), n - third), F.substr(F.col(following), F.lit(1), third))


def compare_with_next(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness, as columns of the key.

    Edited: the last third replaced by the beginning of the text that follows by descending key. Returns the key,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text counts as empty;
    repeated rows are rows of their own; an empty table gives no rows.
    """
    rows = dealt_with_next(df.select(F.col(key).alias("_key"), F.coalesce(text_col, F.lit("")).alias("_text")), "_key", "_text")
    rows = rows.withColumn("_edited", edited("_text", "next__text"))
    prints = binned(rows, ["_range", "_row"], ["_text", "_edited"])
    w = Window.partitionBy("_range").orderBy("_row")
    prints = prints.withColumn("_next", F.lead("fp0").over(w)).where("_next is not null")
    prints = prints.select(
        "_range", "_row", as_text("fp0").alias("fingerprint"), as_text("fp1").alias("edited_fingerprint"),
        likeness("fp0", "fp1").alias("near_edited"), likeness("fp0", "_next").alias("near_next"),
    )
    about = rows.where("_extra = 0").select("_range", "_row", F.col("_key").alias(key), F.char_length("_text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"))
    return about.join(prints, ["_range", "_row"]).drop("_range", "_row")


def fingerprint(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Key and fingerprint of each row. Equal texts have equal fingerprints; a null text counts as empty."""
    rows = df.select(F.col(key), F.coalesce(text_col, F.lit("")).alias("_text")).withColumn("_id", F.monotonically_increasing_id())
    return binned(rows, [key, "_id"], ["_text"]).select(key, as_text("fp0").alias("fingerprint"))
