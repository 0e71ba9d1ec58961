"""Quality rules with cross-document line frequency, by DataFrame functions only.

Base rules look at one document. The method counts, for each host, the distinct documents in which a normalised
line appears; lines in more documents than the limit are taken away, and a document that keeps too little of its
words is rejected as depleted. A line is normalised by lower case and single spaces, and known by its hash.

No key gathers many rows: counts are summed where the lines are before anything is shuffled; the few lines so
frequent that there can be only a fixed number of them are broadcast, all others are joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import cut

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOL = "[#*$%&|<>]"
#: At most this many (host, line) pairs can each hold more than the same share of all lines.
HEAVY = 4096
#: So many hosts are broadcast; with more, Spark joins by host.
MOST_HOSTS = 100_000


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def with_base_rules(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    A null text has no words. A window of three words is repeated if it is found twice or more in the text; the
    words of all such windows count, once each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("_w", _words(text)).withColumn("n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("_lines", lines)
    n = F.size("_w")
    window = lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(3)])
    df = df.withColumn("_h", F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_some", F.size(F.array_distinct("_h")) < F.size("_h"))
    # Only where a hash is repeated are the windows sorted, by hash, words and place, so that equal ones are neighbours.
    entry = lambda h, i: F.struct(h.alias("h"), *[F.get("_w", i + k).alias(f"w{k}") for k in range(3)], i.alias("i"))
    df = df.withColumn("_sorted", F.when(F.col("_some"), F.sort_array(F.transform("_h", entry))))
    equal = lambda v, other: (v["h"] == other["h"]) & (v["w0"] == other["w0"]) & (v["w1"] == other["w1"]) & (v["w2"] == other["w2"])
    near = lambda v, j: F.coalesce(equal(v, F.get("_sorted", j)), F.lit(False))
    twice = F.filter("_sorted", lambda v, j: near(v, j - 1) | near(v, j + 1))
    df = df.withColumn("_at", F.sort_array(F.transform(twice, lambda v: v["i"])))
    added = lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["upto"])).alias("n"), (i + 3).alias("upto"))
    covered = F.aggregate("_at", F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto")), added, lambda a: a["n"])
    df = df.withColumns(
        {
            "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOL, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_some"), covered).otherwise(0).cast("long"),
        }
    )
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    return df.drop("_w", "_lines", "_h", "_some", "_sorted", "_at")


def filter_by_lines(
    df: DataFrame, key: str = "doc_id", host: str = "source", text_col: str = "text", least_documents: int = 20, host_share: float = 0.002, least_kept: float = 0.5
) -> DataFrame:
    """The key, the base rules, removed_words, n_removed_lines and kept, for each row.

    A line is above the limit if it is in more distinct documents of its host than least_documents and than
    host_share of the host's documents. kept is false where the base rules fail or fewer than least_kept of the
    words remain. Rows with the same key, host and text count as one document for frequencies; each of them is returned
    with the same values. A null host is a host of its own, a null key a key of its own.
    """
    base = with_base_rules(df.select(F.col(key).alias("_key"), F.col(host).alias("_host"), F.col(text_col).alias("_text")), "_text")
    base = base.withColumn("_id", F.xxhash64("_key", "_host", "_text"))
    base_cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

    plain = df.select(F.col(key).alias("_key"), F.col(host).alias("_host"), F.col(text_col).alias("_text")).withColumn("_id", F.xxhash64("_key", "_host", "_text"))
    hosts = cut(plain.groupBy("_host").agg(F.count("*").alias("_docs")))
    line = F.regexp_replace(F.lower(F.btrim("_l", F.lit(BLANKS))), SPACE, " ")
    # The null line of each row, which is no line, counts how many rows have the same id.
    lines = F.concat(F.array(F.lit(None).cast("string")), F.split(F.coalesce("_text", F.lit("")), "\n"))
    rows = plain.select("_id", "_host", F.explode(lines).alias("_l")).withColumn("_n", line).where("_n is null or _n <> ''")
    known = F.when(F.col("_n").isNotNull(), F.xxhash64("_host", "_n")).alias("_line")
    rows = rows.select("_id", F.xxhash64("_host").alias("_h"), known, F.coalesce(F.size(F.split("_n", " ")), F.lit(0)).alias("_words"))
    # A line's places in one document are one row; what is left is one row for each document and line.
    rows = cut(rows.groupBy("_id", "_h", "_line").agg(F.sum("_words").alias("_words"), F.count("*").alias("_times")))
    limit = hosts.select(F.xxhash64("_host").alias("_h"), F.greatest(F.lit(float(least_documents)), F.col("_docs") * host_share).alias("_limit"))
    if hosts.count() <= MOST_HOSTS:
        limit = F.broadcast(limit)
    copies = rows.where("_line is null").select("_id", F.lit(0).cast("long").alias("_words"), F.lit(0).cast("long").alias("_times"), F.col("_times").alias("_copies"))
    rows = rows.where("_line is not null")
    frequent = rows.groupBy("_h", "_line").agg(F.count("*").alias("_docs")).where(F.col("_docs") > least_documents)
    frequent = frequent.join(limit, "_h").where("_docs > _limit").select("_line", "_docs")
    total = rows.count()
    heavy = F.col("_docs") > total / HEAVY
    frequent = cut(frequent)
    top = F.broadcast(frequent.where(heavy).select("_line", F.lit(True).alias("_top")))
    flagged = rows.join(top, "_line", "left")
    rare = flagged.where("_top is null").join(frequent.where(~heavy).select("_line"), "_line")
    found = [x.select("_id", "_words", "_times", F.lit(None).cast("long").alias("_copies")) for x in (flagged.where("_top"), rare)]
    removed = found[0].unionByName(found[1]).unionByName(copies).groupBy("_id")
    removed = removed.agg(*[F.floor(F.sum(c) / F.max("_copies")).alias(a) for c, a in (("_words", "removed_words"), ("_times", "n_removed_lines"))])
    out = base.drop("_text").join(removed, "_id", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("removed_words", "n_removed_lines")})
    depleted = F.col("n_words") - F.col("removed_words") < F.col("n_words") * least_kept
    return out.select(F.col("_key").alias(key), *base_cols, "removed_words", "n_removed_lines", (~F.col("base_failed") & ~depleted).alias("kept"))
