"""Entities without semicolon: text in the queries, as in their SQL; resolved by the programs, as by html.unescape."""

import html

import duckdb
import pytest
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import same

H1 = ["Of&&amp", "Cut &quot", "Cut &am", "Two &amp;&amp;lt;", "&lt;b&gt", "&ampfoo; &notit;", "&copy; &ampx", "One &amp; two", "Plain", "&amp", "&"]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, f"<h1>{h}</h1><p>{h}</p>") for i, h in enumerate(H1)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.mark.parametrize("name", ["markdown_unescape", "md_heading_dict", "backfill_join", "backfill_pages", "backfill_counts"])
def test_cut_entities_match_sql(spark, pages, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{pages}/pages.parquet/*.parquet')")
    same(QUERIES[name](spark, pages), con, ORACLE_SQL[name])


def test_entities_with_and_without_semicolon(spark):
    df = spark.createDataFrame([(h,) for h in [*H1, "&#945;&#x3b1 &alpha;", None]], "x string")
    got = df.select("x", T.unescape_markdown(F.col("x")).alias("any"), T.unescape_markdown(F.col("x"), closed=True).alias("closed")).collect()
    assert [r["any"] for r in got] == [r["x"] and html.unescape(r["x"]) for r in got]
    assert [r["closed"] for r in got] == ["Of&&amp", "Cut &quot", "Cut &am", "Two &&lt;", "<b&gt", "&ampfoo; &notit;", "© &ampx", "One & two", "Plain", "&amp", "&", "α&#x3b1 α", None]
