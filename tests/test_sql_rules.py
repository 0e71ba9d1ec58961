"""Headings and lines where Python's and SQL's rules part: the queries on them follow their SQL, the programs Python."""

import duckdb
import pytest
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators import headings
from leafwork.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import same

# h1 and first paragraph.
ODD = [
    ("Dot &middot; one", "Dot · one"), ("It&#39;s", "It's"), ("It&#x27;s", "It&#x27;s"), ("Some &nbsp; room", "Some room"), ("&AMP;", "&"), ("&copy; &amp;copy;", "© &copy;"), ("&amp;lt;", "<"),
    ("Two\nlines", "Two lines"), ("\nBehind", "Behind"), ("Before\n", "Before"), ("Car\rriage", "Car riage"), ("Tab\tbed", "Tab bed"), ("Next\x85line", "Next line"),
    ("Ver\x0btical", "Ver tical"), ("No\xa0break", "No break"), ("\xa0Ends　", "Ends"), ("\x1cUnit", "Unit"), ("Para graph", "Para graph"), ("\xa0", ""), ("", ""), (" ", "\x0b"),
    ("A\\_b \\* c", "A_b * c"), ("# Marks", "# Marks"), ("Plain", "Plain"),
]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, f"<h1>{h}</h1><p>{p}</p>") for i, (h, p) in enumerate(ODD)]
    rows += [(len(ODD), None), (None, "<h1>No id</h1><p>No id</p>"), (len(ODD) + 1, "<p>No heading</p>")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.mark.parametrize("name", ["md_heading_dict", "backfill_join", "backfill_pages", "backfill_counts"])
def test_odd_headings_match_sql(spark, pages, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{pages}/pages.parquet/*.parquet')")
    same(QUERIES[name](spark, pages), con, ORACLE_SQL[name])


def test_programs_keep_python_rules(spark):
    md = spark.createDataFrame([("d", 0, "## Dot &middot; one &amp\xa0two")], "doc string, line_no int, line string")
    lines = spark.createDataFrame([("d", 0, 0, "Dot ·\x0bone & two")], "doc string, page_index int, line_no int, line string")
    found = headings.promoted_lines(lines, headings.markdown_headings(md)).select(F.col("out")).collect()
    assert [r["out"] for r in found] == ["## Dot ·\x0bone & two"]
    assert headings.markdown_headings(md, T.SQL).collect()[0]["key"] == "Dot &middot; one &amp\xa0two"
