"""The registered queries: names, contract columns, and whole tables."""

import __spark_entry__ as entry
import pytest

from leafwork.llm.queries import QUERIES
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    2: {"doc_id", "held_out", "score", "predicted"},
    3: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    4: {"doc_id", "source", "slot", "place", "release", "deadline"},
    5: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    6: {"doc_id", "held_out", "lang_pred", "score"},
    7: {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    8: {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    9: {"doc_id", "n_shingles", "component_id"},
    10: {"doc_id", "held_out", "score", "predicted"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_table(spark, name):
    df = entry.queries()[name](spark, SF)
    assert COLUMNS[int(name[2:].split("_")[0])] <= set(df.columns)
    rows = df.collect()
    assert len(rows) == 200
    sql = entry.oracle_sql().get(name)
    if sql:
        same(df, connect(SF), sql)


def test_registered():
    assert "pipeline" in entry.queries() and sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
