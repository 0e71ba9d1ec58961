"""The pipeline's stages against plain versions of their decisions."""

import base64
import hashlib
import re

import corpus_pipeline as cp

from leafwork.llm import common
from tests.llm.test_operators import KINDS, awkward, plain_join

SF = "/root/testdata/sf0.001"


def test_run_and_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    first = cp.keep_good(spark, docs, SF).cache()
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in first.collect()}
    assert first.columns == columns and sum((d in kept) == (q == 1) for d, q in labels.items()) >= 0.8 * len(labels)  # a small fit
    second = cp.keep_one_of_each(spark, first, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    assert {r["doc_id"] for r in second.collect()} == {c for k, _, c in plain_join(rows, 5, 80)} and second.columns == columns
    third = cp.mask_secrets(spark, second, SF).cache()
    assert third.columns == columns and third.count() == second.count()
    assert not any(re.search("[0-9a-f]{16,}", r["text"]) for r in third.collect()) and all(r["n_chars"] == len(r["text"]) for r in third.collect() if cp.MASK in r["text"])
    fourth = cp.mix_sources(spark, third, SF).cache()
    assert fourth.columns == columns and sorted(r["doc_id"] for r in fourth.collect()) == sorted(r["doc_id"] for r in third.collect())
    got = cp.run(spark, SF)
    assert got.count() == third.count() and {r["doc_id"] for r in got.select("doc_id").collect()} == {r["doc_id"] for r in third.collect()}


def test_stages_on_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), KINDS)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert cp.mix_sources(spark, docs.dropDuplicates(["doc_id"]), SF).count() == docs.dropDuplicates(["doc_id"]).count()


NAMES = "doc_id long, text string, lang string, source string, n_chars long, spans string, n_spans string, score string, masked string, predicted string, row string, text_hash string, class_id string, slot string, stream string"


def rows_with_clashes():
    """Rows of one id with equal and different texts, blank texts, nulls, a hostile token, and columns named as the stages' own."""
    some = lambda x: " ".join(f"{x}{i}" for i in range(40))
    deep = base64.urlsafe_b64encode(b'{"alg":' + b"[" * 100_000).decode().rstrip("=")
    texts = [(7, some("a"), "y"), (7, some("b"), "x"), (3, some("b") + " end", "x"), (7, some("a"), "x"), (8, "", "x"), (8, " ", "x"), (None, some("a"), "x"), (9, None, None), (10, "key eyJ" + deep + ".eyJh.x", "z"), (11, "password = hunter2hunter2", "z")]
    return [(k, t, "en", s, 1, *[f"mine{i}{c}" for c in range(10)]) for i, (k, t, s) in enumerate(texts)]


def test_stages_keep_clashing_columns_and_rows_of_one_id(spark):
    rows = rows_with_clashes()
    docs = spark.createDataFrame(rows, NAMES).repartition(3)
    order = lambda x: sorted(map(tuple, x), key=repr)
    kept = cp.keep_one_of_each(spark, docs, SF)
    assert kept.columns == docs.columns
    assert order(kept.collect()) == order([r for i, r in enumerate(rows) if i not in (0, 1)])  # of two equal texts of id 7 the first by source; b is a copy of 3
    masked = cp.mask_secrets(spark, docs, SF)
    want = [(*r[:1], cp.MASK, *r[2:4], len(cp.MASK), *r[5:]) if r[0] == 11 else r for r in rows]
    assert masked.columns == docs.columns and order(masked.collect()) == order(want)
    mixed = cp.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and order(mixed.collect()) == order(rows)
    good = cp.keep_good(spark, docs, SF)
    assert good.columns == docs.columns and set(map(tuple, good.collect())) <= set(rows)


def test_run_is_the_stages_one_after_another(spark):
    """The rows of run, by a plain version: the network's verdict, plain sets, masks by spans, and the library's ids."""
    import sentencepiece

    from leafwork.llm import quality, secrets
    from leafwork.llm.queries import tokenizer_path

    docs = common.table(spark, SF, "documents")
    labels = common.one_label(common.table(spark, SF, "labels").where(common.fold("doc_id", 4) != 2), "quality")
    network = quality.fit_quality(docs.where(common.fold("doc_id", 4) != 2).select("doc_id", "text").join(labels, "doc_id"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if network.score(r["text"]) >= 0.7]
    stay = {c for _, _, c in plain_join([r[:2] for r in rows], 5, 80)}
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    want = {}
    for k, t, s in rows:
        if k in stay:
            spans = secrets.base_spans(t) + secrets.confirmed_spans(t)
            want[k] = (s, lib.encode(secrets.masked(t, spans, cp.MASK), add_eos=True))
    got = cp.run(spark, SF).collect()
    assert {r["doc_id"]: (r["source"], list(r["ids"])) for r in got} == want and len(got) == len(want)
    assert all(r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in got)
