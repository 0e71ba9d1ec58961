"""Hand-built cases (FIXTURES.md, section 3) and Python as the measure for text semantics."""

import functools
import json
import random
import re
import threading
import uuid
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators import adapters, chunks, geometry, headings, pages
from leafwork.plans import convert
from leafwork.sources import corpus, sinks
from leafwork.streaming.ingest import ingest_headings

ITEM = "doc string, item_no int, label string, level int, text string, page_no int"
CELL = "doc string, page_no int, rect_no int, idx int, text string, confidence double, l double, t double"


def texts_of(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc string, text string")


def found(spark, text):
    return [(r["page"], r["text"]) for r in headings.headings_of_texts(texts_of(spark, text)).orderBy("line_no").collect()]


def items(spark, *rows):
    return spark.createDataFrame([("d", i, *r) for i, r in enumerate(rows)], ITEM)


def test_headings(spark):
    assert found(spark, "## Intro\n=== Page 2 ===\n### 12\n# abc\n# abcd") == [(0, "Intro"), (2, "abcd")]
    assert found(spark, "####### Seven\n##NoSpace\n  ## Padded  ") == [(0, "Padded")]
    assert found(spark, "## 1.2 - (3)\n## Fig. 3") == [(0, "Fig. 3")]
    assert found(spark, "=== Page 99999999999999 ===\n## Long number") == [(0, "Long number")]


def test_heading_records_keep_documents_without(spark):
    docs = texts_of(spark, "nothing", "# Some heading")
    rows = headings.heading_records(headings.headings_of_texts(docs), docs).orderBy("document").collect()
    assert [(r["document"], r["n_headings"]) for r in rows] == [("d0", 0), ("d1", 1)]


def test_markdown_keys(spark):
    md = lambda *x: headings.markdown_headings(T.exploded_lines(texts_of(spark, *x), "text", "doc"))
    assert md("  ## Padded").count() == 0
    assert [(r["key"], r["level"]) for r in md("## A &amp; B\\_1").collect()] == [("A & B_1", 2)]
    assert [(r["key"], r["level"]) for r in md("## X\n#### X").collect()] == [("X", 4)]
    assert [r["key"] for r in md("## &copy; &amp;lt; &#945; \\[x\\]").collect()] == ["© &lt; α [x]"]
    lines = spark.createDataFrame([("d0", 0, 0, "A  &\tB_1"), ("d0", 0, 1, "## A & B_1"), ("d0", 1, None, None)], "doc string, page_index int, line_no int, line string")
    out = headings.promoted_lines(lines, md("## A &amp; B\\_1"))
    assert [r["out"] for r in out.where("line_no is not null").orderBy("line_no").collect()] == ["## A  &\tB_1", "## A & B_1"]
    rebuilt = headings.rebuilt_pages(out).orderBy("page_index").collect()
    assert [(r["page_index"], r["full_text"], r["n_matched"]) for r in rebuilt] == [(0, "## A  &\tB_1\n## A & B_1", 1), (1, "", 0)]


def test_spine_and_gaps(spark):
    result = pages.page_results(items(spark, ("text", None, "one", 1), ("text", None, "three", 3))).orderBy("page_index").collect()
    assert [(r["page_index"], r["full_text"], len(r["text_lines"])) for r in result] == [(0, "one", 1), (1, "", 0), (2, "three", 1)]
    registered = spark.createDataFrame([("d", p) for p in range(1, 5)], "doc string, page_no int")
    none = spark.createDataFrame([], CELL)
    result = pages.page_results(items(spark, ("text", None, "one", 1)), none, registered).collect()
    assert sorted((r["page_index"], r["recovered"]) for r in result) == [(i, False) for i in range(4)]
    empty = pages.page_results(spark.createDataFrame([], ITEM), none, spark.createDataFrame([], "doc string, page_no int"))
    assert empty.count() == 0
    assert [tuple(r) for r in pages.document_text(empty, spark.createDataFrame([("d",)], "doc string")).collect()] == [("d", "")]


@pytest.mark.parametrize("raw, recovered", [("abcd", False), ("abcde", True)])
def test_fallback_is_strict(spark, raw, recovered):
    cells = spark.createDataFrame([("d", 1, 0, 0, raw, 0.5, 0.0, 0.0)], CELL)
    row = pages.page_results(items(spark, ("title", None, "ab", 1)), cells).first()
    assert row["recovered"] is recovered and row["full_text"] == (raw if recovered else "# ab")
    assert row["text_lines"][0]["confidence"] == (0.5 if recovered else 1.0)


def test_bands_round_to_even(spark):
    cells = spark.createDataFrame([("d", 1, 0, i, "x", 0.5, 0.0, t) for i, t in enumerate((7.5, 22.5, 37.5))], CELL)
    assert [r["band"] for r in pages.reading_order(cells).orderBy("idx").collect()] == [0, 2, 2]


def test_heading_marks(spark):
    rows = items(spark, ("title", None, "a", 1), ("section_header", 1, "b", 1), ("section_header", 5, "c", 1), ("section_header", 9, "d", 1), ("text", None, " ", 1), ("text", None, "", 1), ("text", None, "e", None))
    lines = pages.item_lines(rows).orderBy("item_no").collect()
    assert [r["line"] for r in lines] == ["# a", "## b", "###### c", "###### d", " ", "e"]
    assert lines[-1]["page_index"] == 0


def test_chunks(spark):
    docs = spark.createDataFrame([("a", 7), ("b", 3), ("c", 0)], "doc string, n_pages int")
    got = [tuple(r) for r in chunks.plan_chunks(docs, 3, "doc").select("doc", "chunk_start", "chunk_end", "chunk_name").orderBy("chunk_start").collect()]
    assert got == [("a", 0, 3, "chunk_00000"), ("a", 3, 6, "chunk_00003"), ("a", 6, 7, "chunk_00006")]


def test_stems_and_lists(spark):
    stems = spark.createDataFrame([("a_ocr",), ("a_ocr_ocr",), ("a_OCR",)], "stem string")
    assert [r["report_stem"] for r in corpus.with_report_stem(stems).collect()] == ["a", "a_ocr", "a_OCR"]
    listing = spark.createDataFrame([("Smith et al. 2002",), ("X",)], "stem string")
    names = spark.createDataFrame(list(enumerate(["Smith et al. 2002", " X.PDF ", "", "gone", "X"])), "list_pos int, name string")
    got, missing = corpus.allow_list(listing, names)
    assert [r["stem"] for r in got.collect()] == ["Smith et al. 2002", "X", "X"] and [r["stem"] for r in missing.collect()] == ["gone"]
    assert [r["stem"] for r in corpus.start_from(spark.createDataFrame([("A",), ("B",), ("c",)], "stem string"), "b").collect()] == ["B", "c"]


def test_geometry(spark):
    kinds = "doc string, item_no int, text string, page_no int, l double, t double, r double, b double, origin string"
    rows = [("d", 0, "x", 1, 10.0, 700.0, 50.0, 690.0, "BOTTOMLEFT"), ("d", 1, "x", 1, 0.0, 0.0, 5.0, 1.9, "TOPLEFT"), ("d", 2, "x", 1, 0.0, 0.0, 5.0, 3.0, None), ("d", 3, " ", 1, 0.0, 0.0, 5.0, 9.0, None), ("d", 4, "x", None, 0.0, 0.0, 5.0, 9.0, None)]
    got = geometry.overlay_commands(spark.createDataFrame(rows, kinds), F.lit(792.0)).orderBy("item_no").collect()
    assert [(r["item_no"], r["x"], r["y"], r["fontsize"]) for r in got] == [(0, 10.0, 102.0, 8.0), (2, 0.0, 3.0, 4.0)]


def test_figures(spark):
    kinds = "doc string, pic_no int, page int, bbox array<double>, class_name string, caption string, has_image boolean"
    df = spark.createDataFrame([("d", 0, 0, [1.0, 2.0, 3.0, 4.0], 'a "b"', "c", True), ("d", 1, 0, None, None, None, False), ("d", 2, None, None, None, None, True)], kinds)
    named = geometry.named_figures(df)
    assert [r["file"] for r in named.orderBy("pic_no").collect()] == ["fig_p0_000.png", "fig_px_002.png"]
    docs = spark.createDataFrame([("d",), ("e",)], "doc string")
    got = {r["doc"]: json.loads(r["json"]) for r in geometry.figure_manifest(named, docs, captioned=True).collect()}
    assert got["e"] == {"n_figures": 0, "figures": []}
    assert got["d"]["figures"] == [{"file": "fig_p0_000.png", "page": 0, "bbox": [1.0, 2.0, 3.0, 4.0], "classification": 'a "b"', "caption": "c"}, {"file": "fig_px_002.png", "page": None, "bbox": None, "caption": None}]
    assert "caption" not in json.loads(geometry.figure_manifest(named).first()["json"])["figures"][0]


def test_text_semantics_are_pythons(spark):
    rng = random.Random(5)
    alphabet = "ab 1.#\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0    　​٣é😀"
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, x string")
    got = df.select("i", T.strip(F.col("x")).alias("s"), T.split_lines(F.col("x")).alias("l"), T.normalize(F.col("x")).alias("n"), T.is_blank(F.col("x")).alias("b"), T.is_noise_heading(F.col("x")).alias("z")).collect()
    noise = re.compile(r"^[\d\s.\-,:;()\[\]{}/\\]+\Z")
    for r in got:
        x = cases[r["i"]]
        assert r["s"] == x.strip() and r["l"] == x.splitlines() and r["n"] == re.sub(r"\s+", " ", x).strip() and r["b"] == (not x.strip())
        assert r["z"] == (len(x) < 4 or bool(noise.match(x)))


def test_rounding_and_lossy_bytes(spark):
    values = [0.12345, 0.00005, 1.00015, 2.5, 0.99995]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(T.round4(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in got] == [round(v, 4) for v in values]
    df = spark.createDataFrame([(b"## H\xff one",)], "b binary").select(F.lit("d").alias("doc"), T.decode_lossy(F.col("b")).alias("text"))
    assert [r["text"] for r in headings.headings_of_texts(df).collect()] == ["H one"]


def corpus_folder(tmp_path):
    src = tmp_path / "pdfs"
    src.mkdir()
    (src / "alpha.pdf").write_text("# Title here\nbody\f\f## Second part\nmore text\n~raw text much longer than what was assembled")
    (src / "b.c_ocr.pdf").write_text("plain")
    return src


def test_convert_resume_and_chunks(spark, tmp_path):
    src = corpus_folder(tmp_path)
    run = lambda out, **k: {r["doc"]: r["status"] for r in convert.convert(spark, corpus.Config(pdf_input=str(src), output_dir=str(tmp_path / out), **k), adapters.TextPdf, adapters.TextRecogniser, str(tmp_path / "cache") if k.get("chunk_size") else None).collect()}
    assert run("whole") == {"alpha": "written", "b.c": "written"}
    assert run("parts", chunk_size=2) == {"alpha": "written", "b.c": "written"}
    for name in ("text_docling.txt", "ocr_docling.json", "headings.json"):
        assert (tmp_path / "whole/alpha" / name).read_text() == (tmp_path / "parts/alpha" / name).read_text()
    data = json.loads((tmp_path / "whole/alpha/ocr_docling.json").read_text())
    assert [p["page_index"] for p in data] == [0, 1, 2] and data[2]["full_text"].startswith("raw text")
    assert json.loads((tmp_path / "whole/alpha/headings.json").read_text()) == {"document": "alpha", "n_headings": 1, "headings": [{"page": 0, "text": "Title here"}]}
    assert run("parts", chunk_size=2) == {"alpha": "written", "b.c": "written"}  # from the cache
    assert run("whole", skip_existing=True) == {}
    (src / "alpha_ocr.pdf").write_text("again")
    assert run("clash")["alpha"] == "name collision"
    rows = corpus.read_pages(spark, str(tmp_path / "whole/*/ocr_docling.json"))
    assert rows.where("doc = 'alpha'").count() == 3


class CountingRecogniser(adapters.TextRecogniser):
    """Leaves a file for each call, and fails on pages with the word poison."""

    def __init__(self, folder):
        self.folder = folder

    def recognise(self, doc, content):
        (Path(self.folder) / uuid.uuid4().hex).write_text(doc)
        if b"poison" in content:
            raise ValueError("cannot read this")
        return super().recognise(doc, content)


class BrokenFigures:
    def figures(self, doc, content, scale):
        if doc == "a":
            raise ValueError("no figures")
        return iter(())


class BrokenOverlay(adapters.TextPdf):
    def overlay(self, content, commands):
        if b"first" in content:
            raise ValueError("no overlay")
        return content


@pytest.mark.parametrize("chunk_size", [None, 1])
def test_convert_reports_failed_recognition(spark, tmp_path, chunk_size):
    src = tmp_path / "pdfs"
    src.mkdir()
    (tmp_path / "calls").mkdir()
    (src / "a.pdf").write_text("first\fsecond")
    (src / "bad.pdf").write_text("fine\fpoison\ffine")
    (src / "real.pdf").write_bytes(b"%PDF-1.7")
    names = tmp_path / "names.txt"
    names.write_text("a\nbad\nreal\nlost\n")
    config = corpus.Config(pdf_input=str(src), output_dir=str(tmp_path / "o"), chunk_size=chunk_size, file_list=str(names))
    factory = functools.partial(CountingRecogniser, str(tmp_path / "calls"))
    got = {r["doc"]: r["status"] for r in convert.convert(spark, config, adapters.TextPdf, factory).collect()}
    assert got["a"] == "written" and "cannot read" in got["bad"] and "real PDF" in got["real"] and got["lost"] == "not found" and len(got) == 4
    assert not (tmp_path / "o/bad").exists() and (tmp_path / "o/a/ocr_docling.json").exists()
    assert len(list((tmp_path / "calls").iterdir())) == (5 if chunk_size else 2)  # each chunk is recognised once
    (src / "bad.pdf").write_text("fine\fcured\ffine")
    config.skip_existing, config.file_list = True, None
    got = {r["doc"]: r["status"] for r in convert.convert(spark, config, adapters.TextPdf, factory).collect()}
    assert got["bad"] == "written" and "a" not in got


def test_convert_reports_failed_figures_and_files(spark, tmp_path):
    src = tmp_path / "pdfs"
    src.mkdir()
    (src / "a.pdf").write_text("text")
    (src / "b.pdf").write_text("text")
    (src / "c.pdf").write_text("first")
    config = corpus.Config(pdf_input=str(src), output_dir=str(tmp_path / "o"), docling={"extract_figures": True})
    got = {r["doc"]: r["status"] for r in convert.convert(spark, config, BrokenOverlay, adapters.TextRecogniser, None, BrokenFigures).collect()}
    assert "no figures" in got["a"] and got["b"] == "written" and "no overlay" in got["c"]
    assert [p.parent.name for p in (tmp_path / "o").glob("*/ocr_docling.json")] == ["b"]


def test_heading_counts_are_read_back(spark, tmp_path):
    for name, text in (("x", '{"n_headings": 3}'), ("y", "not json"), ("z", '{"headings": []}')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "headings.json").write_text(text)
    got = {r["doc"]: r["n_headings"] for r in corpus.read_heading_counts(spark, str(tmp_path / "*/headings.json")).collect()}
    assert got == {"x": 3, "y": 0, "z": 0}


def test_captions_over_http():
    seen = []

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": "a map"}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    engine = adapters.named_factory("leafwork.operators.adapters:ChatCaptioner")(f"http://127.0.0.1:{server.server_port}/", "m")
    assert engine.caption(b"png", "see", 5.0) == "a map"
    server.shutdown()
    path, said = seen[0]
    assert path == "/v1/chat/completions" and said["model"] == "m" and said["messages"][0]["content"][0]["text"] == "see"


class Captioner:
    def caption(self, image, prompt, timeout):
        return f"{prompt}: {image.decode()}"


def test_convert_figures_and_searchable_pdf(spark, tmp_path):
    src = tmp_path / "pdfs"
    src.mkdir()
    (src / "a.pdf").write_text("one\n!chart picture\f!photo\f!map third")
    (src / "b.pdf").write_text("no figure")
    docling = {"extract_figures": True, "classify_figures": True, "picture_description_model": "m", "picture_description_prompt": "see"}
    config = corpus.Config(pdf_input=str(src), output_dir=str(tmp_path / "o"), chunk_size=2, docling=docling)
    convert.convert(spark, config, adapters.TextPdf, adapters.TextRecogniser, None, adapters.TextRecogniser, Captioner).collect()
    got = json.loads((tmp_path / "o/a/figures/figures.json").read_text())
    assert [(f["file"], f["page"], f["classification"], f["caption"]) for f in got["figures"]] == [("fig_p0_000.png", 0, "chart", "see: picture"), ("fig_p2_002.png", 2, "map", "see: third")]
    assert (tmp_path / "o/a/figures/fig_p2_002.png").read_bytes() == b"third"
    assert json.loads((tmp_path / "o/b/figures/figures.json").read_text()) == {"n_figures": 0, "figures": []}
    assert (tmp_path / "o/a/a_ocr.pdf").read_bytes() == (src / "a.pdf").read_bytes()
    config.docling = {"do_ocr": False}
    config.output_dir = str(tmp_path / "plain")
    convert.convert(spark, config, adapters.TextPdf, adapters.TextRecogniser).collect()
    assert not (tmp_path / "plain/a/a_ocr.pdf").exists() and not (tmp_path / "plain/a/figures").exists()


def test_backfill_extract_and_stream(spark, tmp_path):
    folder = tmp_path / "out/rep"
    folder.mkdir(parents=True)
    page = lambda i, *lines: {"page_index": i, "image_path": "", "text_lines": [{"text": x, "confidence": 1.0, "bbox": []} for x in lines], "full_text": "\n".join(lines)}
    (folder / "ocr_docling.json").write_text(json.dumps([page(0, "Intro part", "text"), page(1)]))
    (folder / "rep.md").write_text("## Intro part\n\ntext")
    (tmp_path / "out/bare").mkdir()
    (tmp_path / "out/bare/ocr_docling.json").write_text("[]")
    base = str(tmp_path / "out")
    dry = {r["doc"]: (r["status"], r["n_matched"]) for r in convert.backfill(spark, base, dry_run=True).collect()}
    assert dry == {"rep": ("ready", 1), "bare": ("no_markdown", 0)} and not (folder / "text_docling.txt").exists()
    convert.backfill(spark, base).collect()
    assert (folder / "text_docling.txt").read_text() == "=== Page 0 ===\n## Intro part\ntext\n\n=== Page 1 ===\n"
    assert tuple(convert.extract(spark, base, dry_run=True).first()) == (1, 0)
    convert.extract(spark, base)
    assert json.loads((folder / "headings.json").read_text())["headings"] == [{"page": 0, "text": "Intro part"}]
    assert tuple(convert.extract(spark, base).first()) == (0, 1)
    for _ in range(2):  # the second run finds nothing new
        q = ingest_headings(spark, base, str(tmp_path / "table"), str(tmp_path / "state"))
        q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1


def test_sources(spark, tmp_path):
    src = corpus_folder(tmp_path)
    (src / "notes.txt").write_text("x")
    (src / "sub").mkdir()
    (src / "sub/zeta_ocr.pdf").write_text("z")
    stems = lambda **k: [r["stem"] for r in corpus.list_pdfs(spark, str(src), **k)[0].collect()]
    assert stems() == ["alpha", "b.c_ocr"] and stems(start="B") == ["b.c_ocr"] and stems(from_ocr_pdf=True) == ["zeta_ocr"]
    assert stems(file_list=["b.c_ocr.pdf", "alpha", "no"]) == ["b.c_ocr", "alpha"]
    assert [r["stem"] for r in corpus.list_pdfs(spark, str(src / "alpha.pdf"), start="Z")[0].collect()] == ["alpha"]
    with pytest.raises(ValueError):
        corpus.list_pdfs(spark, str(src / "notes.txt"))
    for d in ("x/r1", "y_md/r2"):
        (tmp_path / "two" / d).mkdir(parents=True)
        (tmp_path / "two" / d / "ocr_docling.json").write_text("[]")
    assert [r["report"] for r in corpus.list_reports(spark, str(tmp_path / "two"), True).collect()] == ["r1"]


def test_config_and_cli(spark, tmp_path, capsys):
    src = corpus_folder(tmp_path)
    (tmp_path / "names.txt").write_text("alpha\n")
    (tmp_path / "c.yaml").write_text(f"pdf_input: {src}\noutput_dir: {tmp_path}/o\nfile_list: names.txt\ndocling:\nstrange: 1\n")
    config = corpus.Config.load(str(tmp_path / "c.yaml"), start_from="", output_dir=str(tmp_path / "p"))
    assert config.output_dir.endswith("/p") and config.file_list == str(tmp_path / "names.txt") and config.docling == {} and config.other == {"strange": 1}
    assert config.stages()["do_ocr"] is True and config.stages()["classify_figures"] is False


def test_adapters_isolate_failures(spark):
    class Broken:
        def page_count(self, content):
            raise ValueError("bad")

        def recognise(self, doc, content):
            raise ValueError("bad")

        def caption(self, image, prompt, timeout):
            raise TimeoutError

    docs = spark.createDataFrame([("d", bytearray(b"x"))], "doc string, content binary")
    row = adapters.page_counts(docs, Broken).first()
    assert row["n_pages"] is None and "bad" in row["error"]
    assert adapters.recognise(docs.withColumn("chunk_start", F.lit(0)), Broken).first()["kind"] == "error"
    pics = docs.select("doc", F.lit(0).alias("pic_no"), F.col("content").alias("image"))
    assert adapters.captions(pics, Broken, None, 1.0).first()["caption"] is None


def test_manifest_sink(spark, tmp_path):
    df = spark.createDataFrame([("d", '{"n_figures":0,"figures":[]}')], "doc string, json string")
    assert sinks.write_manifests(df, str(tmp_path)).first()["status"] == "written"
    assert json.loads((tmp_path / "d/figures/figures.json").read_text()) == {"n_figures": 0, "figures": []}
