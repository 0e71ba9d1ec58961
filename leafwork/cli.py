"""Command line: convert, backfill, headings."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from leafwork.operators import adapters
from leafwork.plans import convert as plans
from leafwork.sources.corpus import Config


#: Used where the setting `adapters` (pdf, ocr, figures, captions: module:name) names nothing; they refuse real PDF files.
STAND_INS = {"pdf": adapters.TextPdf, "ocr": adapters.TextRecogniser, "figures": adapters.TextRecogniser, "captions": None}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="leafwork")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert")
    c.add_argument("--config", required=True)
    for name in ("--output-dir", "--start-from", "--file-list"):
        c.add_argument(name)
    b = sub.add_parser("backfill")
    where = b.add_mutually_exclusive_group(required=True)
    where.add_argument("--report-dir")
    where.add_argument("--dir")
    b.add_argument("--subfolders", action="store_true")
    b.add_argument("--dry-run", action="store_true")
    h = sub.add_parser("headings")
    h.add_argument("--input-dir", required=True)
    h.add_argument("--force", action="store_true")
    h.add_argument("--dry-run", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("leafwork").getOrCreate()
    if a.command == "convert":
        config = Config.load(a.config, output_dir=a.output_dir, start_from=a.start_from, file_list=a.file_list)
        stages, named = config.stages(), config.other.get("adapters") or {}
        made = {k: adapters.named_factory(named[k]) if k in named else f for k, f in STAND_INS.items()}
        if stages["picture_description_model"] and "captions" not in named:
            made["captions"] = partial(adapters.ChatCaptioner, stages["picture_description_base_url"], stages["picture_description_model"])
        result = plans.convert(spark, config, made["pdf"], made["ocr"], config.other.get("cache_dir"), made["figures"], made.get("captions"))
    elif a.command == "backfill":
        base, name = (a.report_dir.rstrip("/").rsplit("/", 1) if a.report_dir else (a.dir, None))
        result = plans.backfill(spark, base, a.subfolders and not name, a.dry_run)
        if name:
            result = result.where(result["doc"] == name)
    else:
        result = plans.extract(spark, a.input_dir, a.force, a.dry_run)
    for row in result.toLocalIterator():
        print(*row, sep="\t")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
