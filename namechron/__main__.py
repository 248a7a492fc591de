"""Command line: thin wrappers around the plans, from parsing pages to taking over reviewed values."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from .operators.diff import KEYS, changes, report_lines
from .operators.overlay import OverlayError, dry_run
from .plans import parse_run, publish_run, reports, review_run, sample_run
from .schemas import LOG, SAMPLE
from .sources.client import RunAborted, read_images
from .sources.config import SettingsError, reader_settings
from .sources.files import address_book_names, find_readers, load_version, read_answers, read_csv, read_overlay, register_names, write_csv


def _reviewed(spark: SparkSession, a: argparse.Namespace) -> int:
    """Commands on readers' answers and review lists; 1 if a list or a measurement is refused."""
    if a.command in ("check", "takeover"):
        filled, present = read_csv(spark, a.list, ordered=True), read_overlay(spark, a.corrections)
        if a.command == "takeover":
            print(review_run.take_over(filled, *load_version(spark, a.tables), present, a.date or date.today().isoformat(), a.corrections))
            return 0
        wrong = dry_run(filled, *load_version(spark, a.tables), present)
        shown = wrong.orderBy("schl_nr", "feld").limit(100).collect()
        for r in shown:
            print(f"{r['schl_nr']} {r['feld']}: {r['meldung']}")
        return int(bool(shown))
    found = find_readers(spark, a.answers, a.readers.split(","))
    answers, names = read_answers(spark, a.answers, found), list(found)
    if a.command == "measure":
        sample = read_csv(spark, a.sample, SAMPLE)
        for name in names:
            rates = review_run.measure(sample, answers, name).orderBy("ebene", "gruppe").collect()
            print(f"# {name}\n\n{reports.table(list(rates[0].asDict()), rates)}\n")
        return 0
    tables = load_version(spark, a.tables)
    if a.command == "uncertain":
        print(review_run.write_list(review_run.uncertain(*tables, answers, names, read_csv(spark, f"{a.tables}/log", LOG, ordered=True)), a.out))
        return 0
    for name in review_run.mixed_prompts(answers):
        print(f"{name}: answers to several prompts", file=sys.stderr)
    print(review_run.write_list(review_run.build(*tables, answers, names), a.out))
    print(review_run.figures(*tables, answers, names))
    return 0


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="namechron")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, *options in (
        ("parse", "pages", "out", "--corrections", "--title"), ("publish", "tables", "register", "addresses", "out", "--source"), ("diff", "old", "new", "--out"), ("draw", "tables", "out"), ("evaluate", "sample"),
        ("review", "tables", "answers", "readers", "out"), ("uncertain", "tables", "answers", "readers", "out"), ("measure", "sample", "answers", "readers"),
        ("read", "images", "answers", "model", "prompt", "--pages", "--threads"), ("check", "tables", "list", "corrections"), ("takeover", "tables", "list", "corrections", "--date"),
    ):
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(option, **({"default": ""} if option.startswith("--") else {}))
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("namechron").getOrCreate()
    if a.command == "parse":
        try:
            print(parse_run.run(spark, a.pages, a.out, a.corrections, a.title))
        except parse_run.NothingParsed as e:
            print(e, file=sys.stderr)
            return 1
    elif a.command == "publish":
        register, addresses = register_names(read_csv(spark, a.register)), address_book_names(read_csv(spark, a.addresses, sep="\t"))
        for text in publish_run.run(*load_version(spark, a.tables), register, addresses, a.out, source=a.source).values():
            print(text)
    elif a.command == "diff":
        found = changes(*load_version(spark, a.old), *load_version(spark, a.new)).persist()
        counts = {r["kategorie"]: r["count"] for r in found.groupBy("kategorie").count().collect()}
        print(reports.changes({k: counts.get(k, 0) for k in KEYS}))
        if a.out:
            report_lines(found).orderBy("rang", "schl_nr", "zeile").select("zeile").write.mode("overwrite").text(a.out)
        found.unpersist()
    elif a.command == "read":
        try:
            print(read_images(spark, a.images, a.answers, a.model, a.prompt, reader_settings(a.model), a.pages, int(a.threads or 4)))
        except (RunAborted, SettingsError) as e:
            print(e, file=sys.stderr)
            return 1
    elif a.command == "draw":
        write_csv(sample_run.draw(*load_version(spark, a.tables)), a.out, SAMPLE)
    elif a.command == "evaluate":
        print(sample_run.evaluate(read_csv(spark, a.sample, SAMPLE)))
    else:
        try:
            return _reviewed(spark, a)
        except (review_run.OpenCorrections, OverlayError, ValueError) as e:
            print(e, file=sys.stderr)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
