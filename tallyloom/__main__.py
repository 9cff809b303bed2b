"""Batch run: `spark-submit -m tallyloom <inputs> <outputs> [--posts GLOB] [--cases FILE]`."""

from __future__ import annotations

import argparse
import time

from tallyloom.plans import (
    cross_reports,
    indicator_facts,
    panel_reports,
    posting_reports,
    survey_star,
    topic_reports,
)
from tallyloom.session import build_session, clear_staged
from tallyloom.sources.catalog import Catalog


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyloom")
    parser.add_argument("inputs")
    parser.add_argument("outputs")
    parser.add_argument("--posts", help="CSV files of forum posts")
    parser.add_argument("--cases", help="CSV file of daily case numbers")
    parser.add_argument(
        "--named-sexes",
        action="store_true",
        help="report suicide columns under their true sex instead of as published",
    )
    options = parser.parse_args(argv)
    spark = build_session()
    catalog = Catalog(options.inputs, options.outputs)
    published = not options.named_sexes
    steps = [
        ("survey tables", lambda: survey_star.run(spark, catalog)),
        ("indicator tables", lambda: indicator_facts.run(spark, catalog)),
        ("panel reports", lambda: panel_reports.run(spark, catalog, published)),
        ("cross reports", lambda: cross_reports.run(spark, catalog, published)),
    ]
    if options.posts:
        steps += [
            ("posting reports", lambda: posting_reports.run(spark, catalog, options.posts, options.cases)),
            ("topic reports", lambda: topic_reports.run(spark, catalog)),
        ]
    for name, step in steps:
        started = time.monotonic()
        try:
            step()
        finally:
            clear_staged(spark)
        print(f"{name}: {time.monotonic() - started:.1f} s", flush=True)


if __name__ == "__main__":
    main()
