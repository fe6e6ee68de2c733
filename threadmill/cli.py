"""Command line of package runs."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import package


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="threadmill", description="Transcript of a package of chat pictures and a case report.")
    p.add_argument("package_or_report")
    p.add_argument("inputs", nargs="*")
    p.add_argument("--case-report")
    p.add_argument("-o", "--output", default="results")
    p.add_argument("--classify-mode", choices=("auto", "vision", "filename"), default="auto")
    p.add_argument("--force-platform", choices=("auto", "facebook", "viber"), default="auto")
    p.add_argument("--emoji-mode", choices=("omit", "vision"), default="omit")
    p.add_argument("--keep-duplicates", action="store_true")
    p.add_argument("--grid")
    p.add_argument("--layout")
    for name, default in (("model", ""), ("langs", "en")):
        p.add_argument(f"--{name}", default=default)
    for name in ("cpu", "no-vision", "debug", "keep-per-image", "dump-ocr", "dump-draft", "dump-side-map"):
        p.add_argument(f"--{name}", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None, edge: package.Edge | None = None) -> int:
    a = parser().parse_args(argv)
    if a.grid and a.layout:
        print("[ERROR] --grid and --layout exclude each other")
        return 1
    spark = spark or SparkSession.builder.appName("threadmill").getOrCreate()
    edge = (edge or package.Edge())._replace(grid=a.grid, layout=a.layout)
    settings = {k: getattr(a, k) for k in ("model", "langs", "emoji_mode", "classify_mode", "force_platform", "debug", "no_vision", "cpu")}
    return package.run(spark, a.package_or_report, a.output, a.inputs, a.case_report, edge, a.classify_mode, a.force_platform, a.keep_duplicates, a.emoji_mode == "omit", not a.no_vision, settings=settings)


if __name__ == "__main__":
    sys.exit(main())
