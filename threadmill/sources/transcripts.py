"""Transcript CSV in and out."""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .files import decoded

COLUMNS = ("Time", "Sender", "Receiver", "Message")
_SCHEMA = "time_text string, sender string, receiver string, message string, source_csv string, source_image string, source_row int"


def parse(content: str) -> Iterator[tuple[int, str, str, str, str]]:
    """Row numbers (the header's is 1) and cells of rows that have all four; columns go by name, none if one is missing."""
    rows = csv.reader(io.StringIO(content))
    header = [h.lstrip("﻿").strip() for h in next(rows, [])]
    if not all(c in header for c in COLUMNS):
        print(f"[WARN] not a transcript, left out: {header}")
        return
    at = [header.index(c) for c in COLUMNS]
    for n, row in enumerate(rows, 2):
        cells = [row[k].strip() if k < len(row) else "" for k in at]
        if row and all(cells):
            yield (n, *cells)


def read(files: DataFrame) -> DataFrame:
    """chat_row but for seq, of CSV files (path, content, and source_image if there is one)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, image, text in frame.itertuples(index=False):
                rows = [(*cells, path, image, n) for n, *cells in parse(text)]
                yield pd.DataFrame(rows, columns=["time_text", "sender", "receiver", "message", "source_csv", "source_image", "source_row"])

    image = F.col("source_image") if "source_image" in files.columns else F.lit("")
    return files.select("path", image.alias("image"), decoded(F.col("content")).alias("text")).mapInPandas(run, _SCHEMA)


def write(transcript: DataFrame, path: str, mark: bool = False) -> int:
    """One CSV file of rows ordered by seq: every cell quoted, line feeds, UTF-8 (with mark: its mark first). Returns the count.

    A single file is the format, so rows stream through the driver a partition at a time; write_parts() scales."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8-sig" if mark else "utf-8", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\n")
        out.writerow(COLUMNS)
        for row in transcript.orderBy("seq").select("time_text", "sender", "receiver", "message").toLocalIterator(prefetchPartitions=True):
            out.writerow(row)
            n += 1
    return n


def write_parts(transcript: DataFrame, path: str) -> None:
    """The same rows as a folder of CSV parts in order, written by executors."""
    renamed = transcript.orderBy("seq").select(*[F.col(c.lower() if c != "Time" else "time_text").alias(c) for c in COLUMNS])
    renamed.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_images(rows: DataFrame, path: str) -> None:
    """A CSV file for each image (stem), with a mark, below path/stem=...: rows in order of row_no, written by executors."""
    quoted = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in ("time_text", "sender", "receiver", "message")])
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_no", quoted.alias("line")))), lambda s: s["line"])
    header = ",".join(f'"{c}"' for c in COLUMNS)
    content = F.concat(F.lit("\ufeff"), F.array_join(F.concat(F.array(F.lit(header)), lines), "\n"))
    rows.groupBy("stem").agg(content.alias("value")).write.mode("overwrite").partitionBy("stem").text(path)
