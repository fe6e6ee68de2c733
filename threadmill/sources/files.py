"""Files of evidence packages: folders, archives and single files as one inventory, reports and images picked from it."""

from __future__ import annotations

import glob
import io
import os
import re
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import tables as t


class EvidenceSource(NamedTuple):
    original_path: str
    root_path: str
    source_type: str  # file, folder or zip
    extracted: bool


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(?<=[^/])(\.[^./]+)$", 1))


def is_image(path: Column) -> Column:
    return extension(path).isin(*t.IMAGE_EXTENSIONS)


def is_report(path: Column) -> Column:
    return extension(path).isin(*t.REPORT_EXTENSIONS)


def is_zip(path: Column) -> Column:
    return extension(path) == ".zip"


def ignored(path: Column) -> Column:
    """Whether any part of a path is a folder of no interest."""
    return F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, t.IGNORED_DIRS)))


def archive_dir(path: Column, mtime_ns: Column, size: Column) -> Column:
    """A stable name for what an archive holds: its stem and a digest of path, time and size."""
    return F.concat(safe_stem(path), F.lit("_"), F.substring(F.sha1(F.concat_ws(":", path, mtime_ns.cast("string"), size.cast("string"))), 1, 10))


def safe_stem(path: Column) -> Column:
    """A file's stem with nothing but letters, digits, dot, underscore and hyphen."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "_"), "_+", "_"), "^_|_$", "")
    return F.when(safe == "", "input").otherwise(safe)


def unique_stems(stems: list[str]) -> list[str]:
    """Stems made distinct whatever their case, by _002, _003 and so on; small lists on the driver, as a given name may be taken."""
    used: set[str] = set()
    out = []
    for stem in stems:
        name, k = stem, 2
        while name.lower() in used:
            name, k = f"{stem}_{k:03d}", k + 1
        used.add(name.lower())
        out.append(name)
    return out


def resolve_output(value: str | None, base: str, default: str) -> str:
    return os.path.join(base, os.path.expanduser(value) if value else default)


def ensure_exists(path: str, label: str) -> str:
    if not os.path.exists(path):
        raise FileNotFoundError(f"{label} not found: {path}")
    return path


def resolve(value: str) -> EvidenceSource:
    path = ensure_exists(os.path.expanduser(value), "input")
    kind = "folder" if os.path.isdir(path) else "zip" if path.lower().endswith(".zip") else "file"
    return EvidenceSource(path, path, kind, kind == "zip")


def resolve_all(values: list[str]) -> list[EvidenceSource]:
    """Sources of paths and patterns; what doesn't exist is passed over with a warning."""
    out = []
    for v in values:
        hits = sorted(glob.glob(os.path.expanduser(v))) if re.search(r"[*?\[]", v) else [v]
        for h in hits:
            try:
                out.append(resolve(h))
            except FileNotFoundError as e:
                print(f"[WARN] {e}")
    return out


def members(archives: DataFrame) -> DataFrame:
    """source, path, content of the files in archives (path, content); folders and names that lead outside are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, content in frame.itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in z.infolist():
                        inside = os.path.normpath(m.filename.replace("\\", "/"))
                        if m.is_dir():
                            continue
                        if os.path.isabs(inside) or inside.split("/")[0] == "..":
                            print(f"[WARN] unsafe archive member left out: {m.filename}")
                            continue
                        yield pd.DataFrame({"source": [source], "path": [inside], "content": [z.read(m)]})

    return archives.select("path", "content").mapInPandas(run, "source string, path string, content binary")


def _plain(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "%20", " ")


def scan(spark: SparkSession, sources: list[EvidenceSource]) -> DataFrame:
    """source, root, path (below root), absolute_path, content of all files of the sources; contents are read where they are used."""
    parts = []
    for s in sources:
        reader = spark.read.format("binaryFile")
        if s.source_type == "zip":
            inner = members(reader.load(s.original_path))
            made = inner.select(F.lit(s.original_path).alias("source"), F.lit(s.root_path).alias("root"), "path", F.concat(F.lit(s.root_path + "/"), F.col("path")).alias("absolute_path"), "content")
        else:
            found = reader.option("recursiveFileLookup", "true").load(s.original_path).withColumn("path", _plain(F.col("path")))
            root = os.path.abspath(s.root_path)
            below = F.expr(f"substring(path, {len(root) + 2})") if s.source_type == "folder" else F.regexp_extract("path", r"([^/]*)$", 1)
            made = found.select(F.lit(s.original_path).alias("source"), F.lit(s.root_path).alias("root"), below.alias("path"), F.col("path").alias("absolute_path"), "content")
        parts.append(made)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(~ignored(F.col("absolute_path")))


def images(files: DataFrame) -> DataFrame:
    """The image files, each path once, with image_order, by which rows of several images are put in order.

    Repeats are told by names alone, so contents are neither shuffled for a window nor numbered in one place."""
    found = files.filter(is_image(F.col("absolute_path")))
    once = found.groupBy("absolute_path").agg(F.min("source").alias("source"))
    return found.join(once, ["absolute_path", "source"], "left_semi").select(*files.columns, F.lower("absolute_path").alias("image_order"))


def report_score(path: Column) -> Column:
    """How likely a path (below its root) is the case report."""
    name, whole = F.lower(F.regexp_extract(path, r"([^/]*)$", 1)), F.lower(path)
    points = [F.when(name.rlike(p), n).otherwise(0) for p, n in t.REPORT_NAME_SCORES]
    points += [F.when(F.contains(whole, F.lit(w)), n).otherwise(0) for w, n in (("evidence", -8), ("structured", -10), ("unstructured", -3))]
    points.append(F.when(name.rlike("|".join(t.REPORT_NOISE)), -40).otherwise(0))
    points.append(F.when(extension(path) == ".pdf", 5).otherwise(0))
    depth = F.size(F.split(path, "/")) - 1
    total = sum(points[1:], points[0]) - 3 * depth
    return F.when(is_report(path), total).otherwise(-10_000)


def best_report(files: DataFrame) -> DataFrame:
    """The one row of the likeliest report: best score, then the shallower, then the last by path."""
    scored = files.withColumn("score", report_score(F.col("path"))).filter("score > -1000")
    return scored.orderBy(F.desc("score"), F.size(F.split("path", "/")), F.desc(F.lower("path"))).limit(1)


def inventory(files: DataFrame, report: str | None) -> DataFrame:
    """file_inventory: what each file is taken for."""
    path = F.col("absolute_path")
    status = F.when(path == F.lit(report or ""), "case_report").when(is_image(path), "candidate_image").when(is_report(path), "ignored_report_candidate").otherwise("ignored_non_image")
    return files.select("source", "path", "absolute_path", extension(path).alias("extension"), status.alias("status"))


def decoded(content: Column) -> Column:
    """Text of bytes: UTF-8 without its mark, or Latin-1 where they aren't UTF-8."""
    as_text = content.cast("string")
    return F.when(F.is_valid_utf8(as_text), F.regexp_replace(as_text, "^﻿", "")).otherwise(F.decode(content, "ISO-8859-1"))


def report_text(content: Column, path: Column) -> Column:
    """Text of a report file; a mark at its start stays. PDF needs a reader from threadmill.edge; other kinds have no text."""
    raw = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.when(extension(path) == ".txt", raw).otherwise("")
