"""What a run did, as counts and as one JSON document."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

from pyspark.sql import DataFrame, functions as F


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def counts(items: DataFrame) -> DataFrame:
    status = F.col("status")
    named = {"items": F.lit(True), "ok": status == "ok", "skipped": status.startswith("skipped"), "failed": status == "failed"}
    return items.agg(*[F.count_if(c).alias(n) for n, c in named.items()])


def write(path: str, mode: str, report: str, output: str, merged: int, settings: dict, sources: list, items: DataFrame, files: DataFrame) -> dict:
    """Writes the manifest; items and files are as many as a package's pictures and files, which a manifest lists one by one."""
    c = counts(items).first()
    inventory = [r.asDict() for r in files.orderBy("source", F.lower("absolute_path")).collect()]
    data = {
        "created_at": utc_now(),
        "mode": mode,
        "case_report": report,
        "output_csv": output,
        "rows_merged": merged,
        "settings": settings,
        "evidence_sources": [{"source": s.original_path, "resolved_root": s.root_path, "type": s.source_type, "extracted": s.extracted} for s in sources],
        "counts": {"files_seen": len(inventory), "candidate_images": c["items"], "processed_images": c["ok"], "skipped_images": c["skipped"], "failed_images": c["failed"]},
        "items": [r.asDict() for r in items.orderBy("image").collect()],
        "files": inventory,
    }
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(data, f, ensure_ascii=False, indent=2)
    return data
