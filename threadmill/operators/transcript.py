"""From rows of all images to one transcript in order of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text
from .steps import cut


def merge(rows: DataFrame, keep_duplicates: bool = False, so_far: tuple[str, ...] = ("seq",)) -> DataFrame:
    """chat rows (so_far: the columns that order them so far) cleaned, without empty ones and, unless kept, repeats, with seq by time.

    Rows whose time can't be read come last; equal times stay in order. Repeats agree in time text, sender, receiver and message
    but for case and spacing; the first in order stays. Tasks find the first of their own repeats before those meet, and rows are
    dealt by ranges of their order, whatever minute has most of them; a row's number is its place in its range after the rows of
    all ranges before, whose counts are few."""
    clean = rows.withColumn("message", text.final_clean(F.col("message"))).filter("message <> ''").withColumn("_ts", text.chat_time(F.col("time_text")))
    by = [F.col("_ts").isNull(), F.col("_ts"), *map(F.col, so_far)]
    if not keep_duplicates:
        place = F.struct(by[0].alias("_last"), "_ts", *so_far, *[c for c in rows.columns if c not in so_far])
        first = clean.groupBy("time_text", "sender", "receiver", text.dedupe_key(F.col("message")).alias("_key")).agg(F.min(place).alias("_first"))
        clean = first.select("_first.*").drop("_last")
    # Kept once: another sampling of ranges might deal rows otherwise.
    ordered = cut(clean.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    placed = ordered.withColumns({"_range": F.shiftright("_id", 33), "_k": F.col("_id").bitwiseAND((1 << 33) - 1)})
    counts = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(before, "_range").withColumn("seq", F.col("_before") + F.col("_k")).select(*dict.fromkeys(["seq", *rows.columns]))
