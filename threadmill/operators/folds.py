"""An image's rows in order: repeats and near repeats go, wrapped lines join the row before.

Rows are compared with the last one kept, not with the one before, so this is a fold over each image."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import plain

Row = tuple[str, str, str]


def _close(a: Row, b: Row, minutes: float) -> bool:
    return a[1] == b[1] and a[0][:10] == b[0][:10] and plain.within(a[0], b[0], minutes)


def without_repeats(rows: list[Row]) -> list[Row]:
    """Without exact repeats, and with the better text, at the earlier time, of near repeats at most two minutes apart."""
    out: list[Row] = []
    for r in dict.fromkeys(rows):
        if out and _close(out[-1], r, 2) and plain.near_duplicates(out[-1][2], r[2]):
            if plain.quality(r[2]) > plain.quality(out[-1][2]):
                out[-1] = (*out[-1][:2], r[2])
        else:
            out.append(r)
    return out


def with_joined_lines(rows: list[Row]) -> list[Row]:
    out: list[Row] = []
    for r in rows:
        if out and _close(out[-1], r, 1) and plain.continues(out[-1][2], r[2]):
            out[-1] = (*out[-1][:2], plain.clean_message(out[-1][2] + " " + r[2]))
        else:
            out.append((*r[:2], plain.clean_message(r[2])))
    return out


def postprocessed(rows: list[Row]) -> list[Row]:
    cleaned = [(a, b, m) for a, b, c in rows if (m := plain.clean_message(c))]
    return list(dict.fromkeys(with_joined_lines(without_repeats(cleaned))))


def postprocess(side_rows: DataFrame) -> DataFrame:
    """image_id, row_no, time_text, side, message after the fold; rows in order of screen and row. An image is one group, as
    large as what its screens show."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["screen_idx", "row_no"])
        rows = postprocessed(list(zip(frame.time_text, frame.side, frame.message)))
        return pd.DataFrame([(frame.image_id.iloc[0], k, *r) for k, r in enumerate(rows)], columns=["image_id", "row_no", "time_text", "side", "message"])

    return side_rows.groupBy("image_id").applyInPandas(run, "image_id string, row_no int, time_text string, side string, message string")


def merged_screens(side_rows: DataFrame) -> DataFrame:
    """All screens' rows of an image, in order; of equal ones the first."""
    first = Window.partitionBy("image_id", "time_text", "side", "message").orderBy("screen_idx", "row_no")
    return side_rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def spread_times(rows: DataFrame) -> DataFrame:
    """Repeated times of one image moved apart by estimated gaps; off in every plan, as such times are not evidence.

    A gap is one minute, or three at a change of side, and one more after a message of ten words or more."""
    order = Window.partitionBy("image_id").orderBy("row_no")
    island = Window.partitionBy("image_id", "_island").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.when(F.lag("side").over(order) == F.col("side"), 1).otherwise(3) + (F.size(F.split(F.trim(F.lag("message").over(order)), r"\s+")) >= 10).cast("int")
    fresh = F.coalesce(F.lag("time_text").over(order) != F.col("time_text"), F.lit(True))
    marked = rows.withColumn("_gap", F.when(fresh, 0).otherwise(gap)).withColumn("_island", F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.withColumn("minutes", F.sum("_gap").over(island)).drop("_gap", "_island")
