"""Bubbles from blocks: told apart by gaps, or closed by the time that stands under each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tables as t, text
from ..model import TOP, PlatformProfile
from .blocks import SCREEN

_PLACE = ("y", "x", "block", "line_no")


def _below(blocks: DataFrame, limit: Column) -> DataFrame:
    """Blocks under the date of their screen; under TOP where limit finds none."""
    date_y = limit.over(Window.partitionBy(*SCREEN))
    return blocks.withColumn("_date_y", date_y).filter(F.coalesce(F.col("y") > F.col("_date_y"), F.col("y") >= TOP)).drop("_date_y")


def allowed_times(blocks: DataFrame) -> DataFrame:
    """image_id, screen_idx, hhmm: the times visible under the last date."""
    last = F.max_by("y", F.when(text.is_date(F.col("text")), F.col("line_no")))
    shown = _below(blocks, last).select(*SCREEN, text.visible_time(F.col("text")).alias("hhmm"))
    return shown.filter("hhmm is not null").distinct()


def _is_message(profile: PlatformProfile) -> Column:
    c = F.col("text")
    return F.col("pos").isin("LEFT", "RIGHT") & (text.stripped(c) != "") & ~text.is_ui(c, profile.ui_substrings, profile.icons) & ~text.is_date_or_time(c)


def side_votes(weight: Column) -> list[Column]:
    """Votes for either side, by characters."""
    return [F.sum(F.when(F.col("pos") == s, F.greatest(F.lit(1), weight)).otherwise(0)).alias(s) for s in ("LEFT", "RIGHT")]


def joined_text() -> Column:
    """The blocks' texts in order of place."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*_PLACE, "text"))), lambda s: s["text"]), " ")


def gap_limit(median_height: Column) -> Column:
    """The gap from which blocks of one side are two bubbles."""
    return F.greatest(F.lit(8), F.floor(F.floor(median_height) * 0.25))


def geometric(blocks: DataFrame, profile: PlatformProfile) -> DataFrame:
    """Bubbles (ord from 0, side, text) told apart by a change of side or a gap to the block before."""
    dated = (text.is_date(F.col("text")) | t.found(F.col("text"), r"\b\d{1,2}[:.]\d{2}\b")) & (F.col("y") > 100)
    usable = _below(blocks, F.max(F.when(dated, F.col("y")))).filter(_is_message(profile))
    median = F.median(F.greatest(F.lit(1), F.col("h"))).over(Window.partitionBy(*SCREEN))
    order = Window.partitionBy(*SCREEN).orderBy(*_PLACE)
    apart = (F.col("pos") != F.lag("pos").over(order)) | (F.col("y") - (F.lag("y").over(order) + F.lag("h").over(order)) > gap_limit(F.col("_median")))
    marked = usable.withColumn("_median", median).withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int"))
    grouped = marked.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    made = grouped.groupBy(*SCREEN, "_group").agg(*side_votes(F.length("text")), text.spaced(joined_text()).alias("text"))
    ranked = made.filter("text <> ''").withColumn("ord", F.row_number().over(Window.partitionBy(*SCREEN).orderBy("_group")) - 1)
    side = F.when(F.col("LEFT") >= F.col("RIGHT"), "LEFT").otherwise("RIGHT").alias("side")
    return ranked.select(*SCREEN, F.lit("geom").alias("kind"), "ord", F.lit(None).cast("string").alias("hhmm"), side, F.lit(None).cast("double").alias("confidence"), "text")


def timed(blocks: DataFrame, profile: PlatformProfile) -> DataFrame:
    """Bubbles (ord from 0, hhmm, side, confidence, text): a time closes all text since the time before; what none closes is left out."""
    under = _below(blocks, F.max(F.when(text.is_date(F.col("text")), F.col("y")))).withColumn("_time", text.visible_time(F.col("text")))
    before = Window.partitionBy(*SCREEN).orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    grouped = under.withColumn("_group", F.coalesce(F.count("_time").over(before), F.lit(0)))
    message = F.col("_time").isNull() & _is_message(profile)
    closer = F.max("_time").over(Window.partitionBy(*SCREEN, "_group"))
    rows = grouped.withColumn("_closer", closer).filter(message & F.col("_closer").isNotNull())
    made = rows.groupBy(*SCREEN, "_group").agg(F.first("_closer").alias("hhmm"), *side_votes(F.length(text.stripped(F.col("text")))), joined_text().alias("text"))
    side = F.when(F.col("LEFT") >= F.col("RIGHT"), "LEFT").otherwise("RIGHT").alias("side")
    confidence = F.round(F.greatest("LEFT", "RIGHT") / (F.col("LEFT") + F.col("RIGHT")), 3).alias("confidence")
    ord_ = (F.row_number().over(Window.partitionBy(*SCREEN).orderBy("_group")) - 1).alias("ord")
    return made.select(*SCREEN, F.lit("timed").alias("kind"), ord_, "hhmm", side, confidence if profile.side_confidence else F.lit(None).cast("double").alias("confidence"), "text")


def hints(bubbles: DataFrame) -> DataFrame:
    """One text per screen that lists its bubbles, to go with a question to a model."""
    line = F.format_string("bubble %d (%s%s): %s", F.col("ord") + 1, F.col("side"), F.coalesce(F.concat(F.lit(", "), F.col("hhmm")), F.lit("")), F.col("text"))
    return bubbles.groupBy(*SCREEN).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))), lambda s: s["line"]), "\n").alias("hints"))
