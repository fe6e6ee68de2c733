"""From blocks and models' texts to named rows: the plan of one platform's images."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..model import PlatformProfile
from ..operators import blocks as blocks_, bubbles, candidates, folds, sidemap, sides
from ..operators.blocks import SCREEN
from ..sources import side_csv


class Screens(NamedTuple):
    """What is known of each screen before any model is asked."""

    blocks: DataFrame
    dates: DataFrame
    times: DataFrame
    bubbles: DataFrame
    context: DataFrame


def evidence(ocr_text: DataFrame, report: DataFrame, profile: PlatformProfile, width: Column | None = None, widths: DataFrame | None = None) -> Screens:
    """report has one row (report_id, text). With a width, or widths (image_id, screen_idx, width), sides of blocks are settled
    anew by visual lines."""
    parsed = blocks_.parse(ocr_text)
    if widths is not None:
        wide = parsed.join(widths.withColumnRenamed("width", "_screen_width"), list(SCREEN))
        parsed = blocks_.refine(wide, profile, F.col("_screen_width")).drop("_screen_width")
    elif width is not None:
        parsed = blocks_.refine(parsed, profile, width)
    year = F.broadcast(report.limit(1).select(text.report_year(F.col("text")).alias("default_year")))
    with_year = parsed.crossJoin(year)
    dates = blocks_.visible_date(with_year, profile, F.col("default_year"))
    if profile.carries_date:
        dates = blocks_.carried_date(dates)
    times = bubbles.allowed_times(parsed)
    both = bubbles.timed(parsed, profile)
    if profile.geometric:
        both = both.unionByName(bubbles.geometric(parsed, profile))
    context = sides.contexts(dates.crossJoin(year), both, times)
    return Screens(parsed, dates, times, both, context)


def rows(known: Screens, drafts: DataFrame, profile: PlatformProfile, omit_emojis: bool = True) -> DataFrame:
    """Chosen rows of every screen from models' texts (side_csv_text: candidates draft, repair, polish)."""
    plain = drafts.filter("candidate <> 'polish'")
    normal = side_csv.write(sides.normalized(plain, known.context, profile, omit_emojis))
    every = normal.unionByName(drafts.filter("candidate = 'polish'").select(*normal.columns))
    return side_csv.read(candidates.choose(every, known.context, profile.additive, profile.geometric))


def extract(ocr_text: DataFrame, report: DataFrame, drafts: DataFrame, profile: PlatformProfile, people: DataFrame | None = None, maps: DataFrame | None = None, width: Column | None = None, omit_emojis: bool = True) -> DataFrame:
    """image_id, row_no, time_text, sender, receiver, message of images of one platform.

    people: participants, by default those of the report; maps: side maps that a model gave, for images without evidence."""
    return named(evidence(ocr_text, report, profile, width), report, drafts, profile, people, maps, omit_emojis)


def named(known: Screens, report: DataFrame, drafts: DataFrame, profile: PlatformProfile, people: DataFrame | None = None, maps: DataFrame | None = None, omit_emojis: bool = True) -> DataFrame:
    """extract() from evidence that is known already."""
    found = sidemap.side_map(known.blocks, people if people is not None else sidemap.participants(report))
    if maps is not None:
        found = found.unionByName(maps.join(found, "image_id", "left_anti").select(*found.columns))
    one = folds.postprocess(folds.merged_screens(rows(known, drafts, profile, omit_emojis)))
    return sidemap.apply(one.withColumn("screen_idx", F.lit(0)), found).select("image_id", "row_no", "time_text", "sender", "receiver", "message")


__all__ = ["SCREEN", "Screens", "evidence", "extract", "rows"]
