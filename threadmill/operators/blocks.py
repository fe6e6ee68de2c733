"""Text blocks: parsing, sides by geometry and colour, and lines that one side owns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tables as t, text
from ..model import PlatformProfile

SCREEN = ("image_id", "screen_idx")


def parse(ocr_text: DataFrame) -> DataFrame:
    """Blocks of tagged text: a screen header holds for the lines that follow it; other lines without a tag are left out."""
    lines = ocr_text.select("image_id", F.posexplode(F.split("content", r"\r\n|\r|\n")).alias("line_no", "line"))
    line = text.stripped(F.col("line"))
    header = F.regexp_extract(line, "(?iU)" + t.SCREEN, 1)
    number = F.when(header != "", header.cast("int"))
    follows = Window.partitionBy("image_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    known = lines.select("image_id", "line_no", line.alias("line"), F.last(number, ignorenulls=True).over(follows).alias("screen_idx"), number.isNotNull().alias("is_header"))
    part = lambda k: F.regexp_extract("line", "(?iU)" + t.BLOCK, k)
    blocks = known.filter(~F.col("is_header") & t.found(F.col("line"), t.BLOCK, True))
    ints = [part(k).cast("int").alias(n) for k, n in ((1, "block"), (3, "x"), (4, "y"), (5, "w"), (6, "h"))]
    return blocks.select("image_id", "screen_idx", "line_no", ints[0], F.upper(part(2)).alias("pos"), *ints[1:], text.stripped(part(7)).alias("text"))


def position(profile: PlatformProfile, width: Column) -> Column:
    """LEFT, RIGHT or CENTER by a block's box."""
    centre = F.col("x") + F.col("w") / 2
    middle = text.is_date_or_time(F.col("text")) & centre.between(width * 0.25, width * 0.75)
    return F.when(middle, "CENTER").when(F.col("x") >= width * profile.right_from, "RIGHT").otherwise("LEFT")


def position_by_colour(profile: PlatformProfile, width: Column, purple_ratio: Column) -> Column:
    """As position(), but an outgoing bubble's colour goes first, dates and times aside."""
    by_box = position(profile, width)
    if profile.purple_right_from is None:
        return by_box
    coloured = ~text.is_date_or_time(F.col("text")) & (F.coalesce(purple_ratio, F.lit(0.0)) >= profile.purple_right_from)
    return F.when(coloured, "RIGHT").otherwise(by_box)


def refine(blocks: DataFrame, profile: PlatformProfile, width: Column) -> DataFrame:
    """Blocks of one visual line get one side: LEFT if the line begins far enough to the left. Others stay as they are."""
    movable = F.col("pos").isin("LEFT", "RIGHT") & ~text.is_date_or_time(F.col("text"))
    some = blocks.filter(movable).withColumn("_cy", F.col("y") + F.col("h") / 2).withColumn("_width", width)
    order = Window.partitionBy(*SCREEN).orderBy("_cy", "x", "line_no")
    apart = F.abs(F.col("_cy") - F.lag("_cy").over(order)) > F.greatest(F.lit(18.0), F.least("h", F.lag("h").over(order)) * 0.75)
    lined = some.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("_line", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.min("x").over(Window.partitionBy(*SCREEN, "_line"))
    placed = lined.withColumn("pos", F.when(start < F.col("_width") * profile.line_left_below, "LEFT").otherwise("RIGHT"))
    return placed.select(*blocks.columns).unionByName(blocks.filter(~F.coalesce(movable, F.lit(False))))


def box(points: Column) -> Column:
    """Box around a polygon, an array of (x, y) pairs."""
    xs, ys = F.transform(points, lambda p: p[0].cast("int")), F.transform(points, lambda p: p[1].cast("int"))
    low_x, low_y = F.array_min(xs), F.array_min(ys)
    return F.struct(low_x.alias("x"), low_y.alias("y"), (F.array_max(xs) - low_x).alias("w"), (F.array_max(ys) - low_y).alias("h"))


def crop_order(crops: DataFrame) -> DataFrame:
    """screen_idx, from 1, of crops in reading order: rows of crops whose tops lie close together, then from the left."""
    order = Window.partitionBy("image_id").orderBy("y", "x")
    limit = F.greatest(F.lit(40), F.floor(F.median("h").over(Window.partitionBy("image_id")) * 0.25))
    apart = F.abs(F.col("y") - F.lag("y").over(order)) > F.col("_limit")
    rows = crops.withColumn("_limit", limit).withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("_row", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("screen_idx", F.row_number().over(Window.partitionBy("image_id").orderBy("_row", "x", "y"))).drop("_limit", "_new", "_row")


def visible_date(blocks: DataFrame, profile: PlatformProfile, default_year: Column) -> DataFrame:
    """image_id, screen_idx, visible_date (DD/MM/YYYY, empty if none shows) of each screen."""
    shown = text.stripped(F.col("text"))
    if profile.date_from_y is not None:
        digits = [t.Rule(r"(?<=\d)[oO](?=\d)", "0"), t.Rule(r"(?<=\s)[oO](?=\d)", "0"), t.Rule(r"(?<=\d)[lI](?=\d)", "1")]
        shown = text.spaced(t.rewritten(F.translate(shown, ".;|", "::I"), digits))
    pattern = rf"(?iU)\b({t.MONTHS})\s+(\d{{1,2}})(?:,?\s+(20\d{{2}}))?" + (r"\b" if profile.date_needs_end else "")
    part = lambda c, k: F.regexp_extract(c, pattern, k)

    def day(c: Column) -> Column:
        number = part(c, 2).cast("int")
        year = F.when(part(c, 3) != "", part(c, 3)).otherwise(F.col("_year").cast("string"))
        given = F.concat(F.lpad(part(c, 2), 2, "0"), F.lit("/"), F.lpad(text.month_number(part(c, 1)).cast("string"), 2, "0"), F.lit("/"), year)
        return F.when(F.when(part(c, 2) != "", number.between(1, 31) if profile.date_from_y is not None else F.lit(True)).otherwise(False), given)

    rows = blocks.withColumn("_year", default_year).withColumn("_shown", shown)
    low = (F.col("y") >= profile.date_from_y) & (F.col("_shown") != "") if profile.date_from_y is not None else F.lit(True)
    listed = lambda keep: F.array_sort(F.collect_list(F.when(keep, F.struct("line_no", "_shown"))))
    screens = rows.groupBy(*SCREEN, "_year").agg(listed(low).alias("low"), listed(F.lit(True)).alias("every"))
    texts = F.transform("low", lambda s: s["_shown"])
    if profile.date_from_y is not None:  # a date may be split between blocks, or stand above the usual place
        texts = F.concat(texts, F.array(F.array_join(texts, " ")), F.array(F.array_join(F.transform("every", lambda s: s["_shown"]), " ")))
    found = screens.select(*SCREEN, "_year", F.posexplode_outer(texts).alias("k", "c")).withColumn("day", F.when(F.col("c").isNotNull(), day(F.col("c"))))
    return found.groupBy(*SCREEN).agg(F.coalesce(F.min_by("day", F.when(F.col("day").isNotNull(), F.col("k"))), F.lit("")).alias("visible_date"))


def carried_date(dates: DataFrame) -> DataFrame:
    """Screens without a date take the last one shown before, in the image's order."""
    order = Window.partitionBy("image_id").orderBy("screen_idx").rowsBetween(Window.unboundedPreceding, 0)
    return dates.withColumn("visible_date", F.coalesce(F.last(F.nullif("visible_date", F.lit("")), ignorenulls=True).over(order), F.lit("")))
