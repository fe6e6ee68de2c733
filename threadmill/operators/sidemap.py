"""Who writes on which side: names from the report, matched with the header and the numbers on screen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tables as t, text
from ..model import HEADER


def victim_name(report: Column) -> Column:
    first = lambda p: F.nullif(F.regexp_extract(report, "(?isU)" + p, 1), F.lit(""))
    return text.clean_name(F.coalesce(*[first(p) for p in t.VICTIM_PATTERNS], F.lit("")))


def participants(reports: DataFrame) -> DataFrame:
    """participant rows of report texts: the victim, then suspects with the numbers in their part, else the aliases listed."""
    c = F.col("text")
    suspect = "(?isU)" + t.SUSPECT
    parts = F.regexp_extract_all(c, F.lit(suspect), 0)
    phones = lambda s: F.transform(F.regexp_extract_all(s, F.lit(f"(?U)({t.REPORT_PHONE})"), 1), text.stripped)
    body = lambda s: F.regexp_replace(s, r"(?iU)^Suspect\s*\d+:\s*[^\n\r]+", "")
    no_phones = F.array().cast("array<string>")
    found = F.transform(parts, lambda s: F.struct(text.clean_name(F.regexp_extract(s, r"(?iU)Suspect\s*\d+:\s*([^\n\r]+)", 1)).alias("name"), F.lit("suspect").alias("role"), phones(body(s)).alias("contact_numbers")))
    suspects = F.filter(found, lambda s: s["name"] != "")
    listed = F.split(F.regexp_extract(c, "(?iU)" + t.ALIASES, 1), ",| and ")
    named = F.filter(F.transform(listed, text.clean_name), lambda n: n != "")
    # Of one name in other spelling the first stays; the victim's own isn't a suspect's.
    key = lambda n: text.name_key(text.clean_name(n))
    other = F.filter(named, lambda n: key(n) != key(F.col("victim")))
    once = F.filter(other, lambda n, k: F.array_position(F.transform(other, key), key(n)) == k + 1)
    aliases = F.transform(once, lambda n: F.struct(n.alias("name"), F.lit("suspect").alias("role"), no_phones.alias("contact_numbers")))
    victim = F.when(F.col("victim") != "", F.array(F.struct(F.col("victim").alias("name"), F.lit("victim").alias("role"), no_phones.alias("contact_numbers")))).otherwise(F.array())
    every = F.concat(victim, F.when(F.size(suspects) > 0, suspects).otherwise(aliases))
    rows = reports.withColumn("victim", victim_name(c)).select("report_id", F.posexplode(every).alias("ord", "p"))
    return rows.select("report_id", "ord", "p.name", "p.role", "p.contact_numbers")


def header_match(blocks: DataFrame, people: DataFrame) -> DataFrame:
    """image_id, name, score: whose name or numbers stand in the header; of equal scores the first listed.

    people is a report's list (participant), a few rows; a name that is listed twice has its last score."""
    top = F.array_sort(F.collect_list(F.struct("screen_idx", "line_no", "text")))
    header = blocks.filter(F.col("y") <= HEADER).groupBy("image_id").agg(F.array_join(F.transform(top, lambda s: s["text"]), " ").alias("header"))
    listed = people.agg(F.array_sort(F.collect_list(F.struct("ord", text.clean_name(F.col("name")).alias("name"), "contact_numbers"))).alias("people"))
    both = header.crossJoin(F.broadcast(listed)).select("image_id", "header", F.explode("people").alias("p")).select("image_id", "header", "p.*").filter("name <> ''")
    hits = F.size(F.filter(F.coalesce("contact_numbers", F.array()), lambda n: (text.digits(n) != "") & F.contains(text.digits(F.col("header")), text.digits(n))))
    scored = both.select("image_id", "ord", "name", (text.name_in(F.col("name"), F.col("header")).cast("int") * 10 + hits * 20).alias("score")).filter("score > 0")
    named = scored.groupBy("image_id", "name").agg(F.min("ord").alias("ord"), F.max_by("score", "ord").alias("score"))
    best = Window.partitionBy("image_id").orderBy(F.desc("score"), "ord")
    return named.withColumn("_n", F.row_number().over(best)).filter("_n = 1").select("image_id", "name", "score")


def number_owner(blocks: DataFrame, people: DataFrame) -> DataFrame:
    """image_id, LEFT, RIGHT: whose numbers stand on a side; the last row wins, and a header in the middle counts as left."""
    numbers = people.select("ord", text.clean_name(F.col("name")).alias("name"), F.posexplode(F.coalesce("contact_numbers", F.array())).alias("k", "number"))
    listed = numbers.select("ord", "k", "name", text.digits(F.col("number")).alias("digits")).filter("digits <> ''")
    listed = listed.groupBy("digits").agg(F.max_by("name", F.struct("ord", "k")).alias("name"), F.min(F.struct("ord", "k")).alias("place"))
    listed = listed.agg(F.array_sort(F.collect_list(F.struct("place", "digits", "name"))).alias("numbers"))
    rows = blocks.withColumn("digits", text.digits(F.col("text"))).filter("digits <> ''").crossJoin(F.broadcast(listed))
    hit = F.filter("numbers", lambda n: F.contains(F.col("digits"), n["digits"]))
    side = F.when((F.col("pos") == "CENTER") & (F.col("y") <= HEADER), "LEFT").otherwise(F.col("pos"))
    found = rows.select("image_id", "screen_idx", "line_no", side.alias("side"), F.try_element_at(hit, F.lit(-1))["name"].alias("name")).filter("name is not null")
    last = lambda s: F.max_by("name", F.when(F.col("side") == s, F.struct("screen_idx", "line_no"))).alias(s)
    return found.groupBy("image_id").agg(last("LEFT"), last("RIGHT"))


def side_map(blocks: DataFrame, people: DataFrame) -> DataFrame:
    """side_map by evidence alone: the header's name on the left, else a number's owner on its side; the victim on the other.

    Images without such evidence have no row: those need a model."""
    victim = people.filter(F.lower("role") == "victim").orderBy("ord").limit(1).select(text.clean_name(F.col("name")).alias("victim"))
    header = header_match(blocks, people).select("image_id", F.col("name").alias("header"))
    known = header.join(number_owner(blocks, people), "image_id", "full").crossJoin(F.broadcast(victim)).filter("victim <> ''")
    other = lambda c: F.col(c).isNotNull() & ~text.same_name(F.col(c), F.col("victim"))
    left = F.when(other("header"), F.col("header")).when(other("LEFT"), F.col("LEFT")).when(other("RIGHT"), F.col("victim"))
    right = F.when(other("header") | other("LEFT"), F.col("victim")).when(other("RIGHT"), F.col("RIGHT"))
    return known.select("image_id", text.clean_name(left).alias("left_name"), text.clean_name(right).alias("right_name")).filter("left_name is not null")


def evidence(blocks: DataFrame, phones: int = 12, texts: int = 18) -> DataFrame:
    """image_id, side, phones, texts: the first of each that a side shows, to ask a model with."""
    order = ("screen_idx", "line_no")
    numbers = F.transform(F.regexp_extract_all("text", F.lit(f"(?U)({t.ROW_PHONE})"), 1), text.stripped)
    per = blocks.groupBy("image_id", F.col("pos").alias("side")).agg(F.array_sort(F.collect_list(F.struct(*order, "text", numbers.alias("numbers")))).alias("rows"))
    return per.select("image_id", "side", F.slice(F.flatten(F.transform("rows", lambda r: r["numbers"])), 1, phones).alias("phones"), F.slice(F.transform("rows", lambda r: r["text"]), 1, texts).alias("texts"))


def apply(side_rows: DataFrame, maps: DataFrame) -> DataFrame:
    """Side rows with sender and receiver; of equal rows of an image the first stays."""
    both = side_rows.filter(F.col("side").isin("LEFT", "RIGHT") & (F.col("time_text") != "") & (F.col("message") != "")).join(maps, "image_id")
    left = F.col("side") == "LEFT"
    named = both.withColumn("sender", F.when(left, F.col("left_name")).otherwise(F.col("right_name"))).withColumn("receiver", F.when(left, F.col("right_name")).otherwise(F.col("left_name")))
    first = Window.partitionBy("image_id", "time_text", "sender", "receiver", "message").orderBy("screen_idx", "row_no")
    return named.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "left_name", "right_name")
