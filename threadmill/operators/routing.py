"""Which platform a picture is from, and what becomes of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import tables as t


def platform_name(c: Column) -> Column:
    """facebook, viber, non_chat or unknown for any spelling of them."""
    key = F.translate(F.lower(F.trim(F.coalesce(c, F.lit("")))), "- ", "__")
    return F.coalesce(*[F.when(key.isin(*names), p) for p, names in t.PLATFORM_NAMES.items()], F.lit("unknown"))


def by_path(path: Column) -> Column:
    """The platform that a whole path names; the first one wins where it names both."""
    low = F.replace(F.lower(path), F.lit("\\"), F.lit("/"))
    names = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return F.when(names(t.FACEBOOK_PATHS), "facebook").when(names(t.VIBER_PATHS), "viber").otherwise("unknown")


def platform(path: Column, seen: Column, mode: str = "auto", force: str = "auto") -> Column:
    """By force, by path, by what a model saw, or by path and else by the model."""
    if force != "auto":
        return F.lit(force)
    if mode == "filename":
        return by_path(path)
    if mode == "vision":
        return platform_name(seen)
    return F.coalesce(F.nullif(by_path(path), F.lit("unknown")), platform_name(seen))


def routed(images: DataFrame) -> DataFrame:
    """Adds status and reason: only chats of a known platform go on."""
    known = F.col("platform").isin("facebook", "viber")
    return images.withColumn("status", F.when(known, "ok").otherwise("skipped_unknown_or_non_chat")).withColumn("reason", F.when(known, "").otherwise(F.concat(F.lit("platform: "), F.col("platform"))))
