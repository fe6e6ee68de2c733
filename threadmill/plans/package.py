"""A whole evidence package: files found, pictures routed and read, rows merged, transcript and manifest written."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..edge import perception, questions, splitting
from ..functions import plain
from ..model import PROFILES, SCHEMAS
from ..operators import bubbles, candidates, manifest, routing, sidemap, sides, transcript
from ..operators.blocks import SCREEN
from ..operators.steps import cut
from ..sources import files as files_, side_csv, transcripts
from . import screens

OK, BAD_INPUT, NO_IMAGES, NO_ROWS = 0, 2, 3, 4


class Edge(NamedTuple):
    """What looks at pictures; each a function that makes it, called on executors."""

    reader: Callable[[], perception.StubReader] = perception.StubReader
    model: Callable[[], perception.Model] = perception.StubModel
    grid: str | None = None
    layout: str | None = None


class Plan(NamedTuple):
    mode: str
    report: str
    sources: list[files_.EvidenceSource]
    files: DataFrame
    images: DataFrame
    stem: str


def resolve(spark: SparkSession, package: str, inputs: list[str] | None = None, case_report: str | None = None) -> Plan:
    """Three ways to name a package: a report of its own; a report first, then evidence; or one package that holds both."""
    if case_report or inputs:
        report = files_.ensure_exists(os.path.expanduser(case_report or package), "case report")
        if not report.lower().endswith((".pdf", ".txt")):
            raise ValueError("of several inputs the first must be a PDF or TXT report")
        sources, mode = files_.resolve_all([package, *(inputs or [])] if case_report else inputs), "explicit_report"
        found = files_.scan(spark, sources) if sources else None
    else:
        sources, mode = [files_.resolve(package)], "package_auto_report"
        found = files_.scan(spark, sources)
        best = files_.best_report(found.select("path", "absolute_path")).select("absolute_path").head(1)
        if not best:
            raise FileNotFoundError("no case report found in the package; name one")
        report = best[0][0]
    first = sources[0].original_path if sources else report
    stem = spark.range(1).select(files_.safe_stem(F.lit(first))).first()[0]
    empty = spark.createDataFrame([], "source string, root string, path string, absolute_path string, content binary")
    found = found if found is not None else empty
    return Plan(mode, report, sources, found, files_.images(found), stem)


def read_pictures(images: DataFrame, edge: Edge) -> DataFrame:
    """image_id, platform, content (tagged text), widths (of its screens), status, reason of routed images; an error marks its
    picture only. Blocks are in coordinates of their screen at twice its size, and so are widths."""

    def run(frames):
        reader = edge.reader()
        for frame in frames:
            rows = []
            for image, platform, content in frame.itertuples(index=False):
                try:
                    profile, found, widths = PROFILES[platform], [], []
                    picture, lines = reader.decode(content), reader.lines(content)
                    for x, y, w, h in [s.box for s in splitting.screens(picture, edge.grid, edge.layout, profile.geometric)]:
                        inside = [b for b in lines if 2 * x <= b.x + b.w / 2 < 2 * (x + w) and 2 * y <= b.y + b.h / 2 < 2 * (y + h)]
                        own = picture[y : y + h, x : x + w]
                        found.append([(_pos(b, own, profile), b) for b in (b._replace(x=b.x - 2 * x, y=b.y - 2 * y) for b in inside)])
                        widths.append(2 * w)
                    rows.append((image, platform, perception.tagged(found), widths, "ok", ""))
                except Exception as e:  # one bad picture must not end the run
                    rows.append((image, platform, "", [], "failed", str(e)))
            yield pd.DataFrame(rows, columns=["image_id", "platform", "content", "widths", "status", "reason"])

    return images.select("image_id", "platform", "content").mapInPandas(run, "image_id string, platform string, content string, widths array<int>, status string, reason string")


ANSWER = "image_id string, screen_idx int, content string, error string"


def ask_about(rows: DataFrame, edge: Edge, question: Callable[[dict], str]) -> DataFrame:
    """image_id, screen_idx, content, error: a question for each row (with picture and whatever the question uses); an error
    leaves content null.

    Callers filter first: a model runs on the rows given here and no others."""

    def run(frames):
        model = edge.model()
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                try:
                    out.append((r["image_id"], r["screen_idx"], perception.ask_with_image(model, question(r), r["picture"]), None))
                except Exception as e:  # one screen's failure must not end the run
                    out.append((r["image_id"], r["screen_idx"], None, str(e)))
            yield pd.DataFrame(out, columns=["image_id", "screen_idx", "content", "error"])

    return rows.mapInPandas(run, ANSWER)


def _candidates(answers: DataFrame, candidate: str) -> DataFrame:
    """side_csv_text of the answers that came."""
    return answers.filter("content is not null").select(*SCREEN, F.lit(candidate).alias("candidate"), "content")


def with_dates(known: screens.Screens, pictures: DataFrame, edge: Edge) -> screens.Screens:
    """The dates of screens that show none, by a model; an answer that isn't one counts as none."""
    read = F.regexp_extract("content", r"^\s*(\d{2}/\d{2}/20\d{2})\s*$", 1)
    asked = ask_about(known.context.filter("visible_date = ''").select(*SCREEN).join(pictures, "image_id"), edge, lambda r: questions.date_question())
    seen = cut(asked.select(*SCREEN, F.coalesce(read, F.lit("")).alias("_date")))
    dated = known.context.join(seen, list(SCREEN), "left").withColumn("visible_date", F.coalesce(F.nullif("visible_date", F.lit("")), "_date", F.lit(""))).drop("_date")
    return known._replace(context=dated)


def model_maps(known: screens.Screens, people: DataFrame, pictures: DataFrame, edge: Edge) -> DataFrame:
    """image_id, left_name, right_name, error: by a model, of images without a name or number that tells the sides."""
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda p: p["name"]), "\n").alias("names")
    sides_ = sidemap.evidence(known.blocks).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("side", "phones", "texts"))).alias("sides"))
    missing = sides_.join(sidemap.side_map(known.blocks, people), "image_id", "left_anti")
    # One report's people: a single row.
    rows = missing.crossJoin(F.broadcast(people.agg(names))).join(pictures, "image_id").withColumn("screen_idx", F.lit(0))

    def question(r: dict) -> str:
        shown = "\n".join(questions.sides_evidence(s["side"], list(s["phones"]), list(s["texts"])) for s in r["sides"])
        return questions.sides_question(shown, r["names"].split("\n"))

    def run(frames):
        for frame in frames:
            out = []
            for image, content, error in frame.itertuples(index=False):
                try:
                    left, right = questions.sides_answer(content) if error is None else (None, None)
                except (ValueError, AttributeError) as e:
                    left, right, error = None, None, f"sides not known: {e}"
                out.append((image, left, right, error))
            yield pd.DataFrame(out, columns=["image_id", "left_name", "right_name", "error"])

    return ask_about(rows, edge, question).select("image_id", "content", "error").mapInPandas(run, "image_id string, left_name string, right_name string, error string")


def seen_platform(images: DataFrame, edge: Edge) -> DataFrame:
    """image_id, seen: what a model takes each picture for; an error counts as unknown."""

    def run(frames):
        model = edge.model()
        for frame in frames:
            out = []
            for image, content in frame.itertuples(index=False):
                try:
                    out.append((image, questions.platform_answer(model.ask(questions.platform_question(), content))))
                except Exception as e:  # one picture's failure must not end the run
                    print(f"[WARN] not classified: {image}: {e}")
                    out.append((image, "unknown"))
            yield pd.DataFrame(out, columns=["image_id", "seen"])

    return images.select("image_id", "content").mapInPandas(run, "image_id string, seen string")


def _listed(known: screens.Screens, profile) -> DataFrame:
    """Each screen with what a question tells of it: its date, times and bubbles."""
    own = known.bubbles.filter(F.col("kind") == ("geom" if profile.geometric else "timed"))
    context = known.context.withColumn("expected", F.size("geometric" if profile.geometric else "timed"))
    return context.join(bubbles.hints(own), list(SCREEN), "left").select(*SCREEN, F.coalesce("hints", F.lit("")).alias("hints"), "allowed", "visible_date", "expected")


def _told(r: dict) -> tuple:
    return r["hints"], list(r["allowed"]), r["visible_date"] or ""


def first_looks(known: screens.Screens, pictures: DataFrame, profile, edge: Edge) -> DataFrame:
    """image_id, screen_idx, content, error: a draft of each screen."""
    return ask_about(_listed(known, profile).join(pictures, "image_id"), edge, lambda r: questions.draft_question(r["image_id"], r["screen_idx"], *_told(r)))


def second_looks(known: screens.Screens, drafts: DataFrame, pictures: DataFrame, profile, edge: Edge, polish: bool) -> DataFrame:
    """drafts with a repair for each screen that needs one and, with polish, a polished text for each screen with rows."""
    normal = cut(sides.normalized(drafts, known.context, profile).filter("message <> ''"))
    listed = _listed(known, profile)
    needs = candidates.needing_repair(normal, drafts.select(*SCREEN).join(listed, list(SCREEN)).select(*SCREEN, "expected"))
    shown = side_csv.write(normal).select(*SCREEN, F.col("content").alias("draft"))
    rows = needs.join(listed, list(SCREEN)).join(shown, list(SCREEN), "left").join(pictures, "image_id")
    # Asked once, and kept: what chooses between the texts reads them again.
    out = drafts.unionByName(cut(_candidates(ask_about(rows, edge, lambda r: questions.repair_question(r["image_id"], r["screen_idx"], r["draft"] or "", *_told(r))), "repair")))
    if polish:
        chosen = candidates.choose(side_csv.write(sides.normalized(out, known.context, profile)), known.context, profile.additive, profile.geometric)
        rows = chosen.filter(F.length("content") > len('"Time","Side","Message"\n')).join(pictures, "image_id")
        out = out.unionByName(cut(_candidates(ask_about(rows, edge, lambda r: questions.polish_question(r["image_id"], r["screen_idx"], r["content"])), "polish")))
    return out


def _pos(b: perception.Block, picture: np.ndarray, profile) -> str:
    """A block's side in its screen: a date or time in the middle, the colour of outgoing bubbles, else where it begins."""
    width = 2 * picture.shape[1]
    if plain.is_date_or_time(b.text):
        if 0.25 * width <= b.x + b.w / 2 <= 0.75 * width:
            return "CENTER"
    elif profile.purple_right_from is not None and splitting.purple_ratio(picture, (b.x // 2, b.y // 2, b.w // 2, b.h // 2)) >= profile.purple_right_from:
        return "RIGHT"
    return "RIGHT" if b.x >= width * profile.right_from else "LEFT"


def run(spark: SparkSession, package: str, output: str, inputs: list[str] | None = None, case_report: str | None = None, edge: Edge | None = None, classify: str = "auto", force: str = "auto", keep_duplicates: bool = False, omit_emojis: bool = True, polish: bool = True, report_reader: perception.ReportReader | None = None, settings: dict | None = None) -> int:
    """Runs a package; returns 0, or 2 for bad input, 3 without pictures, 4 without rows. 3 and 4 still write a manifest."""
    edge = edge or Edge()
    try:
        plan = resolve(spark, package, inputs, case_report)
    except (FileNotFoundError, ValueError) as e:
        print(f"[ERROR] {e}")
        return BAD_INPUT
    csv_path = os.path.join(output, "merged", f"{plan.stem}_transcript.csv")
    record = lambda n, items: manifest.write(os.path.join(output, "merged", f"{plan.stem}_manifest.json"), plan.mode, plan.report, csv_path, n, settings or {}, plan.sources, items, files_.inventory(plan.files, plan.report))
    if not plan.images.limit(1).count():
        record(0, spark.createDataFrame([], SCHEMAS["item_status"]))
        return NO_IMAGES
    report = _report(spark, plan, report_reader)
    named = plan.images.withColumn("image_id", F.col("absolute_path"))
    by_path = named.withColumn("_path", routing.by_path(F.col("absolute_path")))
    # A model is asked only where the path doesn't tell, or never.
    asked = by_path.filter("_path = 'unknown'" if classify == "auto" else F.lit(classify == "vision")) if force == "auto" else by_path.limit(0)
    seen = cut(seen_platform(asked, edge))
    routed = routing.routed(by_path.join(seen, "image_id", "left").withColumn("platform", routing.platform(F.col("absolute_path"), F.col("seen"), classify, force)).drop("_path", "seen"))
    stem = files_.safe_stem(F.col("absolute_path"))
    same = Window.partitionBy(F.lower("_stem")).orderBy("image_order")
    stems = routed.select("image_id", "image_order", stem.alias("_stem")).withColumn("_k", F.row_number().over(same))
    stems = stems.select("image_id", "image_order", F.when(F.col("_k") == 1, F.col("_stem")).otherwise(F.format_string("%s_%03d", "_stem", "_k")).alias("stem"))
    # Models are asked once: what they gave is kept for the steps that follow.
    read = cut(read_pictures(routed.filter("status = 'ok'"), edge))
    people = cut(sidemap.participants(report))
    parts, errors = [], []
    for name, profile in PROFILES.items():
        own = read.filter((F.col("platform") == name) & (F.col("status") == "ok"))
        pictures = own.select("image_id").join(plan.images.select(F.col("absolute_path").alias("image_id"), F.col("content").alias("picture")), "image_id")
        widths = own.select("image_id", F.posexplode("widths").alias("k", "width")).select("image_id", (F.col("k") + 1).alias("screen_idx"), "width")
        known = screens.evidence(own.select("image_id", "content"), report, profile, widths=widths)
        known = known._replace(blocks=cut(known.blocks), bubbles=cut(known.bubbles), context=cut(known.context))  # each is read by several steps
        if profile.asks_date:
            known = with_dates(known, pictures, edge)
        drafts, maps = cut(first_looks(known, pictures, profile, edge)), cut(model_maps(known, people, pictures, edge))
        errors += [drafts.filter("error is not null").select("image_id", "error"), maps.filter("error is not null").select("image_id", "error")]
        whole = drafts.join(drafts.filter("error is not null").select("image_id"), "image_id", "left_anti")
        texts = second_looks(known, _candidates(whole, "draft"), pictures, profile, edge, polish)
        parts.append(screens.named(known, report, texts, profile, people, maps.filter("error is null").drop("error"), omit_emojis))
    rows = reduce(DataFrame.unionByName, parts).join(stems, "image_id")
    chat = cut(rows.select("image_order", "image_id", "stem", "row_no", "time_text", "sender", "receiver", "message"))
    merged = transcript.merge(chat.drop("stem"), keep_duplicates, ("image_order", "image_id", "row_no"))
    own_csv = os.path.join(output, "images")
    per = chat.groupBy("image_id").agg(F.count("*").cast("int").alias("rows"), F.concat(F.lit(own_csv + "/stem="), F.first("stem")).alias("csv"))
    failed = reduce(DataFrame.unionByName, errors).groupBy("image_id").agg(F.min("error").alias("_error"))
    done = read.select("image_id", F.col("status").alias("_status"), F.col("reason").alias("_reason"))
    status = F.when(F.col("_error").isNotNull(), "failed").otherwise(F.coalesce("_status", "status"))
    every = routed.drop("content").join(done, "image_id", "left").join(failed, "image_id", "left").join(per, "image_id", "left")
    items = every.select(F.col("image_id").alias("image"), "platform", F.coalesce("csv", F.lit("")).alias("csv"), F.lit("").alias("debug_dir"), status.alias("status"), F.coalesce("_error", "_reason", "reason").alias("reason"), F.coalesce("rows", F.lit(0)).alias("rows"))
    n = chat.count()
    if n:
        transcripts.write_images(chat, own_csv)
        n = transcripts.write(merged, csv_path)
    record(n, items)
    return OK if n else NO_ROWS


def _report(spark: SparkSession, plan: Plan, reader: perception.ReportReader | None) -> DataFrame:
    inside = plan.files.filter(F.col("absolute_path") == plan.report).select("content").head(1)
    content = bytes(inside[0][0]) if inside else open(plan.report, "rb").read()
    row = spark.createDataFrame([(plan.report, content)], "report_id string, content binary")
    if plan.report.lower().endswith(".pdf") and reader is not None:
        return spark.createDataFrame([(plan.report, reader.text(content))], SCHEMAS["report"])
    return row.select("report_id", files_.report_text(F.col("content"), F.col("report_id")).alias("text"))


__all__ = ["Edge", "Plan", "ask_about", "first_looks", "model_maps", "read_pictures", "resolve", "run", "second_looks", "seen_platform", "with_dates"]
