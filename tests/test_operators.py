"""Block, bubble, side and candidate operators on small tables with hand-derived results."""

import random

import pytest
from pyspark.sql import functions as F

from threadmill.model import FACEBOOK, SCHEMAS, VIBER
from threadmill.operators import blocks, bubbles, candidates, folds, sidemap, sides, transcript
from threadmill.operators.candidates import Bubble
from threadmill.sources import side_csv

OCR = """[SCREEN 1]
[BLOCK 1] [POS=LEFT] [X=40] [Y=120] [W=300] [H=40] Dana Example
[BLOCK 2] [POS=CENTER] [X=280] [Y=300] [W=200] [H=36] [CONF=0.91] March 12, 2026
[BLOCK 3] [POS=LEFT] [X=60] [Y=420] [W=420] [H=44] hello are you
[BLOCK 4] [POS=LEFT] [X=60] [Y=470] [W=200] [H=44] there
not a block
[BLOCK 5] [POS=LEFT] [X=420] [Y=520] [W=80] [H=30] 10;15
[BLOCK 6] [pos=right] [X=500] [Y=600] [W=80] [H=30] no time below
[SCREEN 2]
[BLOCK 1] [POS=LEFT] [X=60] [Y=100] [W=420] [H=44] 09:41
[BLOCK 2] [POS=RIGHT] [X=500] [Y=300] [W=80] [H=30] second screen here
[BLOCK 3] [POS=RIGHT] [X=500] [Y=340] [W=80] [H=30] 99:99
[BLOCK 4] [POS=RIGHT] [X=500] [Y=380] [W=80] [H=30] 11.02"""


@pytest.fixture(scope="module")
def parsed(spark):
    return blocks.parse(spark.createDataFrame([("a", OCR)], SCHEMAS["ocr_text"])).cache()


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_parse(parsed):
    got = rows(parsed.filter("screen_idx = 1"), "block", "pos", "x", "y", "text")
    assert got[0] == (1, "LEFT", 40, 120, "Dana Example") and got[5] == (6, "RIGHT", 500, 600, "no time below") and len(got) == 6
    assert parsed.filter("screen_idx = 2").count() == 4


def test_times_dates_and_timed_bubbles(parsed):
    assert rows(bubbles.allowed_times(parsed), "screen_idx", "hhmm") == [(1, "10:15"), (2, "11:02")]  # the status bar's time is above
    got = rows(bubbles.timed(parsed, FACEBOOK), "screen_idx", "ord", "hhmm", "side", "confidence", "text")
    assert got == [(1, 0, "10:15", "LEFT", 1.0, "hello are you there"), (2, 0, "11:02", "RIGHT", 1.0, "second screen here")]
    dated = parsed.withColumn("y_", F.lit(2026))
    assert rows(blocks.visible_date(dated, FACEBOOK, F.col("y_")), "screen_idx", "visible_date") == [(1, "12/03/2026"), (2, "")]
    assert rows(blocks.carried_date(blocks.visible_date(dated, VIBER, F.col("y_"))), "screen_idx", "visible_date") == [(1, "12/03/2026"), (2, "12/03/2026")]


@pytest.mark.parametrize(("text", "facebook", "viber"), [("May 2026", "20/05/2030", ""), ("Sept 5", "05/09/2030", "05/09/2030"), ("March 45", "", "45/03/2030"), ("Mar 12, 2O26", "12/03/2026", "12/03/2030")])
def test_date_rules_differ(spark, text, facebook, viber):
    b = spark.createDataFrame([("a", 1, 0, 100, text)], "image_id string, screen_idx int, line_no int, y int, text string")
    day = lambda p: blocks.visible_date(b, p, F.lit(2030)).first().visible_date
    assert (day(FACEBOOK), day(VIBER)) == (facebook, viber)


def block(y, text, pos="LEFT", x=40, h=40, n=None):
    return ("a", 1, y if n is None else n, y, pos, x, y, 100, h, text)


def test_geometric_bubbles(spark):
    made = spark.createDataFrame([block(300, "one"), block(342, "two"), block(400, "three"), block(445, "four", "RIGHT"), block(490, "Seen"), block(495, "99:99")], SCHEMAS["ocr_block"])
    # 99:99 is no time of day but has a clock's shape, so it heads the messages and all above it is left out
    assert rows(bubbles.geometric(made, FACEBOOK), "text") == []
    got = rows(bubbles.geometric(made.filter("text <> '99:99'"), FACEBOOK), "ord", "side", "text")
    assert got == [(0, "LEFT", "one two"), (1, "LEFT", "three"), (2, "RIGHT", "four")]


def test_refine_lines(spark):
    made = spark.createDataFrame([block(400, "from an", "LEFT", 100), block(405, "leg", "RIGHT", 500), block(500, "mine", "LEFT", 400), block(505, "10:15", "LEFT", 20)], SCHEMAS["ocr_block"])
    assert rows(blocks.refine(made, FACEBOOK, F.lit(800)), "text", "pos") == [("10:15", "LEFT"), ("from an", "LEFT"), ("leg", "LEFT"), ("mine", "RIGHT")]


def test_crop_order_and_box(spark):
    crops = spark.createDataFrame([("a", 500, 12, 400, 900), ("a", 0, 0, 400, 900), ("a", 0, 950, 400, 900)], "image_id string, x int, y int, w int, h int")
    assert rows(blocks.crop_order(crops), "screen_idx", "x", "y") == [(1, 0, 0), (2, 500, 12), (3, 0, 950)]
    box = spark.range(1).select(blocks.box(F.expr("array(array(3, 4), array(10, 2), array(7, 9))")).alias("b")).first().b
    assert tuple(box) == (3, 2, 7, 7)


def test_participants_and_side_map(spark):
    report = "VICTIM / COMPLAINANT:\nFull Name: Robin Sample (45)\nSuspect 1: Dana Example\n phone +44 20 7946 0000\nSuspect 2: Alex Other\n2. BACKGROUND in 2024"
    people = sidemap.participants(spark.createDataFrame([("r", report)], SCHEMAS["report"]))
    assert rows(people, "ord", "name", "role", "contact_numbers") == [(0, "Robin Sample", "victim", []), (1, "Dana Example", "suspect", ["+44 20 7946 0000"]), (2, "Alex Other", "suspect", [])]
    aliases = sidemap.participants(spark.createDataFrame([("r", "Target/Victim: Kim\nScammer Names Used: Lee, lee (x) and Kim, Moe")], SCHEMAS["report"]))
    assert rows(aliases, "name", "role") == [("Kim", "victim"), ("Lee", "suspect"), ("Moe", "suspect")]
    seen = [("a", 1, 1, 100, "LEFT", "dana example"), ("b", 1, 1, 900, "RIGHT", "call +442079460000"), ("c", 1, 1, 100, "LEFT", "nobody"), ("d", 1, 1, 100, "CENTER", "44 20 7946 0000")]
    b = spark.createDataFrame(seen, "image_id string, screen_idx int, line_no int, y int, pos string, text string")
    assert rows(sidemap.side_map(b, people), "image_id", "left_name", "right_name") == [("a", "Dana Example", "Robin Sample"), ("b", "Robin Sample", "Dana Example"), ("d", "Dana Example", "Robin Sample")]


def test_header_ties_go_to_the_first(spark):
    people = spark.createDataFrame([("r", 0, "Ann", "victim", []), ("r", 1, "Ben", "suspect", [])], SCHEMAS["participant"])
    b = spark.createDataFrame([("a", 1, 1, 50, "LEFT", "Ben and Ann")], "image_id string, screen_idx int, line_no int, y int, pos string, text string")
    assert rows(sidemap.header_match(b, people), "name", "score") == [("Ann", 10)]


def test_fold_compares_with_the_last_kept_row():
    t = "01/02/2026 10:0"
    a, b, c = "please send the money to me today", "please send the money to me today now", "the money to me today now or never again my friend"
    kept = folds.without_repeats([(t + "0", "LEFT", a), (t + "1", "LEFT", b), (t + "2", "LEFT", c)])
    assert [m for *_, m in kept] == [b, c] and kept[0][0] == t + "0"  # better text, earlier time
    assert folds.without_repeats([(t + "0", "LEFT", a), (t + "0", "RIGHT", a), (t + "9", "LEFT", a + ".")]) == [(t + "0", "LEFT", a), (t + "0", "RIGHT", a), (t + "9", "LEFT", a + ".")]
    assert folds.with_joined_lines([(t + "0", "LEFT", "we will go"), (t + "1", "LEFT", "to the bank"), (t + "1", "LEFT", "Done.")]) == [(t + "0", "LEFT", "we will go to the bank Done.")]
    again = folds.postprocessed(kept)
    assert folds.postprocessed(again) == again


def csv_of(*rows):
    return side_csv.text_of(rows)


def normalized(spark, profile, cases):
    """Rows of each case (content, and what is known of its screen: bubbles as side, text, hhmm), all in one run."""
    made, screens, times, texts = [], [], [], []
    for name, (content, known) in cases.items():
        for kind in ("timed", "geom"):
            made += [(name, 1, kind, k, hhmm, side, None, text) for k, (side, text, hhmm) in enumerate(known.get(kind, ()))]
        screens.append((name, 1, known.get("date", "01/02/2026"), 2026))
        times += [(name, 1, h) for h in known.get("allowed", ())]
        texts.append((name, 1, "draft", content))
    frame = spark.createDataFrame
    context = sides.contexts(frame(screens, "image_id string, screen_idx int, visible_date string, default_year int"), frame(made, SCHEMAS["bubble"]), frame(times, SCHEMAS["allowed_time"]))
    out = {name: [] for name in cases}
    for r in sides.normalized(frame(texts, SCHEMAS["side_csv_text"]), context, profile).orderBy("image_id", "row_no").collect():
        out[r.image_id].append((r.time_text, r.side, r.message))
    return out


GAPS = (("LEFT", "Where are you going my friend", None), ("RIGHT", "to the market for bread", None), ("LEFT", "bring some milk as well", None))
AT = "01/02/2026 10:15"


def test_rows_against_bubbles_told_apart_by_gaps(spark):
    rows = csv_of(("10:15", "RIGHT", "where are you going my friend"), ("10:15", "OUTGOING", "to the market for bread"), ("later", "LEFT", "no time"))
    order = (("LEFT", "first of all these", None), ("LEFT", "second of all those", None))
    got = normalized(
        spark,
        FACEBOOK,
        {
            "sides": (rows, {"geom": GAPS, "allowed": ("10:15",)}),
            "merged": (csv_of(("10:15", "LEFT", "where are you going my friend and bring some milk as well")), {"geom": GAPS}),
            "broken": (csv_of(("10:15", "LEFT", "where are you going my friend yoU")), {"geom": GAPS[:1]}),
            "none": (csv_of(("10:15", "LEFT", "Seen")), {"geom": GAPS}),
            "few": (csv_of(("10:15", "LEFT", "we go to town"), ("10:15", "LEFT", "to town"), ("10:15", "RIGHT", "to town"), ("10:15", "LEFT", "we go to town")), {}),
            "again": (rows, {"geom": (*GAPS, ("LEFT", "bring some milk as well please", None))}),
            "unclosed": ('"unclosed', {"geom": GAPS}),
            "empty": ("", {"geom": GAPS}),
            "order": (csv_of(("10:15", "LEFT", "nothing alike"), ("10:15", "LEFT", "second of all those"), ("10:15", "LEFT", "first of all these")), {"geom": order}),
        },
    )
    assert got["sides"] == [(AT, "LEFT", "where are you going my friend"), (AT, "RIGHT", "to the market for bread"), (AT, "LEFT", "bring some milk as well")]
    # Each part takes the side of its row; what no row covers is added and stands where its bubble does.
    assert got["merged"] == [(AT, side, text) for side, text, _ in GAPS]
    # A broken start in lower case is repaired from the bubble that says the same.
    assert got["broken"] == [(AT, "LEFT", "Where are you going my friend")]
    assert got["none"] == got["unclosed"] == got["empty"] == []  # nothing is added to no rows
    assert got["few"] == [(AT, "LEFT", "we go to town"), (AT, "RIGHT", "to town")]
    assert len(got["again"]) == 3  # a bubble that was added covers others like it
    assert [m for *_, m in got["order"]] == ["first of all these", "second of all those", "nothing alike"]


def test_rows_against_bubbles_closed_by_times(spark):
    timed = (("LEFT", "Good morning to you all", "10:15"), ("RIGHT", "and to you my friend", "10:16"))
    both = (("RIGHT", "five six seven eight", "10:15"), ("LEFT", "one two three four", "10:15"))
    same = (("LEFT", "one two three four", "10:15"), ("LEFT", "five six seven eight", "10:15"))
    merged = csv_of(("10:15", "LEFT", "one two three four five six seven eight nine"))
    got = normalized(
        spark,
        VIBER,
        {
            "sides": (csv_of(("10:16", "LEFT", "and to you my friend"), ("10:99", "LEFT", "x y"), ("12:00", "LEFT", "not visible")), {"timed": timed, "allowed": ("10:15", "10:16")}),
            "missing": ("", {"timed": timed}),
            "words": (csv_of(("10:15", "LEFT", "five six seven")), {"timed": both}),
            "merged": (merged, {"timed": same}),
            "undated": (merged, {"timed": same, "date": ""}),
        },
    )
    assert got["sides"] == got["missing"] == [(AT, "LEFT", "Good morning to you all"), ("01/02/2026 10:16", "RIGHT", "and to you my friend")]
    assert got["words"][0][1:] == ("RIGHT", "five six seven")  # of several bubbles at one time the words decide
    assert got["merged"] == [(AT, "LEFT", "one two three four"), (AT, "LEFT", "five six seven eight")]  # the bubbles of its time
    assert got["undated"] == []  # no date, so no full time


def test_candidates():
    g = [Bubble(0, "LEFT", "hello are you there"), Bubble(1, "RIGHT", "yes I am here now")]
    draft, repair = csv_of(("01/02/2026 10:15", "LEFT", "Hello are you there")), csv_of(("01/02/2026 10:15", "LEFT", "Hello are you there"), ("01/02/2026 10:16", "RIGHT", "Yes I am here now"))
    assert candidates.coverage(draft, g) == (1, 2, 0.5) and candidates.coverage(draft, []) == (0, 0, 1.0)
    assert candidates.score(draft, ["10:15"], 2, g) == 2 - 6 - 4 + 35 + 1.5
    assert candidates.score("", [], 0, []) == -10_000
    assert candidates.chosen(draft, repair, ["10:15", "10:16"], 2, g, False) == repair
    assert candidates.chosen(draft, draft, [], 2, g, True) == draft
    assert candidates.additive(draft, repair, [], 2, g) == repair
    polished = candidates.polished_text(csv_of(("x", "LEFT", "Hello, are you there?")), draft)
    assert candidates.polish_chosen(draft, polished, [], 1, []) == polished
    assert candidates.polish_chosen(draft, csv_of(("01/02/2026 10:15", "LEFT", "Something else was said")), [], 1, []) == draft
    assert candidates.polished_text(repair, draft) == ""


@pytest.mark.parametrize(
    ("messages", "expected", "wanted"),
    [
        ([], 0, True),
        (["All is well here."], 0, False),
        (["All is well here."], 2, False),
        (["All is well here."], 3, True),
        (["Come at 10:15 please."], 0, True),
        (["and so it goes"], 0, True),
        (["I said they The end of it all was near to us now and then so we all went out"], 0, True),
        (["All is well here.", "All is well here!"], 0, True),  # a near repeat
        (["All is well here", "and there."], 0, True),  # the rest of the row before
        (["All is well here. " + "Very long it is, " * 14 + "done. We go."], 0, True),
    ],
)
def test_screens_that_need_a_repair(spark, messages, expected, wanted):
    rows = spark.createDataFrame([("a", 1, "draft", k, "01/02/2026 10:15", "LEFT", m) for k, m in enumerate(messages)], SCHEMAS["side_row"])
    screens = spark.createDataFrame([("a", 1, expected)], "image_id string, screen_idx int, expected int")
    assert candidates.needing_repair(rows, screens).count() == wanted


def test_scores_as_a_plan_equal_the_plain_score(spark):
    r = random.Random(3)
    words = "hello are you there and so it goes The end of 10:15 it was".split()
    data = [("a", s, "draft", k, f"01/02/2026 10:{r.randrange(60):02d}", r.choice(["LEFT", "RIGHT"]), " ".join(r.choice(words) for _ in range(r.randrange(1, 9)))) for s in range(12) for k in range(6)]
    made = [("a", s, "geom", k, None, r.choice(["LEFT", "RIGHT"]), None, " ".join(r.choice(words) for _ in range(5))) for s in range(12) for k in range(4)]
    clean = [(*d[:6], m) for d in data if (m := candidates.plain.clean_message(d[6]))]
    got = candidates.scores(spark.createDataFrame(clean, SCHEMAS["side_row"]), spark.createDataFrame(made, SCHEMAS["bubble"]), spark.createDataFrame([("a", s, "10:15") for s in range(12)], SCHEMAS["allowed_time"])).collect()
    for row in got:
        content = side_csv.text_of([d[4:] for d in clean if d[1] == row.screen_idx])
        b = [Bubble(m[3], m[5], m[7]) for m in made if m[1] == row.screen_idx]
        assert row.score == pytest.approx(candidates.score(content, ["10:15"], 4, b))


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_merge_keeps_the_first_whatever_the_partitions(spark, parts):
    data = [(0, "02/01/2026 10:00", "A", "B", "later"), (1, "01/01/2026 10:00", "A", "B", "Hi  there"), (2, "01/01/2026 10:00", "A", "B", "hi there"), (3, "01/01/2026, 10:00", "A", "B", "hi there"), (4, "soon", "A", "B", "when"), (5, "01/01/2026 10:00", "A", "B", " ")]
    d = spark.createDataFrame(data, "seq long, time_text string, sender string, receiver string, message string").repartition(parts)
    got = [tuple(r) for r in transcript.merge(d).orderBy("seq").select("seq", "time_text", "message").collect()]
    assert got == [(0, "01/01/2026 10:00", "Hi there"), (1, "01/01/2026, 10:00", "hi there"), (2, "02/01/2026 10:00", "later"), (3, "soon", "when")]
    assert transcript.merge(d, True).count() == 5
