"""Files, archives, CSV in and out, and a whole package with stand-ins for what looks at pictures."""

import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadmill import cli
from threadmill.edge import perception, questions, splitting
from threadmill.functions import text
from threadmill.model import PROFILES, SCHEMAS
from threadmill.operators import routing
from threadmill.plans import package
from threadmill.sources import files, side_csv, transcripts
from threadmill.streaming import watch

REPORT = "VICTIM / COMPLAINANT:\nFull Name: Robin Sample\nSuspect 1: Dana Example\n2. BACKGROUND in 2026"


def picture(*lines):
    return "\n".join([json.dumps({"width": 400, "height": 800}), *lines]).encode()


FACEBOOK = picture("60 100 300 40 Dana Example", "280 300 200 36 March 12, 2026", "60 420 420 44 hello are you there", "500 600 200 40 yes I am here now")
VIBER = picture("60 100 300 40 Dana Example", "280 300 200 36 March 13, 2026", "60 420 420 44 good morning to you all", "420 470 80 30 10;15")


class Answers:
    def ask(self, prompt, image=None):
        if prompt == questions.platform_question():
            return '{"platform": "not a chat"}'
        if prompt.startswith("polish") and "facebook" in prompt:
            return 'Time,Side,Message\n"12/03/2026 10:15",LEFT,"Hello, are you there?"\n"12/03/2026 10:16",RIGHT,"yes, I am here now"'
        if prompt.startswith("polish"):
            return "nothing to add"
        if "facebook" in prompt:
            return '```csv\nTime,Side,Message\n"12/03/2026 10:15",LEFT,"hello are you there"\n"12/03/2026 10:16",RIGHT,yes, I am here now\n```'
        return 'Time,Side,Message\n"10:15",RIGHT,"good morning to you all"' if "viber" in prompt else ""


def edge():
    return package.Edge(model=Answers)


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return str(path)


def test_side_csv_texts(spark):
    content = 'Time,Side,Message\n10:15,left,"a ""b"", c"\n10:16,RIGHT,x, y , z\n10:17,UP,no\nshort,row\n10:18,LEFT,"two\nlines"\n,LEFT,no time\n'
    df = spark.createDataFrame([("a", 1, "draft", f"```csv\n{content}```"), ("b", 1, "draft", None)], SCHEMAS["side_csv_text"])
    got = [tuple(r)[3:] for r in side_csv.read(df).orderBy("row_no").collect()]
    assert got == [(0, "10:15", "LEFT", 'a "b", c'), (1, "10:16", "RIGHT", "x, y , z"), (2, "10:18", "LEFT", "two\nlines")]
    assert side_csv.read(df, exact=True).count() == 2 and side_csv.count(content) == 5
    again = side_csv.write(side_csv.read(df)).first().content
    assert again == side_csv.text_of([g[1:] for g in got])


def test_transcripts_in_and_out(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_bytes("﻿Message,Extra,Time,Sender,Receiver\n hi ,x,01/01/2026 10:00,A,B\nno,,,\n\n\"say \"\"x\"\"\",y,01/01/2026 09:00,A,B\n".encode())
    (tmp_path / "in/b.csv").write_bytes(b"Time,Sender\n1,2\n")
    (tmp_path / "in/c.csv").write_bytes("Time,Sender,Receiver,Message\n1,A,B,caf\xe9\n".encode("latin-1"))
    found = transcripts.read(spark.read.format("binaryFile").load(str(tmp_path / "in/*.csv")))
    got = sorted((r.source_row, r.message) for r in found.collect())
    assert got == [(2, "café"), (2, "hi"), (5, 'say "x"')]
    rows = spark.createDataFrame([(1, "t", "A", "B", 'x "y"'), (0, "t", "A", "B", " first ")], "seq long, time_text string, sender string, receiver string, message string")
    assert transcripts.write(rows, str(tmp_path / "out.csv"), mark=True) == 2
    assert (tmp_path / "out.csv").read_bytes() == '﻿"Time","Sender","Receiver","Message"\n"t","A","B"," first "\n"t","A","B","x ""y"""\n'.encode()
    transcripts.write_parts(rows, str(tmp_path / "parts"))
    assert '"t","A","B"," first "' in "".join(p.read_text() for p in (tmp_path / "parts").glob("*.csv"))


def test_archives_and_paths(spark, tmp_path):
    path = archive(tmp_path / "x.zip", {"a/b.png": b"1", "../evil.png": b"2", "__MACOSX/c.png": b"3", "d/": b"", "case report.TXT": b"4"})
    found = files.scan(spark, [files.resolve(path)])
    assert sorted(r.path for r in found.select("path").collect()) == ["a/b.png", "case report.TXT"]
    listed = {r.path: r.status for r in files.inventory(found, None).collect()}
    assert listed == {"a/b.png": "candidate_image", "case report.TXT": "ignored_report_candidate"}
    assert files.unique_stems(["a", "A", "a_002", "b"]) == ["a", "A_002", "a_002_002", "b"]
    stems = spark.createDataFrame([("/x/a  b(1).png",), ("/x/.png",), ("/x/***",)], "p string").select(files.safe_stem(F.col("p"))).collect()
    assert [r[0] for r in stems] == ["a_b_1", ".png", "input"]
    scores = spark.createDataFrame([("Cases_Overview.pdf",), ("a/catalog.txt",), ("unstructured/x.txt",), ("x.png",)], "p string").select(files.report_score(F.col("p"))).collect()
    assert [r[0] for r in scores] == [100 + 60 + 35 + 5, -40 - 3, -13 - 3, -10_000]
    assert files.resolve_all([str(tmp_path / "no*"), str(tmp_path / "nope")]) == []
    with pytest.raises(FileNotFoundError):
        files.resolve(str(tmp_path / "nope"))


def test_decoding(spark):
    d = spark.createDataFrame([(bytearray("﻿é".encode()), "a.txt"), (bytearray(b"\xe9"), "a.txt"), (bytearray(b"x"), "a.pdf")], "c binary, p string")
    assert [r[0] for r in d.select(files.decoded(F.col("c"))).collect()] == ["é", "é", "x"]
    assert [r[0] for r in d.select(files.report_text(F.col("c"), F.col("p"))).collect()] == ["﻿é", "é", ""]
    assert spark.range(1).select(text.report_year(F.lit("since 2019, 2020")), text.report_year(F.lit("long ago"))).first()[:] == (2019, 2026)


def test_platforms(spark):
    names = spark.createDataFrame([(n,) for n in ("FB", "Facebook-Messenger", " viber ", "not a chat", "sms", None)], "n string")
    assert [r[0] for r in names.select(routing.platform_name(F.col("n"))).collect()] == ["facebook", "facebook", "viber", "non_chat", "unknown", "unknown"]
    one = lambda path, seen, **k: spark.range(1).select(routing.platform(F.lit(path), F.lit(seen), **k)).first()[0]
    assert one("/facebook_case/viber.png", "viber") == "facebook"  # the whole path counts
    assert one("/x.png", "viber") == "viber" and one("/x.png", "viber", mode="filename") == "unknown"
    assert one("/viber.png", "fb", mode="vision") == "facebook" and one("/x", None, force="viber") == "viber"


def test_splitting():
    white = np.full((420, 640, 3), 255, np.uint8)
    for x in (0, 320):
        white[10:410, x + 5 : x + 305] = 90
    boxes = lambda found: [s.box for s in found]
    assert boxes(splitting.screens(white)) == [(0, 0, 300, 400), (320, 0, 300, 400)]
    assert boxes(splitting.screens(np.full((50, 40, 3), 255, np.uint8))) == [(0, 0, 40, 50)]
    assert boxes(splitting.screens(white, grid="2x1")) == [(0, 0, 320, 420), (320, 0, 320, 420)]
    assert [b[2:] for b in splitting.layout_boxes(100, 90, [1, 3])] == [(100, 45), (33, 45), (33, 45), (34, 45)]
    dark = np.full((600, 800, 3), 60, np.uint8)
    assert boxes(splitting.screens(dark)) == [(0, 0, 800, 600)]
    assert boxes(splitting.screens(dark, wide=True)) == [(0, 0, 400, 600), (400, 0, 400, 600)]
    assert boxes(splitting.by_shape(dark[:, :500])) == [(0, 0, 500, 600)]
    dark[295:305] = 255
    assert [b[1] for b in boxes(splitting.by_shape(dark))] == [0] * 4 + [300] * 4
    assert boxes(splitting.screens(dark[:290], contours=lambda p: splitting._cut(p, [(0, 0, 9, 9), (9, 0, 9, 9)]))) == [(0, 0, 9, 9), (9, 0, 9, 9)]
    for bad in ("2", "ax2", "0x1"):
        with pytest.raises(ValueError):
            splitting.parse_grid(bad)
    for bad in ("a", "1,0"):
        with pytest.raises(ValueError):
            splitting.parse_layout(bad)
    assert splitting.runs(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 4)]
    purple = np.zeros((60, 60, 3), np.uint8)
    purple[..., 0], purple[..., 2] = 200, 120
    assert splitting.purple_ratio(purple, (20, 20, 10, 10)) == 1.0 and splitting.purple_ratio(white, (20, 20, 10, 10)) == 0.0


def test_asking_falls_back_to_text():
    class Fails:
        def ask(self, prompt, image=None):
            if image:
                raise OSError("no pictures")
            return "text"

    assert perception.ask_with_image(Fails(), "?", b"x") == "text"
    assert perception.StubModel({"a": "1"}).ask("cat") == "1"


def test_package_to_transcript(spark, tmp_path):
    path = archive(tmp_path / "pkg.zip", {"Cases_Overview.txt": REPORT, "facebook/1.png": FACEBOOK, "viber/2.png": VIBER, "other/3.png": FACEBOOK, "viber/bad.png": b"\xff"})
    assert cli.main([path, "-o", str(tmp_path / "out")], spark, edge()) == 0
    got = (tmp_path / "out/merged/pkg_transcript.csv").read_text()
    assert got == (
        '"Time","Sender","Receiver","Message"\n'
        '"12/03/2026 10:15","Dana Example","Robin Sample","Hello, are you there?"\n'
        '"12/03/2026 10:16","Robin Sample","Dana Example","yes, I am here now"\n'
        '"13/03/2026 10:15","Dana Example","Robin Sample","good morning to you all"\n'
    )
    manifest = json.loads((tmp_path / "out/merged/pkg_manifest.json").read_text())
    own = {p.parent.name: p.read_text("utf-8-sig") for p in (tmp_path / "out/images").glob("stem=*/*.txt")}
    assert own == {"stem=1": '"Time","Sender","Receiver","Message"\n' + "".join(x + "\n" for x in got.split("\n")[1:3]), "stem=2": "\n".join([*got.split("\n")[:1], got.split("\n")[3], ""])}
    assert manifest["counts"] == {"files_seen": 5, "candidate_images": 4, "processed_images": 2, "skipped_images": 1, "failed_images": 1} and manifest["rows_merged"] == 3


class Asked(Answers):
    """Knows a date and the sides where nothing on screen tells them; remembers what it was told of a screen."""

    def ask(self, prompt, image=None):
        if prompt == questions.date_question():
            return "14/03/2026"
        if "Who writes on the left" in prompt:
            assert "Known people: Robin Sample, Dana Example." in prompt and "LEFT: numbers" in prompt
            return '{"LEFT": "Dana Example", "RIGHT": "Robin Sample"}' if "hello" in prompt else "who knows"
        if prompt.startswith("transcript"):
            assert "bubble 1" in prompt
            return 'Time,Side,Message\n10:15,LEFT,"hello are you there"\n10:16,LEFT,"mine at last it is"'
        return ""


def test_models_are_asked_for_what_no_picture_shows(spark, tmp_path):
    shown = picture("60 420 420 44 hello are you there", "500 600 200 40 mine at last it is")
    unknown = picture("60 420 420 44 somebody else writes here", "500 600 200 40 and another one replies")
    path = archive(tmp_path / "p.zip", {"Cases_Overview.txt": REPORT, "facebook/1.png": shown, "facebook/a/1.png": unknown})
    assert cli.main([path, "-o", str(tmp_path / "out")], spark, package.Edge(model=Asked)) == 0
    assert (tmp_path / "out/merged/p_transcript.csv").read_text().split("\n")[1:3] == ['"14/03/2026 10:15","Dana Example","Robin Sample","hello are you there"', '"14/03/2026 10:16","Robin Sample","Dana Example","mine at last it is"']
    items = json.loads((tmp_path / "out/merged/p_manifest.json").read_text())["items"]
    assert [(i["status"], i["reason"][:15]) for i in sorted(items, key=lambda i: i["image"])] == [("ok", ""), ("failed", "sides not known")]


def test_sides_of_blocks_in_a_picture():
    picture = np.full((800, 400, 3), 255, np.uint8)
    picture[290:330, 20:120] = (200, 60, 120)  # BGR: a purple bubble on the left
    at = lambda x, y, w, text: package._pos(perception.Block(x, y, w, 40, 1.0, text), picture, PROFILES["viber"])
    assert at(60, 590, 140, "mine all the same") == "RIGHT" and at(60, 1000, 140, "theirs") == "LEFT" and at(500, 1000, 140, "mine") == "RIGHT"
    assert at(300, 590, 200, "March 12, 2026") == "CENTER" and at(20, 590, 80, "10:15") == "LEFT"


def test_package_exit_codes(spark, tmp_path):
    assert cli.main([archive(tmp_path / "noimg.zip", {"report.txt": REPORT}), "-o", str(tmp_path / "a")], spark, edge()) == 3
    assert (tmp_path / "a/merged/noimg_manifest.json").exists()
    assert cli.main([archive(tmp_path / "norows.zip", {"report.txt": REPORT, "viber.png": picture()}), "-o", str(tmp_path / "b")], spark, edge()) == 4
    assert cli.main([archive(tmp_path / "noreport.zip", {"viber.png": VIBER}), "-o", str(tmp_path / "c")], spark, edge()) == 2
    assert cli.main([str(tmp_path / "nothing.zip")], spark, edge()) == 2
    assert cli.main([str(tmp_path), "--grid", "1x1", "--layout", "1"], spark, edge()) == 1


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = [str(tmp_path / n) for n in ("in", "out", "state")]
    for k in range(2):
        (tmp_path / f"in/{k}.csv").write_text(f'Time,Sender,Receiver,Message\n01/01/2026 10:0{k},A,B,"m {k} ,x"\n')
        watch.follow(spark, *paths).awaitTermination(60)
    assert sorted(r.message for r in spark.read.parquet(paths[1]).collect()) == ["m 0, x", "m 1, x"]




def test_answers_are_checked():
    assert [questions.platform_answer(a) for a in ('```json\n{"platform": "Facebook-Messenger"}```', "looks like Viber", "[1]", "")] == ["facebook", "viber", "unknown", "unknown"]
    assert questions.sides_answer('Sure: {"LEFT": "Dana  (x)", "RIGHT": "Robin"}') == ("Dana", "Robin")
    for bad in ('{"LEFT": "", "RIGHT": "a"}', '{"LEFT": "A", "RIGHT": "a"}', "none"):
        with pytest.raises(ValueError):
            questions.sides_answer(bad)
    assert [questions.date_answer(a) for a in (" 12/03/2026\n", "12/3/2026", "NONE")] == ["12/03/2026", "", ""]
    assert "10:15" in questions.repair_question("a", 1, "x", allowed=["10:15"])
