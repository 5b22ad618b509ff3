"""Writers that run again, tables laid out anew, saved pages and payloads."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestone.functions import payloads
from lodestone.operators import backfill, offers, pages
from lodestone.sources import readers, sinks
from lodestone.streaming import progress


def parts(folder):
    return "".join(p.read_text(encoding="utf-8") for d in sorted(Path(folder).iterdir()) for p in sorted(d.glob("part-*")))


def test_a_replayed_batch_is_not_appended_twice(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    schema = "name string, note string, tags array<string>"
    rows = spark.createDataFrame([("a", 'say "x"\tnow', ["u"]), (None, "two\nlines", [])], schema)
    rows.coalesce(1).write.json(str(source))
    columns = ["name", "note", "tags"]

    def run(state):
        stream = spark.readStream.schema(schema).json(str(source))
        sinks.appended(stream, out, str(tmp_path / state), columns).trigger(availableNow=True).start().awaitTermination()

    run("state")
    once = parts(out)
    assert once.startswith("﻿sep=\t\nname\tnote\ttags\n") and once.count("sep=") == 1
    assert sorted(map(tuple, sinks.separated(spark, out, columns).collect())) == [("", "two\nlines", "[]"), ("a", 'say "x"\tnow', '["u"]')]
    run("other")  # a state that was lost: batch 0 comes again
    assert parts(out) == once
    spark.createDataFrame([("b", "", None)], schema).coalesce(1).write.mode("append").json(str(source))
    run("state")
    assert parts(out).startswith(once) and parts(out).count("sep=") == 1
    assert sinks.separated(spark, out, columns).count() == 3


def test_a_move_keeps_every_row(spark, tmp_path):
    rows = spark.range(200).selectExpr("id", "concat('level', id % 3) as level", "if(id % 7 = 0, null, 2020 + id % 2) as year")
    target = str(tmp_path / "laid")
    held = backfill.relaid(rows, target, ["level", "year"])
    assert held.count() == 9 and held.where("before <> after").count() == 0
    assert spark.read.parquet(target).count() == 200
    for part in Path(target).glob("level=level1/year=2020/*.parquet"):
        part.unlink()  # as a run leaves it that stopped half-way
    backfill.relaid(rows.where("level = 'level1'"), target, ["level", "year"])
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(200))


def test_a_move_that_loses_rows_is_told(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "'' as level")  # a blank key cannot be told from none in a folder's name
    with pytest.raises(RuntimeError):
        backfill.relaid(rows, str(tmp_path / "x"), ["level"])


def test_a_second_backfill_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(k, f"l{k % 3}", str(k), [{"a": k}]) for k in range(30)]
    spark.createDataFrame(rows, "k long, level string, fee string, meta array<struct<a:long>>").write.partitionBy("level").parquet(path)
    fresh = spark.createDataFrame([(3, "new", []), (6, "6", [{"a": 6}]), (9, "", [{"a": 1}]), (99, "x", [])], "k long, fee string, meta array<struct<a:long>>")
    untouched = {p.name for p in Path(path).glob("level=l1/*.parquet")}

    def run():
        stored = spark.read.parquet(path)
        return backfill.rewrite_changed(spark, path, backfill.backfilled(stored, fresh, "k", ["fee"], ["meta"]), ["level"])

    assert run() == 2
    got = {r.k: (r.fee, [x.a for x in r.meta]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 30 and got[3] == ("new", [3]) and got[6] == ("6", [6]) and got[9] == ("", [1]) and got[4] == ("4", [4])
    assert {p.name for p in Path(path).glob("level=l1/*.parquet")} == untouched
    assert run() == 0


def test_saved_pages_from_the_map_else_the_folder(spark, tmp_path):
    folder = tmp_path / "output"
    (folder / "course_pages").mkdir(parents=True)
    for name in ("a one.html", "b+2.html"):
        (folder / "course_pages" / name).write_text(f'<link rel="canonical" href="https://h/{name[0]}"><p>{name}')
    table = lambda rows: spark.createDataFrame(rows, "course_url string, html_path string, html_file string")
    read = lambda m: sorted((r.course_url, r.html[-6:]) for r in readers.saved_pages(spark, str(folder), m).collect())
    named = table([(" https://x/1 ", "course_pages/a one.html", None), ("https://x/2", "course_pages/gone.html", None), ("https://x/3", " ", "")])
    assert read(named) == [("https://x/1", "e.html")]
    every = [("https://h/a", "e.html"), ("https://h/b", "2.html")]
    assert read(None) == read(table([])) == read(table([("u", "course_pages/gone.html", "")])) == every
    assert read(table([("https://x/2", "", "course_pages/b+2.html")])) == [("https://x/2", "2.html")]
    assert readers.saved_pages(spark, str(tmp_path / "nowhere"), None).count() == 0


def test_states_of_artefacts(spark, tmp_path):
    def put(*names):
        for name in names:
            path = tmp_path / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("" if name.endswith("empty.md") else "x")

    put("u1/output/clean/courses/ug/a.md", "u1/output/extracted/ug/a/output.json", "u1/output/extracted/ug/a/normalized.json")
    put("u2/output/clean/courses/ug/a.md", "u2/output/clean/courses/ug/b.md", "u2/output/extracted/ug/a/output.json")
    put("u3/output/course_pages/a.html", "u4/output/clean/courses/empty.md", "u4/output/x.txt", "u5/output/readme.txt", "u6/none.txt")
    put("u2/output/extracted/extraction_progress.json")
    expected = spark.createDataFrame([(f"u{k}", "download", 2 if k != 1 else 1) for k in (1, 2, 3, 5, 7)], "university string, phase string, n long")
    got = progress.artefact_states(progress.artefacts(spark, str(tmp_path)), expected).collect()
    status = {(r.university, r.phase): r.status for r in got}
    assert [status[f"u{k}", "download"] for k in (1, 2, 3, 4, 5, 7)] == ["done", "done", "in_progress", "missing", "not_started", "not_started"]
    assert [status[f"u{k}", "extract"] for k in (1, 2, 3)] == ["done", "partial", "missing"]
    assert [status[f"u{k}", "normalize"] for k in (1, 2, 5)] == ["done", "not_started", "missing"]
    assert all(r.latest is not None for r in got if r.done)


def test_payloads(spark):
    read = lambda t: pages.required(t, [(r"CGPA\s*([\d.]+)", "BSc", "$1")])
    given = [None, "", "[]", "{}", "null", '"CGPA 3"', "5", "CGPA 2", '{"degree":"bsc"}', [[[[["CGPA 1"]]]]], [{"degree": "HSC", "grade": " "}, [{"DEGREE": "hsc", "Grade": "70%."}], None],
             {"degrees": [], "requirements": ["x"], "degree": "MSc", "grade": "60%"}, {"degrees": "MSc", "description": ["CGPA 3.1", "more"]}]
    df = spark.createDataFrame([(k, g if g is None or isinstance(g, str) else json.dumps(g)) for k, g in enumerate(given)], "k int, p string")
    got = {r.k: [tuple(x) for x in r.r] for r in df.select("k", payloads.payload_requirements(F.col("p"), read).alias("r")).collect()}
    want = {5: [("BSc", "3")], 7: [("BSc", "2")], 9: [("BSc", "1")], 10: [("HSC", "70%")], 11: [("MSc", "60%")], 12: [("BSc", "3.1")]}
    assert got == {k: want.get(k, []) for k in range(len(given))}


def test_offers(spark):
    df = spark.createDataFrame([("AAB", "ABB"), ("BBB", "ACB"), ("abc", "x"), ("", None), ("DDA", "CCB")], "a string, b string")
    assert [r[0] for r in df.select(offers.weaker(F.col("a"), F.col("b"))).collect()] == ["ABB", "BBB", "ABC", None, "ADD"]
    texts = spark.createDataFrame([("AAB – ABB (A-level)",), ("bbc (a-level)",), ("ABB",), (None,)], "t string")
    assert [r[0] for r in texts.select(offers.offer_label(F.col("t"))).collect()] == ["AAB-ABB", "BBC", "", ""]
    phrases = spark.createDataFrame([("An Upper\n Second Class honors degree",), ("2:2 or 2:1",), ("12:1",), (None,)], "t string")
    assert [r[0] for r in phrases.select(offers.class_phrase(F.col("t"))).collect()] == ["upper second class honors", "2:2", "", ""]
