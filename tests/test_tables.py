"""Text scans and sinks over small files."""

import json

import pytest
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.operators import submission as B
from voxloom.sinks import writers as W
from voxloom.sources import tables as D


def test_log_tolerates_bad_lines(spark, tmp_path):
    lines = [
        json.dumps({"Step": 10, "CTC Loss": 0.5, "Extra": [1]}),
        "not json",
        "",
        "12",
        json.dumps({"Step": "20", "CTC Loss": "0.7"}),
        json.dumps({"Step": 30, "Word Error Rate (WER)": 12.5}),
        '{"Step": 40, "CTC Loss": NaN}',
    ]
    path = tmp_path / "valid.jsonl"
    path.write_text("\n".join(lines))
    rows = D.read_log(spark, str(path)).orderBy("line_order").collect()
    assert [(r["Step"], r["CTC Loss"]) for r in rows] == [
        ("10", "0.5"),
        ("20", "0.7"),
        ("30", None),
        ("40", "NaN"),
    ]
    assert rows[2][C.LOG_WER] == "12.5"
    assert D.read_log(spark, str(tmp_path / "absent.jsonl")).count() == 0


def test_submission_round_trip(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('ID,Target\n b ,old\na,\n"  ",x\nNA,"say ""hi"", ok"\nb,\n')
    table = D.read_submission(spark, str(source))
    assert [r.Target for r in table.orderBy("row_order").collect()] == ["old", "", "x", 'say "hi", ok', ""]
    ids = B.unique_ids(table).orderBy("first_row").collect()
    assert [r.sample_id for r in ids] == ["b", "a", "NA"]
    predictions = spark.createDataFrame(
        [("b", "nuevo"), ("a", None)], "sample_id string, prediction string"
    )
    filled = B.fill_targets(table, predictions)
    out = str(tmp_path / "out")
    W.write_filled(filled.drop("filled"), out, str(source))
    again = D.read_submission(spark, out).orderBy("row_order").collect()
    assert [(r.ID, r.Target) for r in again] == [
        (" b ", "nuevo"),
        ("a", ""),
        ("  ", "x"),
        ("NA", 'say "hi", ok'),
        ("b", "nuevo"),
    ]
    with pytest.raises(ValueError, match="overlaps"):
        W.write_filled(filled, str(source), str(source))
    index = spark.createDataFrame([("b", "/x/b.wav")], "stem string, path string")
    matched = B.match_audio(B.unique_ids(table), index).withColumn("decoded", F.lit(True))
    report = B.fill_report(filled, matched).first()
    assert tuple(report) == (2, 5, 3, 2, 0)
    assert B.missing_ids(B.unique_ids(table), index).count() == 2


def test_submission_without_target_or_id(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID\nx\n")
    assert D.read_submission(spark, str(tmp_path / "a.csv")).first().Target == ""
    (tmp_path / "b.csv").write_text("Name\nx\n")
    with pytest.raises(ValueError, match="ID"):
        D.read_submission(spark, str(tmp_path / "b.csv"))


def test_audio_index(spark, tmp_path):
    for name in ("b.wav", "a.wav", "c.mp3", "d.e.wav"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.wav").write_bytes(b"x")
    index = {r.stem: r.path for r in D.read_audio_index(spark, str(tmp_path)).collect()}
    assert index == {s: f"{tmp_path}/{s}.wav" for s in ("a", "b", "d.e")}


def test_predictions_keep_nulls_and_unicode(spark, tmp_path):
    rows = spark.createDataFrame([("é\n😀", None)], "prediction string, error string")
    W.write_json(rows, str(tmp_path / "p"))
    text = "".join(f.read_text() for f in (tmp_path / "p").glob("part-*"))
    assert json.loads(text) == {"prediction": "é\n😀", "error": None}
    assert "é" in text


def test_evaluation_split_names(spark):
    rows = spark.createDataFrame(
        [("lug_asr", "test", 1), ("lug_asr", "train", 2), ("x", "test", 3)],
        "config string, split string, n int",
    )
    assert [r.n for r in D.evaluation_split(rows, language=" LUG ").collect()] == [1]
    assert [r.n for r in D.evaluation_split(rows, config="x").collect()] == [3]
    with pytest.raises(ValueError):
        D.evaluation_split(rows)


def test_joined_parts_are_one_csv(spark, tmp_path):
    values = ["a", "", None, 'say "x"', "two\nlines", " b ", "c,d", "é"]
    rows = [(k, f"id {k}", values[k % len(values)]) for k in range(1000)]
    df = spark.createDataFrame(rows, f"{D.ROW_ORDER} long, ID string, `Target, now` string").repartition(7)
    one, parts, joined = (str(tmp_path / n) for n in ("one", "parts", "joined"))
    W.write_filled(df.coalesce(1), one, "/elsewhere")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_filled(df, parts, "/elsewhere")
        W.write_filled(df, joined, "/elsewhere", joined=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = lambda path: [p.read_bytes() for p in sorted((tmp_path / path).glob("part-*"))]
    assert len(text("joined")) > 2
    got = b"".join(text("joined"))
    header = b'ID,"Target, now"\n'
    assert got.startswith(header) and got.count(header) == 1
    # Spark writes a header to each part; without those the bytes are the same.
    assert got == header + b"".join(p.removeprefix(header) for p in text("parts"))
    assert header + b"".join(p.removeprefix(header) for p in text("one")) == got
    W.write_filled(df.limit(0), joined, "/elsewhere", joined=True)
    assert b"".join(text("joined")) == header
