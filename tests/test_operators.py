"""Edge rows of the operators."""

import math
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions import audio as A
from voxloom.functions import parsing as P
from voxloom import session as S
from voxloom.operators import checkpoints as K
from voxloom.operators import evaluation as E
from voxloom.operators import labels as L
from voxloom.operators import report as R
from voxloom.operators import sanitize as Z
from voxloom.operators import scoring as Q
from voxloom.operators import stats as H
from voxloom.operators.inference import transcribe
from voxloom.sources.tables import require_columns
from voxloom.sinks import published
from voxloom.streaming import incremental as I


def test_numeric_minimums(spark):
    rows = [(0.03, 400, "a"), (0.0299, 400, "a"), (1.0, 399, "a"), (None, 400, "a"), (math.nan, 400, "a"), (1.0, None, "a")]
    df = spark.createDataFrame(rows, "duration double, n_samples int, text string")
    assert [r[Z.KEEP] for r in Z.mark_usable(df).collect()] == [True] + [False] * 5
    text_numbers = spark.createDataFrame([("29.9",), ("30",), ("abc",)], "duration_ms string")
    assert [r[Z.KEEP] for r in Z.mark_usable(text_numbers).collect()] == [False, True, False]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Z.mark_usable(text_numbers, strict=True).collect()
    bare = spark.createDataFrame([(1,)], "x int")
    assert Z.sanitize(bare).count() == 1
    every = spark.createDataFrame([("a", " "), ("a", "b")], "text string, sentence string")
    assert Z.sanitize(every).count() == 1


def test_harmonize_takes_the_smallest_label(spark):
    labels = spark.createDataFrame([("xx_Latn",), ("xx_Arab",), ("yy_Latn",)], "language string")
    rows = spark.createDataFrame([("xx",), ("zz",), ("yy_Other",)], "language string")
    got = L.harmonize_language(rows, L.label_lookup(labels)).orderBy("language")
    assert [r.language for r in got.collect()] == ["xx_Arab", "yy_Latn", "zz"]


def test_lookups_beyond_the_broadcast_bounds(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("voxloom.session.within_bounds", lambda table, **bounds: False)
    labels = spark.createDataFrame([("xx_Latn",), ("yy_Latn",)], "language string")
    rows = spark.createDataFrame([("xx",), ("zz",)], "language string")
    got = L.harmonize_language(rows, L.label_lookup(labels)).orderBy("language")
    assert [r.language for r in got.collect()] == ["xx_Latn", "zz"]
    spark.range(300).repartition(5).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p")).select(
        "id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    placed = E.with_position(df, "file", "row").orderBy("file", "row").collect()
    assert [r.position for r in placed] == list(range(300))


def test_lookup_bounds_are_measured(spark):
    table = spark.range(100).select(F.repeat(F.lit("x"), F.lit(1000)).alias("s"), "id")
    assert S.within_bounds(table)
    assert not S.within_bounds(table, max_rows=99)
    assert not S.within_bounds(table, max_bytes=100_000)


def test_companion_corpus_rejects_unknown(spark):
    pairs = spark.createDataFrame([("a", "b")], "corpus string, companion string")
    rows = spark.createDataFrame([("a",), ("c",)], "corpus string")
    with pytest.raises(ValueError, match="'c'"):
        L.companion_corpus(rows, pairs)


def test_number_parsing_and_formatting(spark):
    values = ["7.9", "7", " 1.5 ", "x", None, "NaN", "-Infinity", "0.125", "2.675", "1e-3"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.orderBy("i").select(
        P.lenient_long(F.col("v")).alias("n"), P.fixed_decimals(F.col("v")).alias("s")
    ).collect()
    assert [r.n for r in rows] == [7, 7, 1, None, None, None, None, 0, 2, 0]
    for value, row in zip(values, rows):
        try:
            expected = "" if value is None else f"{float(value):.2f}"
        except ValueError:
            expected = value
        assert row.s == expected, value


def test_join_path(spark):
    cases = {
        ("/a/b", "c.wav"): "/a/b/c.wav",
        ("/a/b", "../c/./d.wav"): "/a/c/d.wav",
        ("/a", "../../../x"): "/x",
        ("/a//b/", "c"): "/a/b/c",
        ("s3a://bucket/a", "../b/c"): "s3a://bucket/b/c",
        ("", "x/..y/.z"): "/x/..y/.z",
    }
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "b string, r string, want string")
    for row in df.select("want", P.join_path(F.col("b"), F.col("r")).alias("got")).collect():
        assert row.got == row.want


def wav(rate=16000, channels=1, bits=16, frames=10, extra=b"", claimed=None, fmt=1):
    data = b"\1" * (frames * channels * bits // 8)
    size = len(data) if claimed is None else claimed
    header = struct.pack("<HHIIHH", fmt, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    return b"RIFF" + struct.pack("<I", 36) + b"WAVEfmt " + struct.pack("<I", 16) + header + extra + b"data" + struct.pack("<I", size) + data


def test_wav_metadata(spark):
    chunk = b"LIST" + struct.pack("<I", 3) + b"abc\0"
    cases = [
        (wav(), (16000, 1, 10)),
        (wav(rate=44100, channels=2, bits=24, frames=7), (44100, 2, 7)),
        (wav(extra=chunk), (16000, 1, 10)),
        (wav(claimed=2**32 - 1), (16000, 1, 10)),
        (wav(claimed=2**32 - 1, extra=chunk), (16000, 1, 10)),
        (wav(fmt=3, bits=32), (16000, 1, 10)),
        (wav(rate=0), (0, 1, 10)),
        (wav(channels=0), None),
        (b"", None),
        (None, None),
        (b"RIFF....WAVE", None),
        (b"\0" * 60, None),
    ]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(cases)], "i int, content binary")
    for row in A.with_audio_metadata(df, F.col("content")).collect():
        want = cases[row.i][1]
        got = (row.wav.sample_rate, row.wav.channels, row.wav.n_samples)
        assert got == want or (want is None and got[2] is None), row.i


def test_duration_limits(spark):
    rows = [(640_000, 16000), (640_001, 16000), (1, 0), (None, 16000), (1, None), (1, -1)]
    df = spark.createDataFrame(rows, "n long, rate long")
    got = [r.status for r in E.with_duration_status(df, F.col("n"), F.col("rate")).collect()]
    assert got == ["ok", "too_long"] + ["decode_failed"] * 4


def test_cap_is_taken_before_the_filter(spark):
    df = spark.createDataFrame([(i, "ok" if i % 2 else "too_long") for i in range(10)], "i int, status string")
    capped = E.scorable(E.cap_samples(df, ["i"], 4))
    assert sorted(r.i for r in capped.collect()) == [1, 3]
    assert E.cap_samples(df, ["i"], None).count() == 10


def test_cap_ties_nulls_and_ends(spark):
    rows = [(k % 7 if k % 5 else None, k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(9)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for limit in (0, 1, 99, 100, 101, 250, 499, 500, 501):
        got = E.cap_samples(df, ["a", "b"], limit).collect()
        assert sorted(got, key=str) == sorted((tuple(r) for r in want[:limit]), key=str)
    assert E.cap_samples(df.limit(0), ["a", "b"], 5).count() == 0


def test_cap_sorts_one_range(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("row"))
        assert E.cap_samples(df, ["row"], 15_000).count() == 15_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_mono_mix(spark):
    frames = np.random.default_rng(3).normal(size=(20, 2)).astype("float32")
    df = spark.createDataFrame([(frames.tolist(),)], "w array<array<float>>")
    got = df.select(A.mono_mix(F.col("w")).alias("m")).first().m
    assert np.allclose(got, frames.mean(axis=1), atol=1e-6)


def test_positions_cover_many_files(spark, tmp_path):
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p")).select(
        "id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    placed = E.with_position(df, "file", "row").orderBy("file", "row").collect()
    assert [r.position for r in placed] == list(range(1000))


def test_prediction_rows_need_a_transcription(spark):
    with pytest.raises(ValueError, match="transcription"):
        E.prediction_rows(spark.range(1), "l", "c", "s", "m")
    with pytest.raises(ValueError, match="audio_size"):
        H.hours(spark.range(1).withColumns({k: F.lit("x") for k in ("corpus", "split", "language")}))
    require_columns(spark.range(1), "id")


def test_error_rates_are_ratios_of_sums(spark):
    rows = [("a b c", "a x c"), ("q", "q"), ("", "extra"), (None, None)]
    df = spark.createDataFrame(rows, "reference string, prediction string")
    rates = Q.corpus_rates(df).first()
    assert (rates.word_edits, rates.word_total, rates.wer) == (2, 4, 0.5)
    empty = spark.createDataFrame([("", "a"), (" ", "")], "reference string, prediction string")
    assert math.isnan(Q.corpus_rates(empty).first().wer)
    assert math.isnan(Q.corpus_rates(empty.limit(0)).first().cer)


def test_transcribe_retries_single_rows(spark):
    def make():
        state = {"calls": 0}

        def predict(batch, hints):
            state["calls"] += 1
            assert hints == ["lug"] * len(batch)
            if len(batch) > 4:
                raise AssertionError("batch too large")
            if any(x == 13 for x in batch):
                raise ValueError("unlucky")
            return [x * 2 for x in batch]

        return predict

    df = spark.range(50).select("id", F.col("id").alias("audio"))
    rows = {r.id: r for r in transcribe(df, make, "audio", 4, "lug").collect()}
    assert len(rows) == 50
    assert (rows[13].prediction, rows[13].error) == (None, "unlucky")
    assert all(r.prediction == str(i * 2) and r.error is None for i, r in rows.items() if i != 13)
    short = transcribe(df, lambda: lambda batch, hints: batch[:1], "audio", 2).collect()
    assert sorted(int(r.prediction) for r in short) == list(range(50))


def test_transcribe_passes_unwanted_rows(spark):
    make = lambda: lambda batch, hints: [x.lower() for x in batch]
    audio = F.concat(F.lit("A"), "id").alias("audio")
    df = spark.range(9).select("id", audio, (F.col("id") % 3 == 0).alias("go"))
    df = df.withColumn("go", F.when(F.col("id") != 8, F.col("go")))
    rows = {r.id: r.prediction for r in transcribe(df, make, "audio", 2, only="go").collect()}
    assert rows == {i: f"a{i}" if i % 3 == 0 else None for i in range(9)}
    none = transcribe(df.withColumn("go", F.lit(False)), make, "audio", only="go").collect()
    assert [r.prediction for r in none] == [None] * 9


LOG = "run string, line_order int, `Step` string, `CTC Loss` string, `Word Error Rate (WER)` string, `Unit Error Rate (UER)` string, `Learning Rate` string"


def logs(spark, rows):
    return spark.createDataFrame([(*r, None, None, None)[:7] if len(r) == 4 else r for r in rows], LOG)


def test_best_checkpoint_fallbacks(spark):
    valid = [
        ("v", 0, "10", "0.5"),
        ("v", 1, "20", "0.5"),
        ("v", 2, "30", "0.1"),  # no checkpoint
        ("v", 3, "40", "NaN"),
        ("t", 0, "x", "0.1"),
        ("t", 1, "10", None),
        ("n", 0, "10", "NaN"),
    ]
    train = [
        ("v", 0, "20", "0.0"),
        ("t", 0, "10", "0.9"),
        ("t", 1, "20", "0.4"),
        ("t", 2, "20", "0.8"),  # the last value counts
        ("t", 3, "30", "0.8"),
        ("l", 0, "999", "0.1"),
    ]
    saved = [("v", 10), ("v", 20), ("v", 40), ("t", 10), ("t", 20), ("t", 30), ("l", 5), ("l", 7), ("n", 10)]
    checkpoints = spark.createDataFrame(saved, "run string, step bigint")
    best = K.best_checkpoint(
        K.parsed_log(logs(spark, valid)), K.parsed_log(logs(spark, train)), checkpoints
    )
    got = {r.run: (r.step, r.eval_loss, r.train_loss, r.selection_source) for r in best.collect()}
    assert got["v"] == (10, 0.5, None, "validation_ctc_loss")
    assert got["t"] == (20, None, 0.8, "train_ctc_loss")
    assert got["l"] == (7, None, None, "latest_step")
    assert got["n"][0] == 10 and math.isnan(got["n"][1])
    with pytest.raises(RuntimeError, match="exactly one"):
        K.require_single_run(checkpoints)
    K.require_single_run(checkpoints.where("run = 'v'"))
    with pytest.raises(RuntimeError):
        K.require_checkpoints(checkpoints.limit(0))


def test_checkpoint_inventory(spark):
    paths = [
        "/o/ws_1/checkpoints/step_100/model/pp_00/tp_00/sdp_00.pt",
        "/o/ws_1/checkpoints/step_x/model/pp_00/tp_00/sdp_00.pt",
        "/o/ws_1/checkpoints/step_200/model/other.pt",
    ]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = K.checkpoint_inventory(files).collect()
    assert [tuple(r) for r in rows] == [("ws_1", 100, "/o/ws_1/checkpoints/step_100")]


def test_report_lines(spark):
    log = logs(spark, [("r", 0, "10", "0.123456", "12.345", None, "1e-05"), ("other", 0, "1", "1")])
    runs = spark.createDataFrame([("r",), ("silent",)], "run string")
    lines = {r.run: r.line for r in R.valid_lines(runs, log).collect()}
    assert lines == {
        "r": f"| 10 | 0.1235 | {12.345:.2f} |  |",
        "silent": "| n/a | n/a | n/a | n/a |",
    }
    train = {r.run: r.line for r in R.metric_lines(log, R.TRAIN_COLUMNS).collect()}
    assert train["r"] == f"| 10 | 0.1235 |  | {12.345:.2f} | 0.00001000 |"
    assert R.table_heading(R.VALID_HEADING) == ["| Step | CTC Loss | WER | UER |", "|---|---|---|---|"]


def test_batches_respect_the_padded_budget(spark):
    rng = np.random.default_rng(5)
    # A third of the rows share one size.
    sizes = [32_000] * 700 + [int(x) for x in rng.integers(1, 1_200_000, 1400)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, audio_size long")
    planned = H.plan_batches(df, ["id"], rows_per_shard=300)
    rows = planned.collect()
    assert len(rows) == len(sizes)
    budget, batches = C.MAX_AUDIO_SAMPLES["ctc"], {}
    for r in rows:
        if r.audio_size > budget:
            assert r.batch is None
        else:
            batches.setdefault(r.batch, []).append(r.audio_size)
    assert sorted(batches) == list(range(len(batches)))
    for number, members in batches.items():
        most = budget // max(members)
        assert len(members) <= most
        # All are full but the last.
        assert len(members) == most or number == len(batches) - 1
    told = H.batch_padding(planned).first()
    assert told.batches == len(batches) and told.samples == sum(map(sum, batches.values()))
    assert told.padding == sum(len(m) * max(m) - sum(m) for m in batches.values())
    one = H.plan_batches(df.where("id < 700"), ["id"], rows_per_shard=50)
    assert one.select("batch").distinct().count() == -(-700 // 30)
    assert H.plan_batches(df.limit(0), ["id"]).count() == 0
    assert tuple(H.batch_padding(H.plan_batches(df.limit(0), ["id"])).first()) == (0, 0, 0, 0)


def test_mixture_weights(spark):
    rows = [("a", "x", 9.0), ("a", "y", 1.0), ("b", "x", 10.0)]
    df = spark.createDataFrame(rows, "corpus string, language string, hours double")
    got = {(r.corpus, r.language): r for r in H.mixture_weights(df).collect()}
    assert got["a", "x"].language_weight == pytest.approx(0.75)
    assert got["a", "x"].corpus_weight == pytest.approx(0.5)
    assert sum(r.weight for r in got.values()) == pytest.approx(1)
    flat = H.mixture_weights(df, 0.0, 0.0).collect()
    assert {round(r.weight, 9) for r in flat} == {0.25, 0.5}


def test_group_counts(spark):
    rows = [("a", "train", "x"), ("a", "valid", "y"), ("a", "dev", "y")]
    df = spark.createDataFrame(rows, "corpus string, split string, language string")
    assert tuple(H.train_groups(df).first()) == (1, 1, 0.0, 0.0)
    assert H.valid_split(df).first().valid_split == "dev"
    assert H.valid_split(df.where("split != 'dev'")).first().valid_split == "valid"
    assert H.valid_split(df.where("split = 'train'")).first().valid_split == "dev"


def test_hours_count_null_sizes(spark):
    df = spark.createDataFrame(
        [("c", "s", "l", 57_600_000), ("c", "s", "l", None)],
        "corpus string, split string, language string, audio_size long",
    )
    row = H.hours(df).first()
    assert (row.hours, row.null_sizes) == (1.0, 1)
    assert H.distribution(H.hours(df), "d", "/p").first().hours == "1.000000"


def test_a_worker_loads_its_predictor_once(spark, tmp_path):
    def make():
        with open(tmp_path / f"{os.getpid()}", "a", encoding="utf-8") as log:
            log.write("loaded\n")
        return lambda batch, hints: [f"{os.getpid()}" for _ in batch]

    rows = spark.range(0, 640, 1, 64).withColumn("audio", F.col("id"))
    heard = transcribe(rows, make, "audio", 4)
    for _ in range(2):
        assert heard.where("prediction is null").count() == 0
    loads = [p.read_text().count("loaded") for p in tmp_path.iterdir()]
    # Far fewer loads than the 128 tasks, and none twice in a worker.
    assert sum(loads) == len(loads) < 64
    # The next call has a predictor of its own.
    other = transcribe(rows, lambda: lambda batch, hints: ["other"] * len(batch), "audio", 4)
    assert {r.prediction for r in other.select("prediction").distinct().collect()} == {"other"}


def test_recognizers_share_no_worker_with_other_steps(spark):
    environment = dict(spark.sparkContext.environment)
    pid = F.pandas_udf(lambda parts: parts * 0 + os.getpid(), "long")
    rows = spark.range(0, 64, 1, 64).withColumn("other", pid("id")).withColumn("audio", F.col("id"))
    rows.write.format("noop").mode("overwrite").save()
    heard = transcribe(rows, lambda: lambda batch, hints: [os.getpid()] * len(batch), "audio")
    # Idle workers are taken in turn: 64 tasks get to each that is free to both steps.
    found = heard.collect()
    assert {int(r.prediction) for r in found}.isdisjoint(r.other for r in found)
    again = rows.select("other").collect()
    assert {int(r.prediction) for r in found}.isdisjoint(r.other for r in again)
    assert spark.sparkContext.environment == environment


def test_a_failed_load_is_tried_again(spark, tmp_path):
    def make():
        raise OSError("no model")

    rows = spark.range(0, 4, 1, 1).withColumn("audio", F.col("id"))
    with pytest.raises(Exception, match="no model"):
        transcribe(rows, make, "audio").collect()
    assert {r.prediction for r in transcribe(rows, lambda: lambda b, h: ["x"] * len(b), "audio").collect()} == {"x"}


def test_stream_counts_skips(spark, tmp_path):
    source, out, state, counts = (str(tmp_path / x) for x in ("in", "out", "state", "counts"))
    kind = "id bigint, audio string, status string"
    rows = [(1, "a", "ok"), (2, "b", "too_long"), (3, None, "decode_failed"), (4, "d", "ok"), (5, "e", None), (6, "f!", "ok")]
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(source)
    stream = I.read_new_files(spark, source, spark.createDataFrame([], kind).schema, 1)

    def make():
        def predict(batch, hints):
            if any(x.endswith("!") for x in batch):
                raise ValueError("loud")
            return [x.upper() for x in batch]

        return predict

    I.append_predictions(stream, make, "audio", out, state, counts=counts).awaitTermination()
    seen = spark.read.schema("status string, samples long").json(counts).groupBy("status").sum("samples").collect()
    assert {r.status: r[1] for r in seen} == {"ok": 3, "too_long": 1, "decode_failed": 1, "unknown": 1}
    written = spark.read.schema("id long, prediction string, error string").json(out)
    assert {(r.id, r.prediction, r.error) for r in written.collect()} == {(1, "A", None), (4, "D", None), (6, None, "loud")}


def test_totals_survive_a_crash_and_a_replay(spark, tmp_path):
    out = str(tmp_path / "totals")
    totals = lambda n: spark.createDataFrame([("a", n)], "role string, num_samples long")
    with pytest.raises(FileNotFoundError):
        I.last_totals(spark, out)
    for number in range(3):
        I.publish_totals(totals(number), number, out)
    assert I.last_totals(spark, out).first().num_samples == 2
    # A batch that is published already changes nothing.
    I.publish_totals(totals(99), 2, out)
    assert I.last_totals(spark, out).first().num_samples == 2
    # One that dies while it writes leaves readers on the batch before.
    broken = totals(3).withColumn("num_samples", F.raise_error(F.lit("crash")).cast("long"))
    with pytest.raises(Exception, match="crash"):
        I.publish_totals(broken, 3, out)
    totals(77).write.mode("overwrite").parquet(published.version_folder(out, "3"))
    assert I.last_totals(spark, out).first().num_samples == 2
    I.publish_totals(totals(3), 3, out)
    assert I.last_totals(spark, out).first().num_samples == 3
    kept = {p.name for p in (tmp_path / "totals" / "_versions").iterdir()}
    assert kept == {"2", "3"}


def test_stream_resumes_without_repeating_files(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "id bigint, audio string, status string"

    def run():
        stream = I.read_new_files(spark, source, spark.createDataFrame([], schema).schema, 1)
        make = lambda: lambda batch, hints: [x.upper() for x in batch]
        I.append_predictions(stream, make, "audio", out, state).awaitTermination()
        return sorted(r.id for r in spark.read.schema("id bigint").json(out).collect())

    spark.createDataFrame([(1, "a", "ok"), (2, "b", "too_long")], schema).write.mode("append").parquet(source)
    assert run() == [1]
    spark.createDataFrame([(3, "c", "ok")], schema).write.mode("append").parquet(source)
    assert run() == [1, 3]
    assert run() == [1, 3]
