"""Real directory trees: audio above the leaf, names that clash, files with odd names."""

import json
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_compose import put
from voxloom.operators import evaluation as E
from voxloom.operators import labels as L
from voxloom.operators import paths as R
from voxloom.operators import scoring as Q
from voxloom.plans import catalog
from voxloom.plans import compose as P
from voxloom.plans import training_runs as K
from voxloom.sinks.writers import refuse_overlap
from voxloom.sources import corpus as S
from voxloom.sources import tables as D


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wav(path):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"RIFF")


def test_audio_at_every_level(spark, tmp_path):
    leaf = tmp_path / "corpus=c" / "split=train" / "language=l"
    audio = [{"bytes": None, "path": f"clips/{k}.wav"} for k in range(5)]
    put(leaf / "a.parquet", text=list("abcde"), audio=audio)
    levels = [leaf, leaf.parent, leaf.parent.parent, tmp_path]
    for k, folder in enumerate(levels):
        wav(folder / "clips" / f"{k}.wav")
    assert S.read_any_layout(spark, str(tmp_path)).count() == 5
    rows = P.compose_roots(spark, [str(tmp_path)]).corpus().select("audio.path").collect()
    assert {r.path for r in rows} == {f"{d}/clips/{k}.wav" for k, d in enumerate(levels)} | {"clips/4.wav"}


def test_raw_shards_see_audio_below_the_dataset(spark, tmp_path):
    base = tmp_path / "data" / "ASR" / "lug"
    audio = [{"bytes": None, "path": "audio/x.wav"}, {"bytes": None, "path": "audio/y.wav"}]
    put(base / "lug-train-00000.parquet", text=["a", "b"], audio=audio)
    wav(tmp_path / "audio" / "x.wav")
    wav(tmp_path / "data" / "audio" / "y.wav")
    got = P.compose_raw(spark, str(tmp_path))
    assert {r.path for r in got.corpus().select("audio.path").collect()} == {
        f"{tmp_path}/audio/x.wav", f"{tmp_path}/data/audio/y.wav",
    }
    assert got.manifest().first().normalized_audio_paths == 2


def test_columns_of_the_user_stay(spark, tmp_path):
    mine = {n: ["m"] for n in ("source", "keep", "shard", "base", "label", "path", "folder", "relative", "resolved", "destination_split", "source_dataset", "source_language")}
    for name, splits in (("one", ["train", "dev", "test"]), ("two", ["train", "test", "validation"])):
        for split in splits:
            folder = tmp_path / name / "corpus=c" / f"split={split}" / "language=lug_Latn"
            folder.mkdir(parents=True)
            pq.write_table(pa.table({"text": ["t"], **mine}), folder / "a.parquet")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    for got in (P.compose_two(spark, one, "c", two, "c"), P.compose_roots(spark, [one, two])):
        rows = got.corpus()
        assert set(mine) <= set(rows.columns) and not [c for c in rows.columns if c.startswith("_vx_")]
        assert all(r[n] == "m" for r in rows.collect() for n in mine)
    labelled = spark.createDataFrame([("xx", "a", "b")], "language string, label string, base string")
    lookup = L.label_lookup(spark.createDataFrame([("xx_Latn",)], "language string"))
    assert tuple(L.harmonize_language(labelled, lookup).select("language", "label", "base").first()) == ("xx_Latn", "a", "b")


def test_many_paths_move_no_audio(spark, tmp_path, monkeypatch):
    for k, where in enumerate(["clips", "clips", "mixed"]):
        folder = tmp_path / "corpus=c" / "split=train" / f"language=l{k}"
        audio = [{"bytes": b"x", "path": f"{where}/{k}{i}.wav"} for i in range(3)]
        put(folder / "a.parquet", text=list("abc"), audio=audio)
        for i in range(3):
            wav((folder.parent if where == "mixed" and i == 1 else folder) / where / f"{k}{i}.wav")
    few = P.compose_roots(spark, [str(tmp_path)]).corpus().select("text", "audio.path").collect()
    monkeypatch.setattr(R, "within_bounds", lambda table: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = P.compose_roots(spark, [str(tmp_path)]).corpus()
        many = rows.select("text", "audio.path").collect()
        whole = S.read_partitioned(spark, str(tmp_path))
        lookup = R.path_lookup(whole.where("language <> 'l2'"), S.file_inventory(spark, str(tmp_path)), F.lit(str(tmp_path)))
        assert {r["rank"] for r in lookup.folder_ranks().collect()} == {0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(few) == sorted(many) and all(r.path.startswith("/") for r in many)


def test_cap_moves_keys_only(spark):
    df = spark.range(0, 1000, 1, 6).select(F.col("id").alias("row"), F.lit(b"x").alias("audio"))
    capped = E.cap_samples(df, ["row"], 300)
    assert sorted(r.row for r in capped.collect()) == list(range(300))
    assert capped.rdd.getNumPartitions() == 6 and "Exchange SinglePartition" not in plan_of(capped)
    assert E.cap_samples(df, ["row"], 5000).count() == 1000 and E.cap_samples(df, ["row"], 0).count() == 0


def test_groups_of_schemas(spark, tmp_path):
    for k in range(2):
        folder = tmp_path / "corpus=c" / "split=train" / f"language=l{k}"
        put(folder / "a.parquet", text=["a"], duration=[1.0])
        put(folder / "b [x] %20+.parquet", **({"duration": [2.0]} if k else {"text": ["b"], "duration": [2.0]}))
    (scan,) = S.read_by_schema(spark, str(tmp_path))
    assert list(scan.present) == ["text"]
    assert scan.frame.count() == 4 and scan.frame.where(scan.present["text"]).count() == 3
    files = S.partition_listing(S.file_inventory(spark, str(tmp_path), "*.parquet"))
    places = [r.place for r in S.schema_groups(S.file_schemas(spark, files)).collect()]
    assert len(places) == 3 and sum(p.endswith(".parquet") for p in places) == 2


def test_files_that_disagree_on_types(spark, tmp_path):
    folder = tmp_path / "corpus=c" / "split=train"
    put(folder / "language=a" / "a.parquet", text=["a", " "], duration=[1.0, 1.0])
    put(folder / "language=b" / "b.parquet", text=["b", "c"], duration=pa.array([1, 0], pa.int32()))
    put(folder / "language=b" / "c.parquet", duration=[0.0])
    scans = S.read_by_schema(spark, str(tmp_path))
    assert len(scans) == 3 and sum(s.frame.count() for s in scans) == 5
    manifest = P.compose_roots(spark, [str(tmp_path)]).manifest().orderBy("language").collect()
    assert [(r.rows_before, r.rows_after) for r in manifest] == [(2, 1), (3, 1)]


def test_a_lookup_of_schemas_too_large_to_broadcast(spark, tmp_path, monkeypatch):
    from voxloom import session

    folder = tmp_path / "corpus=c" / "split=train" / "language=l"
    for k in range(9):
        columns = {"text": ["x", " "], "duration": [1.0, 0.0]}
        put(folder / f"{k}.parquet", **{n: v for i, (n, v) in enumerate(columns.items()) if k % 3 != i})
    few = P.compose_roots(spark, [str(tmp_path)]).manifest().collect()
    monkeypatch.setattr(session, "within_bounds", lambda table, **bounds: False)
    assert P.compose_roots(spark, [str(tmp_path)]).manifest().collect() == few
    assert (few[0].rows_before, few[0].rows_after) == (18, 9)


def test_inventory_lists_what_spark_lists(spark, tmp_path):
    names = ["a.wav", "b c%20+.wav", "x/y/z/d.wav", "x/_hidden/e.wav", "_k=1/f.wav", ".g.wav", "x/_h.wav", "é/i.wav", "j.txt", "[k].wav"]
    names += [f"many/{k % 7}/{k}.wav" for k in range(40)]
    for name in names:
        wav(tmp_path / name)
    (tmp_path / "zero.wav").write_bytes(b"")
    (tmp_path / "nothing" / "here").mkdir(parents=True)
    (tmp_path / "link").symlink_to(tmp_path / "x")
    for pattern, depth in (("*", None), ("*.wav", None), ("*.wav", 0), ("*.wav", 1)):
        got = S.file_inventory(spark, str(tmp_path), pattern, depth).collect()
        want = S._listed_by_spark(spark, str(tmp_path), pattern, depth).collect()
        assert sorted(got) == sorted(want) and len(got) == len(set(got)) >= 3
    assert S.file_inventory(spark, f"{tmp_path}/nothing").isEmpty()
    with pytest.raises(FileNotFoundError):
        S.file_inventory(spark, f"{tmp_path}/none")


def test_inventory_by_an_opener_of_another_store(spark, tmp_path):
    wav(tmp_path / "a" / "b.wav")

    def opener(uri):
        from pyarrow import fs

        return fs.SubTreeFileSystem("/", fs.LocalFileSystem()), uri

    got = S.file_inventory(spark, f"file://{tmp_path}", opener=opener).collect()
    assert [(r.path, r.length) for r in got] == [(f"{tmp_path}/a/b.wav", 4)]


def test_a_root_is_listed_once(spark, tmp_path, monkeypatch):
    for split in ("train", "dev", "test", "validation"):
        for name in ("c", "d"):
            put(tmp_path / f"corpus={name}" / f"split={split}" / "language=lug" / "a.parquet", text=["t"])
    calls = []
    inventory = S.file_inventory
    monkeypatch.setattr(S, "file_inventory", lambda *a, **k: calls.append(a[1]) or inventory(*a, **k))
    P.compose_two(spark, str(tmp_path), "c", str(tmp_path), "d")
    assert calls == [str(tmp_path)]


def test_paths_are_qualified(spark, tmp_path):
    assert S.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://other/")
    conf.set("fs.viewfs.mounttable.other.link./data", f"file://{tmp_path}")
    try:
        assert S.qualified(spark, "/data/x") == "viewfs://other/data/x"
    finally:
        conf.set("fs.defaultFS", before)


def test_schemes(spark):
    with pytest.raises(ValueError, match="opener"):
        S.read_by_schema(spark, "odd://x/y")
    assert S.open_files("/a b/c")[1] == S.open_files("file:///a b/c")[1] == "/a b/c"


def test_no_file_lists_on_the_driver():
    for module in (P, S, R):
        text = open(module.__file__, encoding="utf-8").read()
        assert "inputFiles" not in text and "toLocalIterator" not in text


def test_run_folders_with_odd_names(spark, tmp_path):
    for name, weights in (("ws_a b+%", True), ("ws_empty", False)):
        root = tmp_path / name
        (root / "metrics").mkdir(parents=True)
        lines = [{"Step": 10, "CTC Loss": 0.1}, {"Step": 20, "CTC Loss": 0.2}]
        (root / "metrics" / "valid.jsonl").write_text("\n".join(map(json.dumps, lines)))
        for step in (10, 20) if weights else ():
            weights_file = root / "checkpoints" / f"step_{step}" / "model/pp_00/tp_00/sdp_00.pt"
            weights_file.parent.mkdir(parents=True)
            weights_file.write_bytes(b"w")
    best = K.select_checkpoints(spark, str(tmp_path), strict=False).collect()
    assert [(r.run, r.step, r.selection_source) for r in best] == [("ws_a b+%", 10, "validation_ctc_loss")]
    with pytest.raises(RuntimeError, match="exactly one run"):
        K.select_checkpoints(spark, str(tmp_path))


def test_root_text_within_a_path(spark):
    paths = spark.createDataFrame([("/data/ASR/lug/data/lug-train-000.parquet",)], "path string")
    assert tuple(S.inferred_keys(paths, "/data").first())[:3] == ("ASR", "train", "lug")


def test_quoted_line_feeds(spark, tmp_path):
    (tmp_path / "in.csv").write_text('ID,Target\n1,"two\nlines"\n2,x\n')
    assert [(r.ID, r.Target) for r in D.read_submission(spark, str(tmp_path / "in.csv")).collect()] == [("1", "two\nlines"), ("2", "x")]


@pytest.mark.parametrize("source", ["/d/a", "file:///d/a/", "file:/d//a", "/d/b/../a/./"])
def test_overlap(source):
    with pytest.raises(ValueError, match="overlaps"):
        refuse_overlap("file:///d/a/out", [source])
    refuse_overlap("/d/ab", [source])
    refuse_overlap("s3a://b/d/a/out", [source])


def test_pairs(spark):
    refs = spark.createDataFrame([(1, "a"), (2, "b")], "id long, reference string")
    got = Q.pair_by_id(refs, spark.createDataFrame([(1, "x")], "id long, prediction string"))
    assert sorted((r.id, r.prediction) for r in got.collect()) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="repeated ids in the predictions"):
        Q.pair_by_id(refs, spark.createDataFrame([(1, "x"), (1, "y")], "id long, prediction string"))


def test_entries_of_small_folders_go_on_together(tmp_path):
    for k in range(300):
        (tmp_path / f"d{k}").mkdir()
        (tmp_path / f"d{k}" / "f").write_text("x")
    folders = [pd.DataFrame({"path": [f"{tmp_path}/d{k}" for k in part]}) for part in (range(200), range(200, 300))]
    frames = list(S._folder_lister(S.open_files, "*")(iter(folders)))
    assert len(frames) == 1
    assert sorted(frames[0]["path"]) == sorted(f"{tmp_path}/d{k}/f" for k in range(300))


def test_tasks_for_folders(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [S.file_tasks(spark, n) for n in (0, 1, 32)] == [1, 1, 2]
    assert S.file_tasks(spark, 40_000) == 4 * cores
    assert S.file_tasks(spark, 5_000_000) == 1000


def test_run_folders_lie_in_groups(spark, tmp_path, monkeypatch):
    rows = [(k, k % 1500, "view", 1.0, "{}") for k in range(6000)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    assert [tuple(r) for r in catalog.run_folders(spark, f"{tmp_path}/sf").collect()] == [(1500, True)]
    sizes = [len(names) for place, names, _ in os.walk(f"{tmp_path}/runs")]
    assert 1500 < sum(sizes) < 1500 * 2 + 20 and max(sizes) < 1000
