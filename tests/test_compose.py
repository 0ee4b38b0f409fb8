"""Sources, composition and manifest over small directory trees."""

import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from voxloom.operators import manifest as M
from voxloom.plans import compose as P
from voxloom.sinks import published
from voxloom.sinks.writers import read_manifest
from voxloom.sources import corpus as S

AUDIO = pa.struct([("bytes", pa.binary()), ("path", pa.string())])


def put(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    arrays = {k: pa.array(v, AUDIO) if k in ("audio", "speech") else v for k, v in columns.items()}
    pq.write_table(pa.table(arrays), path)


@pytest.fixture
def two_roots(tmp_path):
    first, second = tmp_path / "one", tmp_path / "two"
    for split in ("train", "dev", "test"):
        folder = first / "corpus=alpha" / f"split={split}" / "language=lug_Latn"
        put(folder / "a.parquet", text=["ok", " ", None], duration=[1.0, 1.0, 1.0])
    folder = first / "corpus=alpha" / "split=train" / "language=lug_Latn"
    put(folder / "b.parquet", duration=[0.03, 0.0299, None, math.nan])
    put(folder / "empty.parquet", text=pa.array([], pa.string()))
    put(folder / "bad.parquet", text=["", "\x1f"])
    put(first / "corpus=alpha" / "split=train" / "language=nan" / "a.parquet", text=["x"])
    (folder / "clips").mkdir()
    (folder / "clips" / "in.wav").write_bytes(b"RIFF")
    (first / "top.wav").write_bytes(b"RIFF")
    audio = [
        {"bytes": None, "path": "clips/in.wav"},
        {"bytes": b"x", "path": "./clips/../top.wav"},
        {"bytes": None, "path": "none.wav"},
        {"bytes": None, "path": "/abs/x.wav"},
        {"bytes": None, "path": " "},
        {"bytes": None, "path": None},
        None,
    ]
    put(folder / "paths.parquet", text=list("abcdef") + [""], audio=audio)
    for split in ("train", "test", "validation"):
        for language in ("lug", "xx"):
            put(
                second / "corpus=beta" / f"split={split}" / f"language={language}" / "s.parquet",
                text=["y", "z"],
                language=["other", "other"],
                num_samples=[400, 399],
            )
    return str(first), str(second)


def test_partitioned_scan_keeps_labels_as_text(spark, two_roots):
    frame = S.read_partitioned(spark, two_roots[0])
    assert {"lug_Latn", "nan"} == {r.language for r in frame.select("language").distinct().collect()}


def test_compose_two(spark, two_roots, tmp_path):
    composition = P.compose_two(spark, two_roots[0], "alpha", two_roots[1], "beta")
    out = str(tmp_path / "out")
    P.write_composition(composition, out, list(two_roots))
    manifest = {
        (r.corpus, r.source_split, r.source_language): r for r in read_manifest(spark, out).collect()
    }
    train = manifest["alpha", "train", "lug_Latn"]
    # a: 1 of 3, b: 1 of 4, empty: dropped, bad: dropped, paths: 6 of 7.
    assert (train.parquet_files, train.dropped_files) == (3, 2)
    assert (train.rows_before, train.rows_after, train.dropped_rows) == (16, 8, 8)
    assert train.normalized_audio_paths == 2
    beta = manifest["beta", "validation", "lug"]
    assert (beta.language, beta.destination_split) == ("lug_Latn", "validation")
    assert (beta.rows_before, beta.rows_after) == (2, 1)
    assert manifest["beta", "test", "xx"].language == "xx"
    assert len(manifest) == 10
    M.check_manifest_fields(read_manifest(spark, out))
    with pytest.raises(ValueError, match="stale"):
        M.check_manifest_fields(read_manifest(spark, out).drop("dropped_rows"))

    corpus = S.read_partitioned(spark, out)
    assert corpus.count() == sum(r.rows_after for r in manifest.values())
    splits = {(r.corpus, r.split) for r in corpus.select("corpus", "split").distinct().collect()}
    assert splits == {("alpha", "train"), ("beta", "train"), ("beta", "validation")}
    root = two_roots[0]
    folder = f"{root}/corpus=alpha/split=train/language=lug_Latn"
    paths = {r.text: r.path for r in corpus.where("source_file like '%paths%' or audio is not null").select("text", "audio.path").collect()}
    assert paths["a"] == f"{folder}/clips/in.wav"
    assert paths["b"] == f"{root}/top.wav"
    assert (paths["c"], paths["d"], paths["e"]) == ("none.wav", "/abs/x.wav", " ")


def test_lookup_too_large_to_broadcast_gives_the_same_rows(spark, two_roots, monkeypatch):
    from voxloom.operators import paths

    plain = P.compose_two(spark, two_roots[0], "alpha", two_roots[1], "beta").corpus()
    expected = sorted(map(str, plain.select("text", "audio.path", "source_file").collect()))
    monkeypatch.setattr(paths, "within_bounds", lambda table: False)
    shuffled = P.compose_two(spark, two_roots[0], "alpha", two_roots[1], "beta").corpus()
    assert expected == sorted(map(str, shuffled.select("text", "audio.path", "source_file").collect()))


def test_a_run_that_dies_leaves_the_corpus_before(spark, two_roots, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    roots = list(two_roots)

    def composed():
        return P.compose_two(spark, two_roots[0], "alpha", two_roots[1], "beta")

    def state():
        folder = published.published(spark, out)
        rows = S.read_partitioned(spark, folder).select("text", "corpus", "split", "language").collect()
        return sorted(map(str, rows)), sorted(map(str, read_manifest(spark, folder).collect()))

    P.publish_composition(composed(), out, roots, version="one")
    first = state()
    assert published.current_version(spark, out) == "one" and len(first[0]) == 17
    put(tmp_path / "two" / "corpus=beta" / "split=train" / "language=xx" / "more.parquet", text=["new"])

    def die(*_):
        raise RuntimeError("killed between corpus and manifest")

    with monkeypatch.context() as m:
        m.setattr(P, "write_manifest", die)
        with pytest.raises(RuntimeError, match="killed"):
            P.publish_composition(composed(), out, roots, version="two")
    assert state() == first
    P.publish_composition(composed(), out, roots, version="two")
    second = state()
    assert len(second[0]) == 18 and second != first
    with pytest.raises(ValueError, match="is being read"):
        P.publish_composition(composed(), out, roots, version="two")
    P.publish_composition(composed(), out, roots)
    assert state() == second
    assert published.prune(spark, out) == ["one"] and state() == second
    assert published.published(spark, two_roots[0]) == two_roots[0]


def test_gates(spark, tmp_path, two_roots):
    root = tmp_path / "bad"
    put(root / "corpus=c" / "split=train" / "language=l" / "a.parquet", text=[" "])
    with pytest.raises(ValueError, match="filtered out"):
        P.write_composition(P.compose_roots(spark, [str(root)]), str(tmp_path / "o"), [str(root)])
    with pytest.raises(FileNotFoundError, match="second"):
        P.compose_two(spark, two_roots[0], "alpha", two_roots[1], "gamma")
    with pytest.raises(ValueError, match="overlaps"):
        P.write_composition(P.compose_roots(spark, [str(root)]), str(root / "x"), [str(root)])


def test_compose_roots_merges_validation_names(spark, tmp_path):
    roots = []
    for name, split in (("r1", "valid"), ("r2", "dev"), ("r3", "anything")):
        put(tmp_path / name / "corpus=c" / f"split={split}" / "language=lin" / "a.parquet", text=["t"])
        roots.append(str(tmp_path / name))
    rows = P.compose_roots(spark, roots).manifest().orderBy("source_dataset").collect()
    assert [(r.source_dataset, r.destination_split, r.language) for r in rows] == [
        ("r1", "validation", "lin_Latn"),
        ("r2", "validation", "lin_Latn"),
        ("r3", "train", "lin_Latn"),
    ]


def test_compose_raw_shards(spark, tmp_path):
    base = tmp_path / "hub" / "data" / "ASR" / "lug"
    put(base / "lug-train-00000.parquet", text=["a", ""], lang=["q", "q"])
    put(base / "lug-validation-00001.parquet", text=["b"], split=["zzz"])
    put(base / "lug-unlabeled-00000.parquet", text=["c"])
    put(base / "lug-train-00000-of-00005.parquet", text=["d"])
    (tmp_path / "hub" / "data" / "ASR" / "none").mkdir()
    composition = P.compose_raw(spark, str(tmp_path / "hub"))
    rows = composition.manifest().orderBy("source_split").collect()
    assert [(r.source_split, r.language, r.rows_before, r.rows_after) for r in rows] == [
        ("train", "lug", 2, 1),
        ("validation", "lug", 1, 1),
    ]
    assert {r.text for r in composition.corpus().collect()} == {"a", "b"}
    assert P.S.raw_shard_root(spark, str(base.parent)) == str(base.parent)


def test_inferred_layout(spark):
    paths = [
        "/r/data/ASR/lug/lug-train-0.parquet",
        "/r/asr/lin/shard-x-test.parquet",
        "/r/asr/lin/sub/lin-validation-7.parquet",
        "/r/asr/top-train-0.parquet",
        "/r/data/lug/lug-train-1.parquet",
        "/r/ASR/lug/lug-unlabeled-0.parquet",
    ]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: (r.corpus, r.split, r.language) for r in S.inferred_keys(frame, "/r").collect()}
    assert got == {
        paths[0]: ("ASR", "train", "lug"),
        paths[1]: ("asr", "test", "lin"),
        paths[2]: ("asr", "validation", "lin"),
    }
    hive = frame.union(spark.createDataFrame([("/r/corpus=c/split=s/language=l/f.parquet",)], "path string"))
    assert [tuple(r)[:3] for r in S.inferred_keys(hive, "/r").collect()] == [("c", "s", "l")]


def test_globs_and_odd_file_names(spark, tmp_path):
    put(tmp_path / "ASR" / "lug" / "a b+c%20.parquet", text=["1"])
    put(tmp_path / "TTS" / "lug" / "b.parquet", text=["2"])
    put(tmp_path / "ASR" / "lin" / "c.parquet", text=["3"])
    frame = S.read_globs(spark, str(tmp_path), "ASR/lug/*.parquet; ASR/lin/*")
    assert {r.text for r in frame.collect()} == {"1", "3"}
    seen = {r.p for r in frame.select(S.file_path().alias("p")).collect()}
    listed = {r.path for r in S.file_inventory(spark, f"{tmp_path}/ASR", "*.parquet").collect()}
    assert seen == listed == {f"{tmp_path}/ASR/lug/a b+c%20.parquet", f"{tmp_path}/ASR/lin/c.parquet"}


def test_scans_by_schema_find_odd_file_names(spark, tmp_path):
    folder = tmp_path / "corpus=a" / "split=s x" / "language=l"
    put(folder / "p q%20+{x}[1].parquet", text=["a"])
    put(folder / "plain.parquet", text=["b"], duration=[1.0])
    (scan,) = S.read_by_schema(spark, str(tmp_path))
    assert sorted(scan.frame.drop(S.SCHEMA).columns) == ["corpus", "duration", "language", "source_file", "split", "text"]
    assert list(scan.present) == ["duration"]
    assert {r.text for r in scan.frame.where(scan.present["duration"]).collect()} == {"b"}
    rows = scan.frame.collect()
    assert {(r.text, r.source_file) for r in rows} == {
        ("a", f"{folder}/p q%20+{{x}}[1].parquet"),
        ("b", f"{folder}/plain.parquet"),
    }
