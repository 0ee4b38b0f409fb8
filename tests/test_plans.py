"""The end-to-end plans over small directory trees."""

import json

import pytest

from tests.test_compose import put
from tests.test_operators import wav
from voxloom.plans import distribution as N
from voxloom.plans import evaluate as V
from voxloom.plans import training_runs as K


def seconds(n):
    return wav(rate=100, frames=int(n * 100))


def sizes():
    def predict(batch, hints):
        if any(isinstance(x, dict) and x["path"] == "bad" for x in batch):
            raise ValueError("bad")
        return ["the cat" for _ in batch]

    return predict


@pytest.mark.parametrize("small", [True, False])
def test_evaluate(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(V, "within_bounds", lambda table: False)
    (tmp_path / "clips").mkdir()
    (tmp_path / "clips" / "a.wav").write_bytes(seconds(1))
    audio = [
        {"bytes": seconds(40), "path": None},
        {"bytes": seconds(40.01), "path": None},
        {"bytes": b"junk", "path": None},
        {"bytes": b"", "path": f"{tmp_path}/clips/a.wav"},
        {"bytes": None, "path": f"{tmp_path}/clips/none.wav"},
        {"bytes": seconds(1), "path": "bad"},
        {"bytes": seconds(1), "path": None},
    ]
    texts = ["the cat", "x", "y", "the dog", "z", "lost", "after the cap"]
    put(
        tmp_path / "in" / "config=lug_asr" / "split=test" / "a.parquet",
        transcription=texts,
        audio=audio,
    )
    run = V.Run(sizes, "my card", "LUG", "set", max_samples=6, language_hint=None)
    samples = V.read_samples(spark, str(tmp_path / "in"), run)
    counts = V.evaluate(spark, samples, run, str(tmp_path / "out"), f"{tmp_path}/clips")
    assert {r.status: r.samples for r in counts.collect()} == {
        "ok": 2,
        "too_long": 1,
        "decode_failed": 2,
        "recognition_failed": 1,
    }
    name = "my_card_lug_asr_test"
    errors = spark.read.json(str(tmp_path / "out" / f"{name}.errors.jsonl")).collect()
    assert [r.id for r in errors] == ["5"] and errors[0].error
    strict = V.Run(sizes, "strict", "LUG", "set", max_samples=6, max_failed_share=0.3)
    with pytest.raises(RuntimeError, match="failed on 33.3%"):
        V.evaluate(spark, samples, strict, str(tmp_path / "out"), f"{tmp_path}/clips")
    rows = spark.read.json(str(tmp_path / "out" / f"{name}.jsonl")).orderBy("id").collect()
    assert [(r.id, r.reference, r.prediction) for r in rows] == [
        ("0", "the cat", "the cat"),
        ("3", "the dog", "the cat"),
    ]
    metrics = spark.read.json(str(tmp_path / "out" / f"{name}.metrics.json")).first()
    assert (metrics.num_samples, metrics.wer) == (2, 1 / 4)


@pytest.mark.parametrize("small", [True, False])
def test_fill_submission(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(V, "within_bounds", lambda table: False)
    for name, content in (("x", seconds(1)), ("y", b"junk"), ("unused", seconds(1))):
        (tmp_path / f"{name}.wav").write_bytes(content)
    (tmp_path / "in.csv").write_text("ID,Target\nx,\n y,keep\nz,keep\nx ,old\n")
    report = V.fill_submission(
        spark, str(tmp_path / "in.csv"), str(tmp_path), sizes, str(tmp_path / "out")
    )
    # filled rows, rows, unique IDs, without audio, undecodable
    assert tuple(report.first()) == (2, 4, 3, 1, 1)
    out = spark.read.csv(str(tmp_path / "out"), header=True)
    assert [r.Target for r in out.collect()] == ["the cat", "keep", "keep", "the cat"]


@pytest.fixture
def runs(tmp_path):
    root = tmp_path / "ws_1"
    for step in (10, 20):
        path = root / "checkpoints" / f"step_{step}" / "model/pp_00/tp_00/sdp_00.pt"
        path.parent.mkdir(parents=True)
        path.write_bytes(b"w")
    (root / "metrics").mkdir()
    lines = [
        {"Step": 10, "CTC Loss": 0.7, "Word Error Rate (WER)": 50.0},
        {"Step": 20, "CTC Loss": 0.6, "Unit Error Rate (UER)": 12.125},
        {"Step": 30, "CTC Loss": 0.1},
    ]
    text = "\n".join(map(json.dumps, lines))
    (root / "metrics" / "valid.jsonl").write_text(text)
    (root / "metrics" / "train.jsonl").write_text('{"Step": 10, "Learning Rate": 1e-05}\n')
    return tmp_path


def test_select_and_report(spark, runs):
    out = str(runs / "report")
    best = K.save_report(spark, str(runs), out).first()
    assert (best.run, best.step, best.eval_loss) == ("ws_1", 20, 0.6)
    assert best.path == f"{runs}/ws_1/checkpoints/step_20"
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == [
        "# Fine-tuned model",
        "",
        "## Training Summary",
        "",
        "Best checkpoint: step_20",
        "",
        "Checkpoint selection source: validation_ctc_loss",
        "",
        "Best validation CTC Loss: 0.6000",
        "",
        "Best validation WER: ",
        "",
        f"Best validation UER: {12.125:.2f}",
        "",
        "## Validation Metrics",
        "",
        "| Step | CTC Loss | WER | UER |",
        "|---|---|---|---|",
        "| 10 | 0.7000 | 50.00 |  |",
        f"| 20 | 0.6000 |  | {12.125:.2f} |",
        "| 30 | 0.1000 |  |  |",
        "",
        "## Training Metrics",
        "",
        "| Step | CTC Loss | UER | WER | Learning Rate |",
        "|---|---|---|---|---|",
        "| 10 |  |  |  | 0.00001000 |",
    ]


def test_two_runs_need_the_open_mode(spark, runs):
    path = runs / "ws_2" / "checkpoints" / "step_5" / "model/pp_00/tp_00/sdp_00.pt"
    path.parent.mkdir(parents=True)
    path.write_bytes(b"w")
    with pytest.raises(RuntimeError, match="exactly one"):
        K.select_checkpoints(spark, str(runs))
    rows = {r.run: r.selection_source for r in K.select_checkpoints(spark, str(runs), False).collect()}
    assert rows == {"ws_1": "validation_ctc_loss", "ws_2": "latest_step"}


def test_distribution_of_both_layouts(spark, tmp_path):
    hive = tmp_path / "hive"
    put(hive / "corpus=c" / "split=train" / "language=x" / "a.parquet", audio_size=[57_600_000, 0])
    put(hive / "corpus=d" / "split=valid" / "language=x" / "a.parquet", audio_size=[28_800_000])
    path = N.save_distribution(spark, str(hive))
    rows = spark.read.csv(path, sep="\t", header=True).collect()
    assert [tuple(r) for r in rows] == [
        ("hive", "train", "x", "c", "1.000000", str(hive)),
        ("hive", "valid", "x", "d", "0.500000", str(hive)),
    ]
    settings = N.sampling_settings(spark, str(hive), "some_LLM_1B").first()
    assert tuple(settings) == (1, 1, 0.0, 0.0, "valid", 32_000, 320_000, 320_000)
    raw = tmp_path / "raw" / "data" / "ASR" / "lug"
    put(raw / "lug-train-00000.parquet", audio_size=[57_600_000], language=["zzz"])
    put(raw / "lug-other-00000.parquet", audio_size=[57_600_000])
    rows = N.corpus_distribution(spark, str(tmp_path / "raw")).collect()
    assert [(r.corpus, r.split, r.language, r.hours) for r in rows] == [("ASR", "train", "lug", "1.000000")]
