"""Run a recognizer over an evaluation split and score it; fill a submission table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions import parsing as P
from voxloom.functions.audio import array_metadata, with_audio_metadata, with_file_metadata
from voxloom.operators import evaluation as E
from voxloom.operators import scoring as Q
from voxloom.operators import submission as B
from voxloom.operators.inference import Predictor, transcribe
from voxloom.session import cut_lineage, within_bounds
from voxloom.sinks import writers as W
from voxloom.sources import corpus as S
from voxloom.sources import tables as D

SAMPLE_ORDER = [S.SOURCE_FILE, "source_row"]


@dataclass
class Run:
    """What one evaluation run is called and how it recognizes."""

    make_predictor: Callable[[], Predictor]
    model_card: str
    language: str
    dataset: str
    config: str | None = None
    split: str = "test"
    language_hint: str | None = None
    batch_size: int = C.BATCH_SIZE
    max_samples: int | None = None
    max_seconds: float = C.MAX_AUDIO_SECONDS
    #: The run stops if the recognizer fails on a larger share of the samples it gets.
    max_failed_share: float = 1.0

    @property
    def config_name(self) -> str:
        return self.config or D.evaluation_config(self.language)

    @property
    def output_name(self) -> str:
        return "_".join(P.slug_text(x) for x in (self.model_card, self.config_name, self.split))


def read_samples(spark: SparkSession, root: str, run: Run) -> DataFrame:
    """The samples of the run's split below ``root/config=*/split=*``, in file order."""
    table = S.read_partitioned(spark, root, ["config", "split"])
    table = table.withColumn("source_row", F.col("_metadata.row_index"))
    chosen = D.evaluation_split(table, config=run.config_name, split=run.split)
    return D.require_columns(chosen, "transcription", "audio")


def with_sample_metadata(
    samples: DataFrame, audio_root: str | None = None, opener: Callable = S.open_files
) -> DataFrame:
    """Add the ``wav`` struct of each sample, row by row: of its bytes, else of its path, else of its array.

    Files are named by their paths, relative ones below ``audio_root``; without it none
    is opened. Tasks read the head and tail of the files of their own rows. Audio that is
    an ``array`` with its ``sampling_rate`` or ``sample_rate`` is measured as it is.
    """
    kind, audio = samples.schema["audio"].dataType, F.col("audio")
    array = array_metadata(audio, kind) if "array" in kind.names else None
    if "bytes" not in kind.names:
        return samples.withColumn("wav", array)
    has_bytes = F.coalesce(F.octet_length("audio.bytes") > 0, F.lit(False))
    read = with_audio_metadata(samples, F.when(has_bytes, F.col("audio.bytes")))
    has_path = P.has_text(F.col("audio.path")) if "path" in kind.names else F.lit(False)
    has_path = F.coalesce(has_path, F.lit(False))
    wav = F.when(has_bytes, F.col("wav"))
    if audio_root is not None and "path" in kind.names:
        named = F.col("audio.path")
        named = F.when(P.is_resolvable(named), P.join_path(F.lit(audio_root), named)).otherwise(P.plain_path(named))
        read = with_file_metadata(read, F.when(~has_bytes & has_path, named), opener, "file_wav")
        wav = wav.when(has_path, F.col("file_wav"))
    if array is not None:
        wav = wav.when(~has_path, array)
    return read.withColumn("wav", wav).drop("file_wav")


def wav_table(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, wav) of the WAV files below ``folder``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.wav")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    named = files.select(P.plain_path(F.col("path")).alias("path"), "content")
    return with_audio_metadata(named, F.col("content"))


def opened(paths: DataFrame, opener: Callable = S.open_files) -> DataFrame:
    """Add the ``content`` of each ``path``, which the task that needs it opens."""

    def read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            contents = []
            for uri in part:
                system, path = opener(uri)
                with system.open_input_stream(path, compression=None) as stream:
                    contents.append(stream.read())
            yield pd.Series(contents, dtype=object)

    return paths.withColumn("content", F.pandas_udf(read, "binary")("path"))


def evaluate(
    spark: SparkSession, samples: DataFrame, run: Run, out: str, audio_root: str | None = None
) -> DataFrame:
    """Write predictions, errors and metrics below ``out``; returns the counts by status.

    Samples on which the recognizer fails have a status and an error of their own and
    are not scored. The cap and the positions come before any sample is skipped. Audio is read
    and recognized in one pass, whose results are kept as a table and which counts the statuses.
    """
    D.require_columns(samples, "transcription", "audio")
    if "id" not in samples.columns:
        samples = E.with_position(samples, *SAMPLE_ORDER)
    samples = E.cap_samples(samples, SAMPLE_ORDER, run.max_samples)
    timed = E.with_duration_status(
        with_sample_metadata(samples, audio_root),
        F.col("wav.n_samples"),
        F.col("wav.sample_rate"),
        run.max_seconds,
    )
    heard = transcribe(
        timed.withColumn("scorable", E.is_scorable()).drop("wav", "seconds"),
        run.make_predictor,
        "audio",
        run.batch_size,
        run.language_hint,
        only="scorable",
    )
    failed = E.is_scorable() & F.col("prediction").isNull()
    heard = heard.withColumn(E.STATUS, F.when(failed, E.RECOGNITION_FAILED).otherwise(F.col(E.STATUS)))
    watched, seen = E.watch_statuses(heard)
    heard = cut_lineage(spark, watched, "heard")
    counts = seen.get
    name = run.output_name
    unheard = heard.where(F.col(E.STATUS) == E.RECOGNITION_FAILED)
    sample = F.col("id" if "id" in heard.columns else "position").cast("string")
    W.write_json(unheard.select(sample.alias("id"), "error"), f"{out}/{name}.errors.jsonl")
    failed = counts[E.RECOGNITION_FAILED]
    share = failed / max(1, failed + counts["ok"])
    if share > run.max_failed_share:
        raise RuntimeError(f"the recognizer failed on {share:.1%} of the samples; see {out}/{name}.errors.jsonl")
    rows = E.prediction_rows(
        E.scorable(heard), run.language, run.config_name, run.split, run.model_card
    )
    W.write_json(rows, f"{out}/{name}.jsonl")
    summary = Q.run_summary(rows, run.dataset, run.language_hint)
    W.write_json(summary, f"{out}/{name}.metrics.json")
    return E.counted_statuses(spark, seen)


def fill_submission(
    spark: SparkSession,
    table_path: str,
    audio_folder: str,
    make_predictor: Callable[[], Predictor],
    out: str,
    batch_size: int = C.BATCH_SIZE,
    language_hint: str | None = None,
) -> DataFrame:
    """Transcribe the audio of each ID, write the filled table, return the report.

    IDs are matched with paths. Audio of few IDs is matched to them where it is read;
    that of more is opened in the tasks that recognize it. Either way audio moves once.
    """
    table = D.read_submission(spark, table_path)
    ids = B.unique_ids(table).select(B.CLEAN_ID)
    ids = cut_lineage(spark, ids, "ids")
    stem = P.stem(F.col("path"), "wav")
    # Audio lies directly in the folder, where a stem is unique.
    place = f"{audio_folder.rstrip('/')}/*.wav"
    if within_bounds(ids):
        files = wav_table(spark, place).withColumn(B.CLEAN_ID, stem)
        wanted = files.join(F.broadcast(ids), B.CLEAN_ID)
    else:
        paths = S.file_inventory(spark, audio_folder, "*.wav", depth=0).withColumn(B.CLEAN_ID, stem)
        paths = cut_lineage(spark, paths.join(ids, B.CLEAN_ID).select(B.CLEAN_ID, "path"), "matched")
        wanted = with_audio_metadata(opened(paths), F.col("content"))
    wanted = wanted.withColumn("decoded", F.col("wav.n_samples").isNotNull()).drop("wav")
    heard = transcribe(wanted, make_predictor, "content", batch_size, language_hint, only="decoded")
    heard = cut_lineage(spark, heard, "heard")
    filled = B.fill_targets(table, heard)
    W.write_filled(filled.drop("filled"), out, table_path)
    return B.fill_report(filled, ids.join(heard, B.CLEAN_ID, "left"))
