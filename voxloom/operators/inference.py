"""Batch inference with a recognizer supplied by the caller."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import constants as C

# Takes the inputs of one batch and the language hints (or None), returns one text each.
Predictor = Callable[[list, list | None], list]


def transcribe(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    audio: str,
    batch_size: int = C.BATCH_SIZE,
    language_hint: str | None = None,
    only: str | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``prediction`` and ``error``; the ``audio`` column is used up.

    ``make_predictor`` runs once per Python worker, at the first row that is recognized
    there; the worker keeps its predictor for all tasks of this call and lets go of that
    of the call before. No other step runs in these workers, so an executor holds a
    predictor for each task that it runs at once. ``profile`` asks for the resources of
    the stage, such as a GPU a task and the memory of a model. Rows are
    recognized where they are read; ``spark.sql.files.maxPartitionBytes`` sets how many
    tasks that makes, and a caller with few small files deals the rows out beforehand.
    Rows stream through in Arrow batches and are predicted ``batch_size`` at a
    time. If a batch fails its rows are tried one by one, and a row that fails
    alone gets no prediction. Rows whose ``only`` flag is false pass unpredicted,
    so one pass over the audio serves results and skip counts.
    """
    kept = [field for field in df.schema.fields if field.name != audio]
    schema = T.StructType(
        [*kept, T.StructField("prediction", T.StringType()), T.StructField("error", T.StringType())]
    )
    names = [field.name for field in kept]
    call = uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = None
        for frame in frames:
            wanted = frame if only is None else frame[frame[only]]
            inputs = wanted[audio].tolist()
            if inputs and predict is None:
                predict = _kept_by_worker(call, make_predictor)
            found: list = []
            for start in range(0, len(inputs), batch_size):
                found += _predict_batch(predict, inputs[start : start + batch_size], language_hint)
            results = pd.DataFrame(
                found, columns=["prediction", "error"], index=wanted.index, dtype=object
            )
            results = results.reindex(frame.index).astype(object)
            yield frame[names].join(results.where(results.notna(), None))

    if only is not None:
        flag = F.coalesce(F.col(only), F.lit(False))
        df = df.withColumns({only: flag, audio: F.when(flag, F.col(audio))})
    with _workers_of_their_own(df.sparkSession):
        return df.mapInPandas(run, schema, profile=profile)


@contextmanager
def _workers_of_their_own(spark: SparkSession) -> Iterator[None]:
    """Functions given to Spark meanwhile share Python workers with no others.

    Spark hands a worker that gets idle to any function of the same environment. One that
    measured audio would recognize in a later task, and in time as many workers would hold
    a predictor as there are Python steps in all tasks at once.
    """
    environment = spark.sparkContext.environment
    environment["VOXLOOM_WORKERS"] = "recognizers"
    try:
        yield
    finally:
        del environment["VOXLOOM_WORKERS"]


def _kept_by_worker(call: str, make_predictor: Callable[[], Predictor]) -> Predictor:
    """The predictor of a call, which a Python worker makes once and keeps from task to task.

    Functions may travel to workers by value, and their globals with them, so it is kept
    in a module that the worker has of its own.
    """
    memory = sys.modules.setdefault("_voxloom_predictors", ModuleType("_voxloom_predictors"))
    if getattr(memory, "call", None) != call:
        # The one before goes first, as two models may not fit.
        memory.call = memory.predict = None
        memory.predict = make_predictor()
        memory.call = call
    return memory.predict


def _predict_batch(predict: Predictor, inputs: list, hint: str | None) -> list[tuple]:
    def attempt(batch: list) -> list[tuple]:
        texts = predict(batch, [hint] * len(batch) if hint else None)
        if len(texts) != len(batch):
            raise ValueError(f"{len(texts)} texts for {len(batch)} inputs")
        return [(str(text), None) for text in texts]

    try:
        return attempt(inputs)
    except Exception:
        results = []
        for item in inputs:
            try:
                results += attempt([item])
            except Exception as error:
                results.append((None, str(error)))
        return results
