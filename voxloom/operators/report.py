"""Training-metric tables as Markdown rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.parsing import fixed_decimals
from voxloom.session import as_lookup
from voxloom.sources.corpus import union_all

# (log field, decimals) in column order; None keeps the text as logged.
VALID_COLUMNS = [(C.LOG_STEP, None), (C.LOG_LOSS, 4), (C.LOG_WER, 2), (C.LOG_UER, 2)]
TRAIN_COLUMNS = [
    (C.LOG_STEP, None),
    (C.LOG_LOSS, 4),
    (C.LOG_UER, 2),
    (C.LOG_WER, 2),
    (C.LOG_LR, 8),
]
VALID_HEADING = ["Step", "CTC Loss", "WER", "UER"]
TRAIN_HEADING = ["Step", "CTC Loss", "UER", "WER", "Learning Rate"]


def metric_cells(log: DataFrame, columns: list) -> DataFrame:
    """The log's fields as shown text: fixed decimals, blank for null."""
    shown = [_cell(name, decimals).alias(name) for name, decimals in columns]
    return log.select("run", "line_order", *shown)


def metric_lines(log: DataFrame, columns: list) -> DataFrame:
    """One Markdown row per log line."""
    cells = metric_cells(log, columns)
    parts = [F.col(f"`{name}`") for name, _ in columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    return cells.select("run", "line_order", line.alias("line"))


def empty_line(columns: list) -> str:
    """The row that stands for a log without lines."""
    return "| " + " | ".join(["n/a"] * len(columns)) + " |"


def valid_lines(runs: DataFrame, log: DataFrame) -> DataFrame:
    """Validation rows of every run, with the n/a row where a run logged nothing."""
    names = as_lookup(runs.select("run").distinct())
    lines = metric_lines(log, VALID_COLUMNS).join(names, "run", "left_semi")
    silent = names.join(log.select("run").distinct(), "run", "left_anti")
    missing = silent.withColumn("line", F.lit(empty_line(VALID_COLUMNS)))
    return lines.unionByName(missing, allowMissingColumns=True)


def summary_lines(best: DataFrame) -> DataFrame:
    """The heading lines about the chosen checkpoint of each run."""
    by_valid = F.col("eval_loss").isNotNull()
    by_train = F.col("train_loss").isNotNull()
    loss = (
        F.when(by_valid, _said("Best validation CTC Loss: ", fixed_decimals(F.col("eval_loss"), 4)))
        .when(by_train, _said("Best train CTC Loss: ", fixed_decimals(F.col("train_loss"), 4)))
        .otherwise("CTC Loss: n/a")
    )
    disabled = F.lit("Validation metrics: n/a (validation disabled)")
    wer = _said("Best validation WER: ", fixed_decimals(F.col("wer")))
    uer = _said("Best validation UER: ", fixed_decimals(F.col("uer")))
    lines = F.concat(
        F.array(
            _said("Best checkpoint: step_", F.col("step").cast("string")),
            _said("Checkpoint selection source: ", F.col("selection_source")),
            loss,
        ),
        F.when(by_valid, F.array(wer, uer)).otherwise(F.array(disabled)),
    )
    return best.select("run", F.posexplode(lines).alias("position", "line"))


def full_report(best: DataFrame, valid_log: DataFrame, train_log: DataFrame) -> DataFrame:
    """The whole report of each run as lines in (run, section, position, line_order)."""

    def fixed(section: int, lines: list[str]) -> DataFrame:
        texts = F.array(*[F.lit(line) for line in lines])
        rows = best.select("run", F.posexplode(texts).alias("position", "line"))
        return rows.withColumn("section", F.lit(section))

    def logged(section: int, lines: DataFrame) -> DataFrame:
        return lines.withColumns({"section": F.lit(section), "position": F.lit(0)})

    said = summary_lines(best)
    # Each line about the checkpoint is followed by a blank one.
    blank = said.select("run", (2 * F.col("position") + 1).alias("position"), F.lit("").alias("line"))
    said = said.withColumn("position", 2 * F.col("position")).unionByName(blank)
    summary = said.withColumn("section", F.lit(1))
    train = metric_lines(train_log, TRAIN_COLUMNS).join(
        as_lookup(best.select("run")), "run", "left_semi"
    )
    parts = [
        logged(3, valid_lines(best, valid_log)),
        logged(5, train),
        fixed(0, ["# Fine-tuned model", "", "## Training Summary", ""]),
        summary,
        fixed(2, ["## Validation Metrics", "", *table_heading(VALID_HEADING)]),
        fixed(4, ["", "## Training Metrics", "", *table_heading(TRAIN_HEADING)]),
    ]
    lines = union_all(parts)
    return lines.select("run", "section", "position", "line_order", "line")


REPORT_ORDER = ["run", "section", "position", "line_order"]


def table_heading(names: list[str]) -> list[str]:
    return ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)]


def _cell(name: str, decimals: int | None) -> Column:
    column = F.col(f"`{name}`")
    return F.coalesce(column, F.lit("")) if decimals is None else fixed_decimals(column, decimals)


def _said(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value)
