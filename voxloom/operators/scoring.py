"""Word and character error rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators.joins import RESERVED
from voxloom.session import spread_if_few_files

COUNTS = ["word_edits", "word_total", "char_edits", "char_total"]


def score_rows(
    df: DataFrame, reference: str = "reference", prediction: str = "prediction", beyond: int | None = None
) -> DataFrame:
    """Add edit and unit counts per row; a null text counts as empty.

    Where transcripts are hours long, ``beyond`` (some 2,000) names the number of words or
    characters from which pairs are compared in Python, in a fraction of the time.
    """
    normalized = spread_if_few_files(df).withColumns(
        {"ref_norm": T.normalize(F.col(reference)), "hyp_norm": T.normalize(F.col(prediction))}
    )
    ref, hyp = F.col("ref_norm"), F.col("hyp_norm")
    edits = {"word_edits": T.word_edits(ref, hyp), "char_edits": T.char_edits(ref, hyp)}
    if beyond is not None:
        normalized, edits = _with_far_edits(normalized, edits, beyond)
    return normalized.withColumns(
        {
            "word_edits": edits["word_edits"],
            "word_total": T.word_count(ref),
            "char_edits": edits["char_edits"],
            "char_total": T.char_count(ref),
        }
    ).drop("ref_norm", "hyp_norm", _TEXTS, _EDITS)


_TEXTS, _EDITS = f"{RESERVED}texts", f"{RESERVED}far"


def _with_far_edits(normalized: DataFrame, edits: dict[str, Column], beyond: int) -> tuple[DataFrame, dict[str, Column]]:
    """The edits, of pairs with a side of more than ``beyond`` words or characters by a function of their own."""
    ref, hyp = F.col("ref_norm"), F.col("hyp_norm")
    many = F.greatest(T.word_count(ref), T.word_count(hyp)) > beyond
    wide = F.greatest(T.char_count(ref), T.char_count(hyp)) > beyond
    spelt = T.word_symbols(ref, hyp)
    texts = F.struct(
        F.when(many, spelt["ref"]).alias("words_ref"), F.when(many, spelt["hyp"]).alias("words_hyp"),
        F.when(wide, T.characters(ref)).alias("chars_ref"), F.when(wide, T.characters(hyp)).alias("chars_hyp"),
    )
    # One-element explodes keep the Python function apart from the expressions around it.
    staged = normalized.select("*", F.explode(F.array(texts)).alias(_TEXTS))
    far = F.struct(*(
        T.far_edits(F.col(f"{_TEXTS}.{kind}_ref"), F.col(f"{_TEXTS}.{kind}_hyp")).alias(kind) for kind in ("words", "chars")
    ))
    staged = staged.select("*", F.explode(F.array(far)).alias(_EDITS))
    return staged, {
        "word_edits": F.when(many, F.col(f"{_EDITS}.words")).otherwise(edits["word_edits"]),
        "char_edits": F.when(wide, F.col(f"{_EDITS}.chars")).otherwise(edits["char_edits"]),
    }


def error_rate(edits: Column, units: Column) -> Column:
    """Edits per reference unit; NaN when there are no units."""
    return F.when(F.coalesce(units, F.lit(0)) == 0, F.lit(float("nan"))).otherwise(
        F.try_divide(edits.cast("double"), units.cast("double"))
    )


def score_totals(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sums of the counts, per group or overall."""
    return scored.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("num_samples"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS],
    )


def with_rates(totals: DataFrame) -> DataFrame:
    """Corpus-level rates: a ratio of sums, not a mean of ratios."""
    return totals.withColumns(
        {
            "wer": error_rate(F.col("word_edits"), F.col("word_total")),
            "cer": error_rate(F.col("char_edits"), F.col("char_total")),
        }
    )


def corpus_rates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return with_rates(score_totals(score_rows(df), keys))


def run_summary(
    predictions: DataFrame, dataset: str, language_hint: str | None = None
) -> DataFrame:
    """One row of metrics per (config, split, model) of scored predictions."""
    rates = corpus_rates(predictions, ["config", "split", "model_card"])
    return rates.select(
        F.lit(dataset).alias("dataset"),
        "config",
        "split",
        "num_samples",
        "model_card",
        F.lit(language_hint).cast("string").alias("omni_lang"),
        "wer",
        "cer",
    )


def pair_by_id(references: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every reference with the prediction of its id, null where there is none.

    Ids have to be unique on both sides; a repeated one is an error.
    """
    for name, side in (("references", references), ("predictions", predictions)):
        twice = side.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").take(3)
        if twice:
            raise ValueError(f"repeated ids in the {name}: {[row.id for row in twice]}")
    return references.join(predictions.select("id", "prediction"), "id", "left")
