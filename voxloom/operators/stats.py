"""Hours, group counts, sampling weights and length limits of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.parsing import fixed_decimals
from voxloom.operators.joins import RESERVED
from voxloom.session import as_lookup, cut_lineage
from voxloom.sources.corpus import PARTITION_KEYS
from voxloom.sources.tables import require_columns


def hours(df: DataFrame, keys: list[str] = PARTITION_KEYS) -> DataFrame:
    """Hours of audio per group from 16 kHz sample counts.

    Null sizes add nothing to the hours and are counted in ``null_sizes``.
    """
    require_columns(df, "audio_size", *keys)
    samples = F.coalesce(F.sum("audio_size"), F.lit(0)).cast("double")
    return df.groupBy(*keys).agg(
        (samples / F.lit(float(C.SAMPLE_RATE)) / F.lit(3600.0)).alias("hours"),
        F.count_if(F.col("audio_size").isNull()).alias("null_sizes"),
    )


def distribution(group_hours: DataFrame, dataset: str, path: str) -> DataFrame:
    """The distribution table: hours as text with six decimals."""
    return group_hours.select(
        F.lit(dataset).alias("dataset"),
        "split",
        "language",
        "corpus",
        fixed_decimals(F.col("hours"), 6).alias("hours"),
        F.lit(path).alias("path"),
    ).orderBy("corpus", "split", "language")


def train_groups(df: DataFrame) -> DataFrame:
    """Distinct corpora and languages in training, and the exponents they imply."""
    groups = df.where(F.col("split") == "train").select("corpus", "language").distinct()
    return groups.agg(
        F.count_distinct("corpus").alias("corpora"),
        F.count_distinct("language").alias("languages"),
    ).select(
        "corpora",
        "languages",
        sampling_beta(F.col("corpora")).alias("beta_corpus"),
        sampling_beta(F.col("languages")).alias("beta_language"),
    )


def sampling_beta(groups: Column) -> Column:
    return F.when(groups > 1, C.SAMPLING_BETA).otherwise(0.0)


def valid_split(df: DataFrame) -> DataFrame:
    """The validation split by priority, or the default when there is none."""
    priority = F.lit(None).cast("int")
    for rank, name in reversed(list(enumerate(C.VALID_SPLIT_PRIORITY))):
        priority = F.when(F.col("split") == name, rank).otherwise(priority)
    named = df.select("split").distinct().select("split", priority.alias("rank")).dropna()
    best = F.min_by("split", "rank")
    return named.agg(F.coalesce(best, F.lit(C.DEFAULT_VALID_SPLIT)).alias("valid_split"))


def mixture_weights(
    group_hours: DataFrame,
    beta_corpus: float = C.SAMPLING_BETA,
    beta_language: float = C.SAMPLING_BETA,
) -> DataFrame:
    """Sampling weight of each (corpus, language) with tempered shares.

    A corpus gets its hours to the power ``beta_corpus`` over the sum of those
    powers, and each language its share inside the corpus likewise. A zero
    exponent is uniform. All steps run on one row per group.
    """
    languages = group_hours.groupBy("corpus", "language").agg(F.sum("hours").alias("hours"))
    corpora = languages.groupBy("corpus").agg(
        F.sum("hours").alias("corpus_hours"),
        F.sum(F.pow("hours", F.lit(beta_language))).alias("language_total"),
    )
    corpora = corpora.withColumn("corpus_power", F.pow("corpus_hours", F.lit(beta_corpus)))
    total = corpora.agg(F.sum("corpus_power").alias("total")).scalar()
    share = F.col("corpus_power") / total
    inside = F.pow("hours", F.lit(beta_language)) / F.col("language_total")
    return languages.join(corpora, "corpus").select(
        "corpus",
        "language",
        "hours",
        share.alias("corpus_weight"),
        inside.alias("language_weight"),
        (share * inside).alias("weight"),
    )


def length_status(
    size: Column, minimum: int = C.MIN_AUDIO_SAMPLES, maximum: int = C.MAX_AUDIO_SAMPLES["ctc"]
) -> Column:
    """'short', 'long', 'ok' (limits included) or 'unknown' for a null size."""
    return (
        F.when(size.isNull(), "unknown")
        .when(size < minimum, "short")
        .when(size > maximum, "long")
        .otherwise("ok")
    )


def within_length(df: DataFrame, model_kind: str = "ctc") -> DataFrame:
    """Rows whose sample count fits the limits of a model kind."""
    return df.where(
        F.col("audio_size").between(C.MIN_AUDIO_SAMPLES, C.MAX_AUDIO_SAMPLES[model_kind])
    )


def plan_batches(
    df: DataFrame,
    row_id: list[str],
    size: str = "audio_size",
    budget: int = C.MAX_AUDIO_SAMPLES["ctc"],
    rows_per_shard: int = 100_000,
) -> DataFrame:
    """Number the ``batch`` of each row, so that no batch's padded size exceeds ``budget``.

    A row of n samples may share a batch with rows of at most n samples up to
    ``budget // n`` of them, its ``capacity``. Rows are lined up by capacity, the longest
    first, and a batch takes as many as the capacity of its first: where a capacity ends,
    its last batch is filled from the next. So all batches but the last are full. What
    a capacity leaves open is carried by a scan over the capacities, of which there are at
    most twice the root of ``budget``. Places within a capacity are counted in shards by
    a hash of the unique ``row_id``, whose number follows the row count, so no window
    group grows with the data even if all rows have one size. Rows above the budget get
    no batch.
    """
    spark = df.sparkSession
    shards = max(1, -(-df.count() // rows_per_shard))
    digest = F.md5(F.concat_ws("\0", *[F.col(name).cast("string") for name in row_id]))
    shard = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % shards
    capacity = F.floor(F.try_divide(F.lit(float(budget)), F.greatest(F.col(size), F.lit(1)))).cast("bigint")
    placed = df.withColumns({_SHARD: shard, "capacity": capacity})

    cells = placed.where("capacity > 0").groupBy("capacity", _SHARD).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("capacity").orderBy(_SHARD).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint")))
    cells = cut_lineage(spark, cells, "batch-cells")
    lined = cells.groupBy("capacity").agg(F.sum("rows").alias("rows"))
    lined = lined.agg(F.sort_array(F.collect_list(F.struct("capacity", "rows"))).alias("all"))
    carried = lined.select(F.inline(F.aggregate("all", F.expr(_NO_RUNS), _next_run)["runs"]))
    places = as_lookup(cells.drop("rows").join(F.broadcast(carried), "capacity"), "batch-places")
    places = places.select("capacity", _SHARD, F.struct("start", "carry", "first").alias(_PLACE))
    place = F.col(_PLACE)
    order = Window.partitionBy(_SHARD, "capacity").orderBy(size, *row_id)
    joined = placed.withColumn(_LOCAL, F.row_number().over(order) - 1)
    joined = joined.join(places, ["capacity", _SHARD], "left")
    at = place["start"] + F.col(_LOCAL) - place["carry"]
    number = F.when(at < 0, place["first"] - 1).otherwise(
        place["first"] + F.call_function("div", at, F.nullif("capacity", F.lit(0)))
    )
    return joined.withColumn("batch", number).drop(_SHARD, _PLACE, _LOCAL)


_SHARD, _PLACE, _LOCAL = f"{RESERVED}shard", f"{RESERVED}place", f"{RESERVED}local"
_NO_RUNS = """named_struct('carry', 0L, 'first', 0L,
    'runs', cast(array() as array<struct<capacity: bigint, carry: bigint, first: bigint>>))"""


def _next_run(state: Column, run: Column) -> Column:
    """The rows of one capacity after those before: what they fill up, and the batches that they begin."""
    left = F.greatest(run["rows"] - state["carry"], F.lit(0))
    begun = F.call_function("div", left + run["capacity"] - 1, run["capacity"])
    carry = F.greatest(state["carry"] - run["rows"], begun * run["capacity"] - left)
    here = F.struct(run["capacity"].alias("capacity"), state["carry"].alias("carry"), state["first"].alias("first"))
    return F.struct(
        carry.alias("carry"), (state["first"] + begun).alias("first"),
        F.concat(state["runs"], F.array(here)).alias("runs"),
    )


def batch_padding(planned: DataFrame, size: str = "audio_size") -> DataFrame:
    """One row: batches, rows in them, their samples, and the samples that padding adds."""
    each = planned.where("batch is not null").groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).alias("samples"),
        (F.count(F.lit(1)) * F.max(size) - F.sum(size)).alias("padding"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return each.agg(F.count(F.lit(1)).alias("batches"), total("rows"), total("samples"), total("padding"))
