"""Speech-corpus views over the given tables, which hold no audio of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C

ROOT = "/data"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as utterances: source is the corpus, 160 samples per character.

    Some durations are null or NaN, as in damaged metadata.
    """
    docs = table(spark, sf_dir, "documents")
    tenth, fiftieth = F.col("doc_id") % 10, F.col("n_chars") % 50
    size = F.col("n_chars") * 160
    return docs.select(
        "doc_id",
        "text",
        F.col("source").alias("corpus"),
        F.when(tenth < 8, "train").when(tenth == 8, "dev").otherwise("test").alias("split"),
        F.col("lang").alias("language"),
        size.alias("audio_size"),
        size.alias("num_samples"),
        F.when(fiftieth == 7, None)
        .when(fiftieth == 9, float("nan"))
        .otherwise(size / F.lit(float(C.SAMPLE_RATE)))
        .alias("duration"),
    )


def first_corpus(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Documents without a label row (or all), with script-qualified language labels."""
    rows = utterances(spark, sf_dir)
    script = F.when(F.col("corpus") == "src7", "_Arab").otherwise("_Latn")
    spoken = F.when(F.col("language") == "es", "spa_Latn").otherwise(
        F.concat(F.col("language"), script)
    )
    if not whole:
        rows = rows.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return rows.withColumn("language", spoken).withColumn("source", F.lit("first"))


def second_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label row, short language labels, own split names and columns."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = utterances(spark, sf_dir).drop("num_samples").join(labels, "doc_id")
    split = F.when(F.col("split") == "dev", "validation").otherwise(F.col("split"))
    return rows.withColumn("split", split).withColumn("source", F.lit("second"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as reference and the next one as prediction, whole texts."""
    turns = table(spark, sf_dir, "conversations")
    following = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
    )
    return turns.withColumnRenamed("text", "reference").join(following, ["conv_id", "turn"])


def run_logs(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Events, of one type or all, as training-log lines: user is the run, event id the line."""
    events = table(spark, sf_dir, "events")
    events = events if kind is None else events.where(F.col("event_type") == kind)
    step = F.floor(F.col("value")).cast("string")
    return events.select(
        run_name().alias("run"),
        F.col("event_id").alias("line_order"),
        F.when(F.col("event_id") % 11 == 0, F.lit("step?")).otherwise(step).alias(C.LOG_STEP),
        F.when(F.col("event_id") % 13 == 0, None)
        .otherwise(F.col("value").cast("string"))
        .alias(C.LOG_LOSS),
        F.get_json_object("props", "$.k").alias(C.LOG_WER),
        F.when(F.col("event_id") % 7 == 0, None)
        .otherwise(F.get_json_object("props", "$.k"))
        .alias(C.LOG_UER),
        F.lit("0.00001").alias(C.LOG_LR),
    )


def run_name() -> Column:
    """Five runs per user."""
    return F.concat(F.lit("ws_"), "user_id", F.lit("_"), F.col("event_id") % 5)


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as saved checkpoints."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return events.select(
        run_name().alias("run"), F.floor("value").cast("bigint").alias("step")
    )


def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows to fill: the text length is the ID, so IDs repeat; some are blank."""
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(" "), F.col("n_chars").cast("string"), F.lit("\t"))
    return docs.select(
        F.when(F.col("n_chars") % 20 == 0, F.lit("  ")).otherwise(padded).alias("ID"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("source")).alias("Target"),
        F.col("doc_id").alias("row_order"),
    )


def audio_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as audio files named by text length: (path, toxic)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    labels = table(spark, sf_dir, "labels")
    name = F.concat(F.lit(f"{ROOT}/"), "source", F.lit("/"), F.col("n_chars"), F.lit(".wav"))
    return docs.join(labels, "doc_id").select(name.alias("path"), "toxic")


def wav_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as WAV bytes: a header built from the row, the text's bytes as samples.

    Documents of odd length carry an extra chunk before the data chunk, and
    those in Spanish lose their first byte, which makes them unreadable.
    """
    docs = table(spark, sf_dir, "documents")
    body = F.col("text").cast("binary")
    channels = F.col("doc_id") % 2 + 1
    rate = F.when(F.col("lang") == "fr", 8000).otherwise(C.SAMPLE_RATE)

    def le(value: Column, size: int) -> Column:
        digits = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
        return F.unhex(F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in range(size, 0, -1)]))

    def raw(text: str) -> Column:
        return F.lit(text).cast("binary")

    extra = F.when(
        F.col("n_chars") % 2 == 1, F.concat(raw("LIST"), le(F.lit(3), 4), raw("abc"), raw("\0"))
    ).otherwise(raw(""))
    wav = F.concat(
        raw("RIFF"),
        le(F.octet_length(body) + 36, 4),
        raw("WAVE"),
        raw("fmt "),
        le(F.lit(16), 4),
        le(F.lit(1), 2),
        le(channels, 2),
        le(rate, 4),
        le(rate * channels, 4),
        le(channels, 2),
        le(F.lit(8), 2),
        extra,
        raw("data"),
        le(F.octet_length(body), 4),
        body,
    )
    stored = F.when(F.col("lang") == "es", F.substring(wav, F.lit(2), F.octet_length(wav))).otherwise(wav)
    return docs.select("doc_id", "lang", stored.alias("content"))


def _bytes_of(value: Column, size: int, little: bool = True) -> Column:
    """A number as ``size`` bytes."""
    digits = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
    order = range(size, 0, -1) if little else range(1, size + 1)
    return F.unhex(F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in order]))


def container_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as audio files of eight kinds, by ``doc_id``: headers built from the row around its text.

    Every third begins with an ID3 tag; those in Spanish lose their first byte.
    """
    docs = table(spark, sf_dir, "documents")
    body = F.col("text").cast("binary")
    length, n = F.octet_length(body), F.col("n_chars")
    le = lambda value, size: _bytes_of(value if isinstance(value, Column) else F.lit(value), size)
    be = lambda value, size: _bytes_of(value if isinstance(value, Column) else F.lit(value), size, False)
    raw = lambda data: F.lit(data.encode("latin-1"))

    def fmt(tag: int, channels: int, rate: int, block: int, bits: int, *extra: Column) -> Column:
        size = le(16 + (4 if extra else 0), 4)
        return F.concat(raw("fmt "), size, le(tag, 2), le(channels, 2), le(rate, 4), le(rate * block, 4), le(block, 2),
                        le(bits, 2), *extra)

    def page(flag: int, granule: Column, *payload: Column) -> Column:
        # The size of a page's packets is of no use here, so each is said to have one segment.
        return F.concat(raw("OggS\0"), le(flag, 1), granule, le(77, 4), le(0, 4), le(0, 4), le(1, 1), le(30, 1), *payload)

    data = F.concat(raw("data"), le(length, 4), body)
    packed = F.unhex(F.concat(F.lpad(F.hex(F.lit(44100)), 5, "0"), F.lit("2F"), F.lpad(F.hex(n), 9, "0")))
    silent = "FFFB14C4" + "00" * 92
    kinds = {
        "wav_float": F.concat(raw("RIFF"), le(length, 4), raw("WAVE"), raw("LIST"), le(3, 4), raw("abc\0"), fmt(3, 1, 22050, 4, 32), data),
        "wav_adpcm": F.concat(raw("RIFF"), le(length, 4), raw("WAVE"), fmt(0x11, 1, 8000, 256, 4, le(2, 2), le(505, 2)),
                              raw("fact"), le(4, 4), le(n + 1, 4), data),
        "rf64": F.concat(raw("RF64"), le(2**32 - 1, 4), raw("WAVE"), raw("ds64"), le(28, 4), le(length, 8), le(length, 8),
                         le(0, 8), le(0, 4), fmt(1, 2, 16000, 2, 8), raw("data"), le(2**32 - 1, 4), body),
        "flac": F.concat(raw("fLaC"), be(0, 1), be(34, 3), be(4096, 2), be(4096, 2), be(0, 6), packed, raw("\0" * 16), body),
        "ogg": F.concat(page(2, le(0, 8), raw("\1vorbis"), le(0, 4), le(2, 1), le(48000, 4), raw("\0" * 14)), body,
                        page(0, le(n * 100, 8)), page(4, raw("\xff" * 8))),
        "mp3_counted": F.concat(F.unhex(F.lit("FFFB90C4")), raw("\0" * 17), raw("Xing"), be(1, 4), be(n, 4), body),
        "mp3_scanned": F.unhex(F.repeat(F.lit(silent), (n % 50 + 2).cast("int"))),
        "aiff": F.concat(raw("FORM"), be(length, 4), raw("AIFF"), raw("COMM"), be(18, 4), be(1, 2), be(n, 4), be(16, 2),
                         F.unhex(F.lit("400CFA00000000000000")), raw("SSND"), be(length, 4), body),
    }
    chosen = F.coalesce(*[F.when(F.col("doc_id") % len(kinds) == k, c) for k, c in enumerate(kinds.values())])
    tag = F.concat(raw("ID3\4\0\0"), be(0, 2), be(1, 1), be(5, 1), raw("t" * 133))
    tagged = F.when(F.col("doc_id") % 3 == 0, F.concat(tag, chosen)).otherwise(chosen)
    stored = F.when(F.col("lang") == "es", F.substring(tagged, F.lit(2), F.octet_length(tagged))).otherwise(tagged)
    return docs.select("doc_id", "lang", stored.alias("content"))


def audio_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances with a source file and an audio struct whose path is relative or not."""
    return with_audio(utterances(spark, sf_dir)).select("doc_id", "source_file", "audio")


def with_audio(rows: DataFrame) -> DataFrame:
    """Add the source file (eight per partition) and the audio struct."""
    name = F.concat(F.col("doc_id"), F.lit(".wav"))
    path = (
        F.when(F.col("corpus") == "src3", F.concat(F.lit("/elsewhere/"), name))
        .when(F.col("corpus") == "src4", F.lit(" "))
        .when(F.col("corpus") == "src5", None)
        .when(F.col("corpus") == "src6", F.concat(F.lit("clips/../clips/./"), name))
        .otherwise(F.concat(F.lit("clips/"), name))
    )
    keys = F.concat_ws("/", "corpus", "split", "language", F.col("doc_id") % 8)
    audio = F.struct(F.lit(None).cast("binary").alias("bytes"), path.alias("path"))
    return rows.withColumns(
        {"source_file": F.concat(F.lit(f"{ROOT}/"), keys, F.lit(".parquet")), "audio": audio}
    )


def audio_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the labelled documents, beside the corpus, or at the root.

    Good documents lie in their corpus folder, others at the root, and toxic ones
    also in their own language folder.
    """
    rows = utterances(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    tail = F.concat(F.lit("/clips/"), "doc_id", F.lit(".wav"))
    corpus = F.concat(F.lit(f"{ROOT}/"), "corpus")
    own = F.concat(corpus, F.lit("/"), "split", F.lit("/"), "language", tail)
    shared = F.when(F.col("quality") == 1, F.concat(corpus, tail)).otherwise(
        F.concat(F.lit(ROOT), tail)
    )
    places = F.array_compact(F.array(shared, F.when(F.col("toxic") == 1, own)))
    return rows.select(F.explode(places).alias("path"))
