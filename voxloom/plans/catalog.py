"""Every operator as a query over the given tables.

Each function takes (session, table directory) and returns a DataFrame. Queries
about files first write rows of those tables below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions import audio as A
from voxloom.functions import parsing as P
from voxloom.functions import text as T
from voxloom.operators import checkpoints as K
from voxloom.operators import evaluation as E
from voxloom.operators import labels as L
from voxloom.operators import manifest as M
from voxloom.operators import report as R
from voxloom.operators import sanitize as Z
from voxloom.operators import scoring as Q
from voxloom.operators import stats as H
from voxloom.operators import submission as B
from voxloom.operators.inference import transcribe
from voxloom.operators.paths import count_replacements, path_lookup, replace_paths
from voxloom.plans import compose, evaluate
from voxloom.plans import views as V
from voxloom.session import cut_lineage, scratch_path, spread_if_few_files
from voxloom.sinks import writers as W
from voxloom.sinks.published import published
from voxloom.sources import corpus as S
from voxloom.sources import tables as D
from voxloom.streaming import incremental as I

CAP = 120
BATCH_ROWS = 250


# Sanitizing, splits and labels


def sanitize_keep(spark: SparkSession, sf: str) -> DataFrame:
    return Z.mark_usable(V.utterances(spark, sf)).select("doc_id", F.col(Z.KEEP).alias("keep"))


def sanitized_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = Z.sanitize(V.utterances(spark, sf))
    return rows.select("doc_id", "corpus", "split", "language", "audio_size")


def split_map_two(spark: SparkSession, sf: str) -> DataFrame:
    both = S.union_all([V.first_corpus(spark, sf), V.second_corpus(spark, sf)])
    return L.map_two_corpus_splits(both).select("doc_id", "source", "split", "destination_split")


def _all_splits(spark: SparkSession, sf: str) -> DataFrame:
    return S.union_all([V.first_corpus(spark, sf), V.second_corpus(spark, sf)])


def split_map_n(spark: SparkSession, sf: str) -> DataFrame:
    merged = L.merged_split(F.col("split")).alias("destination_split")
    return _all_splits(spark, sf).select("doc_id", "split", merged)


def split_map_raw(spark: SparkSession, sf: str) -> DataFrame:
    raw = L.raw_split(F.col("split")).alias("destination_split")
    return _all_splits(spark, sf).select("doc_id", "split", raw)


def script_labels(spark: SparkSession, sf: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for x in ("en", "sna", "fr", "lug", "de", "lin")])
    code = F.coalesce(F.try_element_at(known, "language"), "language")
    rows = V.utterances(spark, sf).select("doc_id", code.alias("code"))
    label = P.script_label(F.col("code"))
    return rows.select("doc_id", label.alias("label"), P.language_base(label).alias("base"))


def lang_harmonize(spark: SparkSession, sf: str) -> DataFrame:
    second = V.second_corpus(spark, sf)
    lookup = L.label_lookup(V.first_corpus(spark, sf))
    return L.harmonize_language(second, lookup).select("doc_id", "language")


def pair_lookup(spark: SparkSession, sf: str) -> DataFrame:
    corpora = V.utterances(spark, sf).select("corpus").distinct()
    pairs = corpora.withColumn("companion", F.concat("corpus", F.lit("-extra")))
    return L.companion_corpus(V.utterances(spark, sf), pairs).select("doc_id", "corpus", "companion")


# Composition


def compose_union(spark: SparkSession, sf: str) -> DataFrame:
    kept = [Z.drop_language_columns(V.first_corpus(spark, sf)), V.second_corpus(spark, sf)]
    return S.union_all(kept).select(
        "doc_id", "source", "corpus", "language", "text", "num_samples", "quality"
    )


def _aligned(parts: list[DataFrame], lookup: DataFrame) -> DataFrame:
    """Both corpora with audio, common labels and destination splits."""
    parts = [V.with_audio(part).withColumn("source_language", F.col("language")) for part in parts]
    both = S.union_all([parts[0], L.harmonize_language(parts[1], lookup)])
    return L.map_two_corpus_splits(both).withColumnRenamed("split", "source_split")


def _two_corpus_rows(spark: SparkSession, sf: str, lookup: DataFrame) -> DataFrame:
    parts = [V.first_corpus(spark, sf), V.second_corpus(spark, sf)]
    rows = _aligned([Z.mark_usable(part) for part in parts], lookup)
    # Keys, file, flag and paths as a table: paths are looked up and counted from that.
    rows = rows.select(*M.MANIFEST_KEYS, S.SOURCE_FILE, Z.KEEP, "audio")
    rows = cut_lineage(spark, rows, "manifest-rows")
    paths = path_lookup(rows, V.audio_inventory(spark, sf), F.lit(V.ROOT))
    return count_replacements(rows, paths, [*M.MANIFEST_KEYS, S.SOURCE_FILE, Z.KEEP])


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    lookup = L.label_lookup(V.first_corpus(spark, sf))
    rows = _two_corpus_rows(spark, sf, lookup)
    # Files as listed before labelled rows left the first corpus, so some hold no row.
    parts = [V.first_corpus(spark, sf, whole=True), V.second_corpus(spark, sf)]
    files = _aligned(parts, lookup).select(*M.MANIFEST_KEYS, "source_file").distinct()
    return M.composition_manifest(rows, files)


def column_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Which tables the guards refuse for lack of a column, and how many rows that keeps out."""
    wanted = {"documents": ["text", "lang"], "conversations": ["ID"], "pages": ["url", "transcription", "audio"]}
    found = []
    for name, columns in wanted.items():
        rows = V.table(spark, sf, name)
        missing = None
        try:
            D.require_columns(rows, *columns)
        except ValueError:
            missing = ",".join(c for c in columns if c not in rows.columns)
        counted = rows.agg(F.count(F.lit(1)).alias("rows"))
        found.append(counted.select(F.lit(name).alias("table"), F.lit(missing).cast("string").alias("missing"), "rows"))
    return S.union_all(found)


def composition_gate(spark: SparkSession, sf: str) -> DataFrame:
    keys = [*M.MANIFEST_KEYS, "file"]
    rows = _two_corpus_rows(spark, sf, L.label_lookup(V.first_corpus(spark, sf)))
    rows = rows.withColumn("file", F.col("source_file"))
    return M.emptied_partitions(M.composition_manifest(rows, None, keys)).select(*keys, "dropped_rows")


def manifest_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "manifest")
    W.write_manifest(manifest(spark, sf), root)
    fields = [*M.MANIFEST_KEYS, *C.MANIFEST_COUNTERS]
    return M.check_manifest_fields(W.read_manifest(spark, root)).select(*fields)


def resolve_paths(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.audio_paths(spark, sf)
    lookup = path_lookup(rows, V.audio_inventory(spark, sf), F.lit(V.ROOT))
    resolved = replace_paths(rows.withColumn("given", F.col("audio.path")), lookup)
    path = F.col("audio.path")
    replaced = (~path.eqNullSafe(F.col("given"))).alias("replaced")
    return resolved.select("doc_id", path.alias("path"), replaced)


def _written(spark: SparkSession, rows: DataFrame, name: str, *keys: str) -> str:
    root = scratch_path(spark, name)
    rows.write.partitionBy(*keys).parquet(root)
    return root


def compose_corpus(spark: SparkSession, sf: str) -> DataFrame:
    roots = []
    for name, rows in (("first", V.first_corpus(spark, sf)), ("second", V.second_corpus(spark, sf))):
        rows = rows.withColumn("origin", F.col("corpus")).withColumn("corpus", F.lit(name))
        roots.append(_written(spark, rows, name, *S.PARTITION_KEYS))
    composition = compose.compose_two(spark, roots[0], "first", roots[1], "second")
    out = scratch_path(spark, "combined")
    compose.publish_composition(composition, out, roots)
    return S.read_partitioned(spark, published(spark, out)).select(
        "doc_id", "corpus", "split", "language", "source_split", "origin", "text", "quality", "source"
    )


def compose_many(spark: SparkSession, sf: str) -> DataFrame:
    first = V.first_corpus(spark, sf)
    second = V.second_corpus(spark, sf)
    roots = [_written(spark, rows, "root", *S.PARTITION_KEYS) for rows in (first, second)]
    rows = compose.compose_roots(spark, roots).manifest()
    keys = ["corpus", "source_split", "destination_split", "source_language", "language"]
    counters = ["rows_before", "rows_after", "dropped_rows", "normalized_audio_paths"]
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in counters])


# Sources


def partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = _written(spark, V.utterances(spark, sf), "corpus", *S.PARTITION_KEYS)
    return S.read_partitioned(spark, root).select("doc_id", *S.PARTITION_KEYS, "audio_size")


def partition_files(spark: SparkSession, sf: str) -> DataFrame:
    root = _written(spark, V.utterances(spark, sf), "corpus", *S.PARTITION_KEYS)
    listed = S.partition_listing(S.file_inventory(spark, root, "*.parquet"))
    return listed.select(*S.PARTITION_KEYS).distinct().orderBy(*S.PARTITION_KEYS)


def raw_shard_scan(spark: SparkSession, sf: str) -> DataFrame:
    # "dev" is no shard name, so those shards are skipped.
    name = F.concat("language", F.lit("-"), "split", F.lit("-00000.parquet"))
    rows = V.utterances(spark, sf).withColumns({"folder": F.col("language"), "shard": name})
    root = scratch_path(spark, "shards")
    rows.write.partitionBy("folder", "shard").parquet(f"{root}/data/ASR")
    base = S.raw_shard_root(spark, root)
    return S.read_raw_shards(spark, base).select(
        "doc_id", F.col("corpus").alias("layout"), "language", "split", "shard", "audio_size"
    )


def layout_inference(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("language", F.lit("-"), "split", F.lit("-"), "doc_id", F.lit(".parquet"))
    loose = F.concat(F.lit("part-"), "doc_id", F.lit("-"), "split", F.lit(".parquet"))
    path = (
        F.when(F.col("corpus") == "src1", F.concat(F.lit("/r/asr/"), "language", F.lit("/"), loose))
        .when(F.col("corpus") == "src2", F.concat(F.lit("/r/data/"), "language", F.lit("/"), name))
        .when(F.col("corpus") == "src3", F.concat(F.lit("/r/ASR/"), name))
        .otherwise(F.concat(F.lit("/r/data/ASR/"), "language", F.lit("/x/"), name))
    )
    return S.inferred_keys(V.utterances(spark, sf).select(path.alias("path")), "/r")


def glob_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = _written(spark, V.utterances(spark, sf), "globs", "language")
    patterns = "language=fr/*.parquet; language=d*/*.parquet"
    return S.read_globs(spark, root, patterns).select("doc_id", "audio_size")


def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    log = V.run_logs(spark, sf, "view")
    log = log.withColumn("run", F.concat(F.lit("ws_"), F.col("line_order") % 20))
    fields = F.to_json(F.struct(*[f"`{name}`" for name in D.LOG_FIELDS]))
    broken = F.col("line_order") % 17 == 0
    lines = log.select("run", F.when(broken, F.lit("{not json")).otherwise(fields).alias("value"))
    root = scratch_path(spark, "logs")
    lines.write.partitionBy("run").text(root)
    read = D.read_log(spark, f"{root}/run=*/*.txt")
    run = P.partition_value(F.col("file"), "run")
    parsed = K.parsed_log(read.withColumn("run", run))
    return parsed.select("run", "step", "loss", "wer", "uer")


def submission_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "submission")
    V.submission(spark, sf).select("ID", F.nullif("Target", F.lit("")).alias("Target")).write.csv(
        root, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    table = B.with_clean_id(D.read_submission(spark, root))
    return table.groupBy(B.CLEAN_ID, "Target").agg(F.count(F.lit(1)).alias("rows"))


def audio_index(spark: SparkSession, sf: str) -> DataFrame:
    return D.first_path_per_stem(V.audio_index(spark, sf))


def evaluation_split(spark: SparkSession, sf: str) -> DataFrame:
    config = D.config_column(F.col("language"))
    rows = V.utterances(spark, sf).withColumn("config", config)
    root = _written(spark, rows, "evaluation", "config", "split")
    table = S.read_partitioned(spark, root, ["config", "split"])
    return D.evaluation_split(table, language=" FR ").select("doc_id", "config", "split", "text")


def _put_files(files: DataFrame, root: str) -> None:
    """Write ``content`` to ``place`` below ``root`` for each row."""

    def put(frames):
        for frame in frames:
            for place, content in zip(frame["place"], frame["content"]):
                system, path = S.open_files(f"{root}/{place}")
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(path, compression=None) as out:
                    out.write(content)
            yield frame[["place"]]

    written = files.select("place", F.encode("content", "utf-8").alias("content"))
    written.mapInPandas(put, "place string").write.format("noop").mode("overwrite").save()


def _audio_tree(spark: SparkSession, sf: str) -> str:
    """A partitioned corpus with audio files beside it at every level above the rows."""
    clip = F.concat(F.lit("clips/"), "doc_id", F.lit(".wav"))
    audio = F.struct(F.lit(None).cast("binary").alias("bytes"), clip.alias("path"))
    rows = V.utterances(spark, sf).withColumns({"audio": audio, "source": F.lit("mine")})
    root = _written(spark, rows, "audio-tree", *S.PARTITION_KEYS)
    corpus = F.concat(F.lit("corpus="), "corpus", F.lit("/"))
    split = F.concat(corpus, F.lit("split="), "split", F.lit("/"))
    leaf = F.concat(split, F.lit("language="), "language", F.lit("/"))
    level = F.col("doc_id") % 5
    folder = F.when(level == 0, leaf).when(level == 1, split).when(level == 2, corpus).otherwise("")
    files = rows.where(level < 4).select(F.concat(folder, clip).alias("place"), F.lit("RIFF").alias("content"))
    _put_files(files, root)
    return root


def hours_files(spark: SparkSession, sf: str) -> DataFrame:
    return H.hours(S.read_any_layout(spark, _audio_tree(spark, sf))).orderBy(*S.PARTITION_KEYS)


def resolve_paths_files(spark: SparkSession, sf: str) -> DataFrame:
    root = _audio_tree(spark, sf)
    composition = compose.compose_roots(spark, [root])
    out = scratch_path(spark, "combined")
    # Without the gates: some languages have no usable row here.
    W.write_corpus(composition.corpus(), out)
    found = S.read_partitioned(spark, out)
    place = F.replace(F.col("audio.path"), F.lit(compose.plain_root(root)), F.lit(""))
    return found.select("doc_id", place.alias("path"), "source")


def schema_groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.utterances(spark, sf)
    root = scratch_path(spark, "schemas")
    for k, absent in enumerate(([], ["text"], ["duration"])):
        part = rows.where(F.col("doc_id") % 3 == k).drop(*absent)
        part.write.mode("append").partitionBy(*S.PARTITION_KEYS).parquet(root)
    scans = S.read_by_schema(spark, root)
    marked = S.union_all([Z.mark_usable(scan.frame, present=scan.present) for scan in scans])
    return marked.select("doc_id", F.col(Z.KEEP).alias("keep"))


def audio_files(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "audio-files")
    docs = V.table(spark, sf, "documents").where("text <> ''")
    place = F.concat(F.lit("d"), "doc_id", F.lit(".wav"))
    _put_files(docs.select(place.alias("place"), F.col("text").alias("content")), root)
    sizes = S.file_inventory(spark, root, "*.wav").select("path", F.col("length").alias("bytes"))
    return D.read_audio_index(spark, root).join(sizes, "path").select("stem", "bytes")


# Statistics


def hours(spark: SparkSession, sf: str) -> DataFrame:
    return H.hours(V.utterances(spark, sf)).orderBy(*S.PARTITION_KEYS)


def sanitized_hours(spark: SparkSession, sf: str) -> DataFrame:
    rows = Z.sanitize(V.utterances(spark, sf))
    rows = rows.withColumns(
        {"split": L.merged_split(F.col("split")), "language": P.script_label(F.col("language"))}
    )
    return H.hours(rows).orderBy(*S.PARTITION_KEYS)


def distribution_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "distribution")
    W.write_distribution(H.distribution(hours(spark, sf), "docs", V.ROOT), path)
    return spark.read.csv(path, header=True, sep="\t")


def train_groups(spark: SparkSession, sf: str) -> DataFrame:
    return H.train_groups(V.utterances(spark, sf))


def valid_split(spark: SparkSession, sf: str) -> DataFrame:
    return H.valid_split(V.utterances(spark, sf))


def label_sets(spark: SparkSession, sf: str) -> DataFrame:
    return V.utterances(spark, sf).select(*S.PARTITION_KEYS).distinct().orderBy(*S.PARTITION_KEYS)


def mixture_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = H.mixture_weights(hours(spark, sf).where("split = 'train'"))
    shares = ["corpus_weight", "language_weight", "weight"]
    return weights.select("corpus", "language", *[F.round(name, 9).alias(name) for name in shares])


def length_limits(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.utterances(spark, sf).select("doc_id", "audio_size")
    return rows.withColumn("length_status", H.length_status(F.col("audio_size")))


def length_limits_llm(spark: SparkSession, sf: str) -> DataFrame:
    return H.within_length(V.utterances(spark, sf), "llm").select("doc_id", "audio_size")


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.within_length(V.utterances(spark, sf).select("doc_id", "audio_size"))
    planned = H.plan_batches(rows, ["doc_id"], rows_per_shard=BATCH_ROWS)
    return planned.select("doc_id", "capacity", "batch")


def batch_padding(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.utterances(spark, sf).select("doc_id", "audio_size")
    return H.batch_padding(H.plan_batches(rows, ["doc_id"], rows_per_shard=BATCH_ROWS))


# Evaluation


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.when(F.col("audio_size") % 7 == 0, 0).otherwise(C.SAMPLE_RATE)
    rows = V.utterances(spark, sf).select("doc_id", "language", "audio_size", rate.alias("rate"))
    return E.with_duration_status(rows, F.col("audio_size"), F.col("rate"))


def duration_status(spark: SparkSession, sf: str) -> DataFrame:
    return _timed(spark, sf).select("doc_id", "seconds", "status")


def skip_counts(spark: SparkSession, sf: str) -> DataFrame:
    return E.status_counts(_timed(spark, sf), ["language"])


def capped_eval(spark: SparkSession, sf: str) -> DataFrame:
    capped = E.cap_samples(_timed(spark, sf), ["audio_size", "doc_id"], CAP)
    return E.scorable(capped).select("doc_id", "seconds")


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    turns = V.table(spark, sf, "conversations")
    rows = turns.select("conv_id", "turn", T.normalize(F.col("text")).alias("normalized"))
    counts = {"words": T.word_count(F.col("normalized")), "chars": T.char_count(F.col("normalized"))}
    return rows.withColumns(counts)


def wer_pairs(spark: SparkSession, sf: str) -> DataFrame:
    scored = Q.score_rows(V.turn_pairs(spark, sf))
    return scored.select("conv_id", "turn", "word_edits", "word_total")


def cer_pairs(spark: SparkSession, sf: str) -> DataFrame:
    scored = Q.score_rows(V.turn_pairs(spark, sf))
    return scored.select("conv_id", "turn", "char_edits", "char_total")


def wer(spark: SparkSession, sf: str) -> DataFrame:
    rates = Q.corpus_rates(V.turn_pairs(spark, sf))
    return rates.select("num_samples", "word_edits", "word_total", "wer")


def cer(spark: SparkSession, sf: str) -> DataFrame:
    rates = Q.corpus_rates(V.turn_pairs(spark, sf), ["role"])
    return rates.select("role", "num_samples", "char_edits", "char_total", "cer")


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    pairs = V.turn_pairs(spark, sf).withColumns(
        {"config": F.concat("role", F.lit("_asr")), "split": F.lit("test"), "model_card": F.lit("m")}
    )
    return Q.run_summary(pairs, "turns")


def pair_by_id(spark: SparkSession, sf: str) -> DataFrame:
    turns = V.table(spark, sf, "conversations")
    row_id = F.concat_ws("-", "conv_id", "turn").alias("id")
    references = turns.select(row_id, F.col("text").alias("reference"))
    heard = turns.where("role = 'assistant'")
    heard = heard.select(row_id, F.replace("text", F.lit("e"), F.lit("")).alias("prediction"))
    pairs = cut_lineage(spark, Q.pair_by_id(references, heard), "pairs")
    found = pairs.where("prediction is not null")
    totals = Q.score_totals(Q.score_rows(found)).select(F.col("num_samples").alias("heard"), "char_edits")
    counted = pairs.agg(F.count(F.lit(1)).alias("num_samples")).withColumn("one", F.lit(1))
    return counted.join(totals.withColumn("one", F.lit(1)), "one").drop("one")


def slug(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "pages").select("page_id", P.slug(F.col("url")).alias("slug"))


def prediction_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = V.table(spark, sf, "documents").select(
        F.col("text").alias("transcription"),
        F.lower("text").alias("prediction"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    placed = E.with_position(docs, "file", "row")
    return E.prediction_rows(placed, "en", "en_asr", "test", "card")


def predictions_json(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "predictions")
    rows = prediction_rows(spark, sf)
    W.write_json(rows, out)
    return spark.read.schema(rows.schema).json(out)


# Inference


def without_e():
    """A stand-in recognizer: drops each 'e' and cannot read texts with a bar."""

    def predict(batch, hints):
        if any("|" in text for text in batch):
            raise ValueError("unreadable")
        return [text.replace("e", "") for text in batch]

    return predict


def infer_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return transcribe(spread_if_few_files(docs), without_e, "text")


def text_of_wav():
    """A stand-in recognizer for ``views.wav_files``: the samples are the text."""

    def predict(batch, hints):
        datas = [item["bytes"] for item in batch]
        starts = [data.index(b"data", 36) + 8 for data in datas]
        texts = [data[at:].decode() for data, at in zip(datas, starts)]
        if any("ou" in text for text in texts):
            raise ValueError("unheard")
        return [text.replace("e", "") for text in texts]

    return predict


def _evaluated(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    audio = F.struct(F.col("content").alias("bytes"), F.lit(None).cast("string").alias("path"))
    texts = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("transcription"))
    samples = V.wav_files(spark, sf).join(texts, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("language"),
        "transcription",
        audio.alias("audio"),
        F.lit("en_asr").alias("config"),
        F.lit("test").alias("split"),
    )
    root = _written(spark, samples, "samples", "config", "split")
    run = evaluate.Run(text_of_wav, "a card", "en", "docs", max_seconds=0.1)
    out = scratch_path(spark, "evaluated")
    counts = evaluate.evaluate(spark, evaluate.read_samples(spark, root, run), run, out)
    return counts, out


def evaluation_run(spark: SparkSession, sf: str) -> DataFrame:
    _, out = _evaluated(spark, sf)
    fields = ["id", "language", "config", "split", "reference", "prediction", "model_card"]
    schema = ", ".join(f"{name} string" for name in fields)
    return spark.read.schema(schema).json(f"{out}/a_card_en_asr_test.jsonl")


def evaluation_errors(spark: SparkSession, sf: str) -> DataFrame:
    _, out = _evaluated(spark, sf)
    return spark.read.schema("id string, error string").json(f"{out}/a_card_en_asr_test.errors.jsonl")


def evaluation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, out = _evaluated(spark, sf)
    fields = "dataset string, config string, split string, num_samples long, model_card string, omni_lang string, cer double"
    return spark.read.schema(fields).json(f"{out}/a_card_en_asr_test.metrics.json")


def evaluation_skips(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf)[0]


def wav_metadata(spark: SparkSession, sf: str) -> DataFrame:
    read = A.with_audio_metadata(V.wav_files(spark, sf), F.col("content"))
    return read.select("doc_id", "wav.sample_rate", "wav.channels", "wav.n_samples")


def audio_containers(spark: SparkSession, sf: str) -> DataFrame:
    read = A.with_audio_metadata(V.container_files(spark, sf), F.col("content"))
    timed = E.with_duration_status(read, F.col("wav.n_samples"), F.col("wav.sample_rate"), 1.0)
    return timed.select("doc_id", "wav.sample_rate", "wav.channels", "wav.n_samples", "status")


def array_audio(spark: SparkSession, sf: str) -> DataFrame:
    vectors = V.table(spark, sf, "embeddings")
    mirrored = F.zip_with("embedding", F.reverse("embedding"), lambda a, b: F.array(a, b))
    mono = F.transform("embedding", lambda a: F.array(a))
    frames = F.when(F.col("vec_id") % 2 == 0, mono).otherwise(mirrored)
    rate = F.when(F.col("vec_id") % 7 == 0, 0).otherwise(C.SAMPLE_RATE)
    audio = F.struct(frames.alias("array"), rate.cast("long").alias("sampling_rate"))
    read = evaluate.with_sample_metadata(vectors.withColumn("audio", audio))
    timed = E.with_duration_status(read, F.col("wav.n_samples"), F.col("wav.sample_rate"), 0.003)
    return timed.select("vec_id", "wav.sample_rate", "wav.channels", "wav.n_samples", "status")


def mono_mix(spark: SparkSession, sf: str) -> DataFrame:
    vectors = V.table(spark, sf, "embeddings")
    frames = F.arrays_zip("embedding", F.reverse("embedding").alias("mirror"))
    stereo = F.transform(frames, lambda f: F.array(f["embedding"], f["mirror"]))
    mono = A.mono_mix(stereo)
    return vectors.select("vec_id", F.posexplode(mono).alias("sample", "value"))


# Submission


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    index = D.first_path_per_stem(V.audio_index(spark, sf))
    matched = B.match_audio(B.unique_ids(V.submission(spark, sf)), index)
    return matched.withColumn("decoded", ~F.contains("path", F.lit("/src7/")))


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    heard = F.when(F.col("decoded"), F.concat(F.lit("heard in "), "path"))
    predictions = _matched(spark, sf).select(B.CLEAN_ID, heard.alias("prediction"))
    kept = cut_lineage(spark, predictions, "predictions")
    return B.fill_targets(V.submission(spark, sf), kept)


def unique_ids(spark: SparkSession, sf: str) -> DataFrame:
    return B.unique_ids(V.submission(spark, sf))


def missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    index = D.first_path_per_stem(V.audio_index(spark, sf))
    return B.missing_ids(B.unique_ids(V.submission(spark, sf)), index).select(B.CLEAN_ID)


def fill_target(spark: SparkSession, sf: str) -> DataFrame:
    return _filled(spark, sf).select("row_order", "Target", "filled")


def fill_report(spark: SparkSession, sf: str) -> DataFrame:
    return B.fill_report(_filled(spark, sf), _matched(spark, sf))


def filled_csv(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "filled")
    filled = _filled(spark, sf).drop("filled").withColumn("row", F.col("row_order"))
    W.write_filled(filled, out, V.ROOT)
    schema = "ID string, Target string, row bigint"
    read = spark.read.schema(schema).csv(out, header=True, emptyValue="")
    return read.select("row", F.coalesce("Target", F.lit("")).alias("Target"))


# Training runs


def _logs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    valid = K.parsed_log(V.run_logs(spark, sf, "click"))
    train = K.parsed_log(V.run_logs(spark, sf, "view"))
    return valid, train, V.checkpoints(spark, sf)


def best_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return K.best_checkpoint(*_logs(spark, sf))


def train_last(spark: SparkSession, sf: str) -> DataFrame:
    return K.last_loss(_logs(spark, sf)[1])


def valid_with_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    valid, _, saved = _logs(spark, sf)
    return K.with_checkpoint(valid, saved).select("run", "line_order", "step", "loss")


def checkpoint_losses(spark: SparkSession, sf: str) -> DataFrame:
    _, train, saved = _logs(spark, sf)
    return K.steps_with_loss(saved, train)


def checkpoint_steps(spark: SparkSession, sf: str) -> DataFrame:
    return K.checkpoint_steps(V.checkpoints(spark, sf)).orderBy("run", "step")


def run_folders(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "runs")
    logs = V.run_logs(spark, sf, "view").groupBy("run").agg(F.count(F.lit(1)).alias("lines"))
    logs = cut_lineage(spark, logs, "run-lines")
    # Short rows, but a file and two folders each. A folder takes new ones one at a time and is
    # listed by one task, so that runs lie in groups, each of which one task writes.
    runs = logs.count()
    logs = logs.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(runs // 256 + 1)))
    logs = logs.repartition(S.file_tasks(spark, runs), "group")
    place = F.concat("group", F.lit("/"), "run", F.lit("/metrics/train.jsonl")).alias("place")
    _put_files(logs.select(place, F.col("lines").cast("string").alias("content")), root)
    found = S.file_inventory(spark, root).select(K.run_of(F.col("path")).alias("run"))
    try:
        K.require_single_run(found)
        refused = False
    except RuntimeError:
        refused = True
    return found.agg(F.countDistinct("run").alias("runs")).withColumn("refused", F.lit(refused))


def lenient_numbers(spark: SparkSession, sf: str) -> DataFrame:
    log = V.run_logs(spark, sf)
    step = F.col(f"`{C.LOG_STEP}`")
    loss = F.col(f"`{C.LOG_LOSS}`")
    return log.select(
        "line_order",
        P.lenient_long(step).alias("step"),
        P.lenient_long(loss).alias("whole"),
        P.lenient_double(loss).alias("loss"),
        P.fixed_decimals(loss, 4).alias("shown"),
    )


def metrics_report(spark: SparkSession, sf: str) -> DataFrame:
    return R.valid_lines(V.checkpoints(spark, sf), V.run_logs(spark, sf, "click"))


def train_report(spark: SparkSession, sf: str) -> DataFrame:
    return R.metric_lines(V.run_logs(spark, sf, "view"), R.TRAIN_COLUMNS)


def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.summary_lines(best_checkpoint(spark, sf))


def full_report(spark: SparkSession, sf: str) -> DataFrame:
    valid, train = (V.run_logs(spark, sf, kind) for kind in ("click", "view"))
    return R.full_report(best_checkpoint(spark, sf), valid, train)


# Streaming


def stream_predictions(spark: SparkSession, sf: str) -> DataFrame:
    staged = scratch_path(spark, "samples")
    V.utterances(spark, sf).select("doc_id", "text", "num_samples").repartition(6).write.parquet(staged)
    schema = spark.read.parquet(staged).schema
    samples = I.read_new_files(spark, staged, schema, files_per_trigger=2)
    timed = E.with_duration_status(samples, F.col("num_samples"), F.lit(C.SAMPLE_RATE))
    out = scratch_path(spark, "stream-out")
    query = I.append_predictions(timed, without_e, "text", out, scratch_path(spark, "stream-state"))
    query.awaitTermination()
    return spark.read.schema("doc_id bigint, prediction string").json(out).select("doc_id", "prediction")


def stream_skips(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses as the stream's writing pass counts them, over all its micro-batches."""
    staged = scratch_path(spark, "samples")
    rows = V.utterances(spark, sf).select("doc_id", "text", "num_samples", "language")
    rows.repartition(6).write.parquet(staged)
    samples = I.read_new_files(spark, staged, spark.read.parquet(staged).schema, files_per_trigger=2)
    rate = F.when(F.col("language") == "es", 0).otherwise(C.SAMPLE_RATE)
    timed = E.with_duration_status(samples, F.col("num_samples"), rate)
    out, counts = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-counts")
    state = scratch_path(spark, "stream-state")
    I.append_predictions(timed, without_e, "text", out, state, counts=counts).awaitTermination()
    written = spark.read.schema("status string, samples long").json(counts)
    return written.groupBy("status").agg(F.sum("samples").alias("samples"))


def stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    staged = scratch_path(spark, "pairs")
    status = F.when(F.col("conv_id") % 5 == 0, "too_long").otherwise("ok").alias("status")
    pairs = V.turn_pairs(spark, sf).select("role", "reference", "prediction", status)
    pairs.repartition(6).write.parquet(staged)
    stream = I.read_new_files(spark, staged, spark.read.parquet(staged).schema, files_per_trigger=2)
    out = scratch_path(spark, "totals")
    I.keep_totals(stream, ["role"], out, scratch_path(spark, "totals-state")).awaitTermination()
    rates = Q.with_rates(I.last_totals(spark, out))
    return rates.select("role", "num_samples", *Q.COUNTS, "wer", "cer", "skipped")


QUERIES = [
    sanitize_keep,
    sanitized_rows,
    split_map_two,
    split_map_n,
    split_map_raw,
    script_labels,
    lang_harmonize,
    pair_lookup,
    compose_union,
    manifest,
    column_guards,
    composition_gate,
    manifest_round_trip,
    resolve_paths,
    compose_corpus,
    compose_many,
    partitioned_scan,
    partition_files,
    raw_shard_scan,
    layout_inference,
    glob_scan,
    log_scan,
    submission_scan,
    audio_index,
    audio_files,
    hours_files,
    resolve_paths_files,
    schema_groups,
    evaluation_split,
    hours,
    sanitized_hours,
    distribution_table,
    train_groups,
    valid_split,
    label_sets,
    mixture_weights,
    length_limits,
    length_limits_llm,
    batch_plan,
    batch_padding,
    duration_status,
    skip_counts,
    capped_eval,
    normalize_text,
    wer_pairs,
    cer_pairs,
    wer,
    cer,
    run_summary,
    pair_by_id,
    slug,
    prediction_rows,
    predictions_json,
    infer_batches,
    evaluation_run,
    evaluation_skips,
    evaluation_errors,
    evaluation_metrics,
    array_audio,
    audio_containers,
    wav_metadata,
    mono_mix,
    unique_ids,
    missing_ids,
    fill_target,
    fill_report,
    filled_csv,
    best_checkpoint,
    train_last,
    valid_with_checkpoint,
    checkpoint_losses,
    checkpoint_steps,
    run_folders,
    lenient_numbers,
    metrics_report,
    train_report,
    report_summary,
    full_report,
    stream_predictions,
    stream_skips,
    stream_totals,
]
