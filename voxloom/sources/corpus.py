"""Scans of speech corpora: partitioned, raw-sharded, or inferred from paths."""

from __future__ import annotations

import fnmatch
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import constants as C
from voxloom.functions import parsing as P
from voxloom.operators.joins import RESERVED
from voxloom.session import as_lookup, cut_lineage, exists, qualified

PARTITION_KEYS = ["corpus", "split", "language"]
SOURCE_FILE = "source_file"


def file_path() -> Column:
    """The plain path of the file a row was read from."""
    return P.plain_path(F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def file_inventory(
    spark: SparkSession, root: str, pattern: str = "*", depth: int | None = None, opener: Callable | None = None
) -> DataFrame:
    """Every file below ``root`` as (path, length); no content is read.

    Folders are listed in tasks, level by level: a round lists the folders that the one
    before found and writes what is in them, so the driver holds neither files nor
    folders. One folder's own entries pass through one task. ``depth`` is the number of
    levels below ``root`` to enter. Hidden files and folders, as Spark knows them, and
    zero-byte files, which hold no audio, are not listed. A store that ``opener`` does
    not know is listed by Spark itself.
    """
    place = qualified(spark, root)
    if not exists(spark, root):
        raise FileNotFoundError(f"PATH_NOT_FOUND: {root}")
    scheme = place.partition(":")[0]
    if opener is None and scheme not in KNOWN_SCHEMES:
        return _listed_by_spark(spark, root, pattern, depth)
    opener = opener or open_files
    start = re.sub("^file:/+", "/", place).rstrip("/") or "/"
    frontier = spark.range(1).select(F.lit(start).alias("path"))
    rounds, folders = [], 1
    while folders:
        tasks = file_tasks(spark, folders)
        listed = frontier.repartition(tasks).mapInPandas(_folder_lister(opener, pattern), _ENTRY)
        listed = cut_lineage(spark, listed, "listed-folders")
        rounds.append(listed.where("not folder").select("path", "length"))
        if depth is not None and len(rounds) > depth:
            break
        frontier = listed.where("folder").select("path")
        folders = frontier.count()
    return union_all(rounds)


def file_tasks(spark: SparkSession, places: int) -> int:
    """Tasks for work on so many folders or files, whose rows are too short for Spark to deal it out.

    Every core gets some of a few places. As a task costs more than hundreds of places do,
    there are more than a few tasks a core only where each has thousands.
    """
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(places // 16, max(4 * cores, places // 5000)))


_ENTRY = "path string, length long, folder boolean"
#: Entries of its folders that a task hands on at once.
_ENTRIES = 10_000


def _folder_lister(opener: Callable, pattern: str) -> Callable:
    def entries(uri: str) -> Iterator[tuple[str, int, bool]]:
        from pyarrow import fs

        system, path = opener(uri)
        for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            name, folder = info.base_name, info.type == fs.FileType.Directory
            if name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"):
                continue
            if folder or (info.size and fnmatch.fnmatchcase(name, pattern)):
                yield f"{uri.rstrip('/')}/{name}", info.size or 0, folder

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Entries of many small folders go on together.
        found = itertools.chain.from_iterable(entries(uri) for batch in batches for uri in batch["path"])
        while some := list(itertools.islice(found, _ENTRIES)):
            yield pd.DataFrame(some, columns=["path", "length", "folder"])

    return run


def _listed_by_spark(spark: SparkSession, root: str, pattern: str, depth: int | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    listed = reader.option("recursiveFileLookup", "true").load(root)
    listed = listed.select(P.plain_path(F.col("path")).alias("path"), "length")
    if depth is None:
        return listed
    levels = F.size(F.split("path", "/"))
    top = len(re.sub("^file:/+", "/", qualified(spark, root)).rstrip("/").split("/"))
    return listed.where(levels <= top + 1 + depth)


def partition_listing(inventory: DataFrame) -> DataFrame:
    """Parquet files with the keys of their partition directories."""
    return inventory.select(
        *[P.partition_value(F.col("path"), key).alias(key) for key in PARTITION_KEYS], "path"
    ).where(F.col("corpus").isNotNull() & F.col("split").isNotNull() & F.col("language").isNotNull())


def parquet_reader(spark: SparkSession, merge_schema: bool = True) -> DataFrameReader:
    """Reads only Parquet files, since audio files may lie beside them."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).option(
        "pathGlobFilter", "*.parquet"
    )


def read_partitioned(
    spark: SparkSession,
    root: str,
    keys: list[str] = PARTITION_KEYS,
    merge_schema: bool = True,
    files: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """``root/corpus=*/split=*/language=*/*.parquet`` with text partition keys.

    ``keys`` names other partition directories. ``source_file`` is the file of
    each row. Only files at that depth are listed, so folders with audio may lie
    anywhere else below ``root``.
    """
    pattern = "/".join([root.rstrip("/"), *(f"{key}=*" for key in keys), "*.parquet"])
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        reader = parquet_reader(spark, merge_schema).option("basePath", root)
        reader = reader if schema is None else reader.schema(schema)
        frame = reader.parquet(*(files or [pattern]))
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise FileNotFoundError(f"no {keys} partition directories below {root}") from error
    finally:
        spark.conf.set(inference, before)
    return frame.withColumn(SOURCE_FILE, file_path())


def read_globs(spark: SparkSession, root: str, patterns: str) -> DataFrame:
    """Parquet files below ``root`` allowed by any of the ';'-separated globs."""
    globs = [f"{root}/{pattern.strip()}" for pattern in patterns.split(";") if pattern.strip()]
    return parquet_reader(spark).parquet(*globs)


def shard_keys(df: DataFrame, path: Column) -> DataFrame:
    """Add language, split and shard from ``.../<language>/<language>-<split>-<n>.parquet``.

    A shard is a file, or a directory of that name written by Spark, whose
    ``key=`` prefixes do not count. Rows from other names are left out.
    """
    shard_path = F.regexp_replace(path, r"(\.parquet)/[^/]+$", "$1")
    shard_path = F.regexp_replace(shard_path, r"/[A-Za-z_]+=", "/")
    name = P.file_name(F.col("shard_path"))
    return (
        df.withColumn("shard_path", shard_path)
        .withColumn("language", P.file_name(P.parent(F.col("shard_path"))))
        .withColumn("split", P.shard_part(name, 2))
        .withColumn("shard", P.shard_part(name, 3))
        .where(F.col("split").isNotNull())
        .drop("shard_path")
    )


def read_raw_shards(
    spark: SparkSession, root: str, files: list[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Raw shards below ``root`` as one corpus; unmatched file names are skipped."""
    reader = parquet_reader(spark)
    reader = reader if schema is None else reader.schema(schema)
    frame = reader.parquet(*(files or [f"{root}/*/*.parquet"]))
    frame = frame.drop(*C.LANGUAGE_COLUMNS, "split").withColumn(SOURCE_FILE, file_path())
    return shard_keys(frame, F.col(SOURCE_FILE)).withColumn("corpus", F.lit("ASR"))


def raw_shard_root(spark: SparkSession, root: str, inventory: DataFrame | None = None) -> str:
    """``root/data/ASR`` where that directory holds Parquet files, else ``root``.

    ``inventory`` lists the files below ``root`` where they are known already.
    """
    nested = f"{root.rstrip('/')}/data/ASR"
    if inventory is None:
        if not exists(spark, nested):
            return root
        return root if file_inventory(spark, nested, "*.parquet").isEmpty() else nested
    place = re.sub("^file:/+", "/", qualified(spark, nested)) + "/"
    shards = inventory.where(F.startswith("path", F.lit(place)) & F.endswith("path", F.lit(".parquet")))
    return root if shards.isEmpty() else nested


def keys_from_path(path: Column, root: str) -> dict[str, Column]:
    """Corpus, split and language read off a path without partition directories.

    The corpus is the directory called ASR (any case) that has a directory
    inside; language and split come from that directory and the file name. A key
    that stays open is null.
    """
    above = root.rstrip("/") + "/"
    relative = F.when(F.startswith(path, F.lit(above)), F.substring(path, len(above) + 1, 2**31 - 1))
    relative = F.coalesce(relative, path)
    parts = F.split(relative, "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    asr = F.array_position(F.transform(folders, F.lower), "asr")
    inside = (asr > 0) & (asr < F.size(folders))
    name = P.file_name(relative)
    suffix = F.when(
        F.contains(P.stem(name, "parquet"), F.lit("-")),
        F.substring_index(P.stem(name, "parquet"), "-", -1),
    )
    return {
        "corpus": F.when(inside, F.try_element_at(folders, asr.cast("int"))),
        "split": F.coalesce(P.shard_part(name, 2), F.when(suffix.isin(C.SHARD_SPLITS), suffix)),
        "language": F.coalesce(
            F.when(inside, F.try_element_at(folders, (asr + 1).cast("int"))),
            P.shard_part(name, 1),
            F.try_element_at(folders, F.lit(-1)),
        ),
    }


def inferred_keys(inventory: DataFrame, root: str) -> DataFrame:
    """Keys of each Parquet path in ``inventory``.

    Partition directories win when any path has them; otherwise the keys are
    inferred, and paths that leave one open are skipped.
    """
    partitioned = partition_listing(inventory)
    if not partitioned.isEmpty():
        return partitioned
    inferred = inventory.withColumns(keys_from_path(F.col("path"), root))
    return inferred.select(*PARTITION_KEYS, "path").dropna(subset=PARTITION_KEYS)


def read_any_layout(spark: SparkSession, root: str) -> DataFrame:
    """A corpus with its keys, whether they are partition directories or inferred."""
    inventory = file_inventory(spark, root, "*.parquet")
    if not partition_listing(inventory).isEmpty():
        return read_partitioned(spark, root)
    reader = parquet_reader(spark).option("recursiveFileLookup", "true")
    frame = reader.parquet(root).drop(*PARTITION_KEYS, "lang").withColumn(SOURCE_FILE, file_path())
    keys = keys_from_path(F.col(SOURCE_FILE), root.removeprefix("file://"))
    return frame.withColumns(keys).dropna(subset=PARTITION_KEYS)


def open_files(uri: str):
    """File system and path of a URI as pyarrow opens them in a task."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition("://")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), (rest if colon else uri.removeprefix("file:"))
    place, _, path = rest.partition("/")
    # Only the store's name is parsed as a URI, since paths may hold any character.
    if scheme in ("s3", "s3a", "s3n", "gs", "gcs"):
        kind = "gs" if scheme in ("gs", "gcs") else "s3"
        return fs.FileSystem.from_uri(f"{kind}://{place}")[0], f"{place}/{path}"
    return fs.FileSystem.from_uri(f"{scheme}://{place}/")[0], f"/{path}"


KNOWN_SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "viewfs")


def shard_files(inventory: DataFrame, root: str) -> DataFrame:
    """The raw shards two levels below ``root``, among the files of an inventory."""
    place = root.rstrip("/").removeprefix("file://") + "/"
    below = F.substring("path", len(place) + 1, 2**31 - 1)
    shards = inventory.where(F.startswith("path", F.lit(place)) & F.endswith("path", F.lit(".parquet")))
    # A shard may be a directory of that name with parts in it.
    named = F.regexp_replace(below, r"(\.parquet)/[^/]+$", "$1")
    return shard_keys(shards.where(F.size(F.split(named, "/")) == 2), F.col("path"))


def file_schemas(spark: SparkSession, files: DataFrame, opener: Callable = open_files) -> DataFrame:
    """(path, signature): the sorted ``name:type`` list in each Parquet footer.

    ``files`` has the column ``path``. Footers are read in tasks, by ``opener``.
    """

    def read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            signatures = []
            for uri in batch["path"]:
                system, path = opener(uri)
                with system.open_input_file(path) as source:
                    schema = pq.read_schema(source)
                signatures.append("|".join(sorted(f"{f.name}:{f.type}" for f in schema)))
            yield batch.assign(signature=signatures)

    tasks = file_tasks(spark, files.count())
    return files.select("path").repartition(tasks).mapInPandas(read_footers, "path string, signature string")


def schema_groups(schemas: DataFrame) -> DataFrame:
    """(signature, place): a folder whose files agree, else each of its files."""
    folder = P.parent(F.col("path"))
    agree = schemas.groupBy(folder.alias("folder")).agg(
        F.min("signature").alias("low"), F.max("signature").alias("high")
    )
    agree = cut_lineage(schemas.sparkSession, agree, "folder-schemas")
    whole = agree.where("low = high").select(F.col("low").alias("signature"), F.col("folder").alias("place"))
    apart = schemas.withColumn("folder", folder).join(agree.where("low <> high"), "folder", "left_semi")
    return whole.unionByName(apart.select("signature", F.col("path").alias("place")))


SCHEMA = f"{RESERVED}schema"


@dataclass
class Scan:
    """Rows of files, and for each column that some of the files lack, which rows have it."""

    frame: DataFrame
    present: dict[str, Column] = field(default_factory=dict)


def read_by_schema(
    spark: SparkSession,
    root: str,
    raw: bool = False,
    corpus: str | None = None,
    opener: Callable = open_files,
    inventory: DataFrame | None = None,
) -> list[Scan]:
    """The files below ``root``, of one corpus if it is named, with what each of them lacks.

    Which columns exist is a property of each file, and a merged schema cannot tell a
    column a file lacks from one that is null. So a table says which schema each file
    has, and is joined with the rows of one scan of all files; it leaves out the files of
    the commonest schema. Only distinct schemas reach the driver. Where files disagree on
    the type of a column, there is a scan for each schema instead.
    """
    scheme = root.partition("://")[0] if "://" in root else "file"
    if opener is open_files and scheme not in KNOWN_SCHEMES:
        raise ValueError(f"pass an opener for {scheme}:// files")
    if inventory is None:
        inventory = file_inventory(spark, root, "*.parquet")
    inventory = inventory.where(F.endswith("path", F.lit(".parquet")))
    if raw:
        files = shard_files(inventory, root)
    else:
        files = partition_listing(inventory)
        files = files if corpus is None else files.where(F.col("corpus") == corpus)
    schemas = cut_lineage(spark, file_schemas(spark, files, opener), "file-schemas")
    known = schemas.groupBy("signature").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("path"))
    known = known.orderBy(F.desc("files"), "signature").collect()
    if not known:
        raise FileNotFoundError(f"no Parquet files of the expected layout below {root}")
    columns = [dict(c.split(":", 1) for c in r.signature.split("|") if c) for r in known]
    names = {name for c in columns for name in c}
    if any(len({c[name] for c in columns if name in c}) > 1 for name in names):
        return _read_each_schema(spark, root, schemas, raw)

    # One file of each schema tells the types of all columns.
    whole = parquet_reader(spark).parquet(*(_as_pattern(r.path) for r in known)).schema
    if raw:
        frame = read_raw_shards(spark, root, schema=whole)
    else:
        frame = read_partitioned(spark, root, merge_schema=False, schema=whole)
        frame = frame if corpus is None else frame.where(F.col("corpus") == corpus)
    if len(known) == 1:
        return [Scan(frame)]
    numbers = F.create_map(*[F.lit(x) for n, r in enumerate(known) for x in (r.signature, n)])
    others = schemas.where(F.col("signature") != known[0].signature)
    others = others.select(F.col("path").alias(SOURCE_FILE), F.try_element_at(numbers, F.col("signature")).alias(SCHEMA))
    frame = frame.join(as_lookup(others, "file-schemas"), SOURCE_FILE, "left")
    frame = frame.withColumn(SCHEMA, F.coalesce(SCHEMA, F.lit(0)))
    lacking = {name: [n for n, c in enumerate(columns) if name not in c] for name in names}
    return [Scan(frame, {name: ~F.col(SCHEMA).isin(*n) for name, n in lacking.items() if n})]


def _read_each_schema(spark: SparkSession, root: str, schemas: DataFrame, raw: bool) -> list[Scan]:
    """A scan per schema, to which the driver names folders, and the files of mixed folders."""
    places = schema_groups(schemas).orderBy("signature", "place").collect()
    groups: dict[str, list[str]] = {}
    for p in places:
        groups.setdefault(p.signature, []).append(_as_pattern(p.place))
    if raw:
        return [Scan(read_raw_shards(spark, root, group)) for group in groups.values()]
    return [Scan(read_partitioned(spark, root, merge_schema=False, files=group)) for group in groups.values()]


def _as_pattern(path: str) -> str:
    """A listed path as a reader path, with glob characters escaped."""
    escaped = re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
    return escaped if path.endswith(".parquet") else f"{escaped}/*.parquet"


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
