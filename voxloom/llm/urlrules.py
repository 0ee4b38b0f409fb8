"""URL filters: a sort-merge range join of URLs and rules.

A rule names a host, with its subdomains, and the beginning of a path. Written with
the host's labels reversed, ``com.example/en/``, a rule is the interval of all keys
that begin with it, and a URL falls in it under the key of one of its host's suffixes.
Intervals of prefixes are nested or apart, so a sweep over the sorted keys needs a
stack: a rule's begin pushes it, its end uncovers the rule around it, and a URL's key
belongs to the rule on top.

The sweep runs in ranges of the sorted keys, and each rule enters every range that it
reaches into. All of it is DataFrame expressions and windows within ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import RESERVED, checked, with_columns
from voxloom.session import as_lookup, cut_lineage

#: The verdict on URLs that no rule fits.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _end(key: str) -> Column:
    """End of the interval of a prefix: the prefix and a byte that no UTF-8 text has."""
    return F.concat(key, F.unhex(F.lit("FF")))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per host and path: of contradicting rules, a block stands."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    rules = rules.where("host is not null and path is not null and verdict is not null")
    rules = rules.select(host.alias("host"), "path", "verdict")
    return rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        reversed_host(F.col("host")).alias("suffix"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("top"),
        F.encode(F.concat(reversed_host(F.col("host")), "path"), "utf-8").alias("key"),
        F.size(F.split("host", r"\.")).alias("labels"),
    )


def _ranges(df: DataFrame, *order: str) -> DataFrame:
    """Deal rows by range; ``bin`` numbers the range, and the written table fixes it."""
    dealt = df.repartitionByRange(*order).withColumn("bin", F.spark_partition_id())
    return cut_lineage(df.sparkSession, dealt, "ranges")


def _reach(rules: DataFrame, bounds: list) -> DataFrame:
    """Rules with the number of every range that their interval reaches into."""
    first = F.array(*(F.lit(b["first"]) for b in bounds))
    last = F.array(*(F.lit(b["last"]) for b in bounds))
    bins = F.array(*(F.lit(b["bin"]) for b in bounds))
    begin = F.size(F.filter(last, lambda x: x < F.col("key")))
    end = F.size(F.filter(first, lambda x: x < _end("key")))
    hit = F.when(begin < end, F.slice(bins, begin + 1, end - begin))
    return rules.withColumn("bin", F.explode(hit))


def _breaks(rules: DataFrame) -> DataFrame:
    """Where the top of the stack changes: ``key``, and the rule on ``top`` from there.

    Depths come from counting begins and ends; the rule around another is the last one
    that began at the depth above.
    """
    ends = rules.withColumn("at", _end("key")).withColumn("step", F.lit(-1))
    begins = rules.withColumn("at", F.col("key")).withColumn("step", F.lit(1))
    by_key = Window.partitionBy("bin").orderBy("at", "step").rowsBetween(Window.unboundedPreceding, 0)
    events = begins.unionByName(ends).withColumn("depth", F.sum("step").over(by_key))
    # At its begin a rule is at its own depth; at its end, back at that of the rule around.
    began = Window.partitionBy("bin", "depth").orderBy("at", "step")
    began = began.rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("step") == 1, F.struct("top"))
    around = F.last(own, ignorenulls=True).over(began)
    top = F.when(F.col("depth") > 0, around)
    return events.select("bin", F.col("at").alias("key"), F.struct(top.alias("rule")).alias("change"))


def swept(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``keys`` (with ``bin``) with the innermost rule around each, or null, as ``top``."""
    breaks = _breaks(rules)
    rows = keys.withColumn("change", F.lit(None).cast(breaks.schema["change"].dataType))
    rows = rows.withColumn("probe", F.lit(1)).unionByName(
        breaks.withColumn("probe", F.lit(0)), allowMissingColumns=True
    )
    # A rule begins before the URL of its own key.
    order = Window.partitionBy("bin").orderBy("key", "probe")
    order = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("change", F.last("change", ignorenulls=True).over(order))
    return rows.where("probe = 1").withColumn("top", F.col("change.rule.top")).drop("change", "probe")


def _target(id_column: str) -> Column:
    """What a row's keys are called by: 96 bits that stand for its id, host and path."""
    row = [F.col(f"`{id_column}`"), F.col("host"), F.col("path")]
    return F.struct(F.xxhash64(*row).alias("a"), F.hash(*row).alias("b"))


def judge(df: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its
    host and all subdomains where the path begins with the rule's; the longest wins,
    by host and path together, then by host. Of two verdicts on one rule, block wins;
    rules with a null are ignored. URLs without a rule, null ones too, get ``default``
    and a null rule. A row comes back for each row, repeated ones too; an empty table
    stays empty. Columns of the input with the names of the results are replaced.
    """
    checked(df, id_column, url_column)
    spark = df.sparkSession
    rules = cut_lineage(spark, _prepared(rules), "rules")
    host, path = host_and_path(F.col(f"`{url_column}`"))
    judged = with_columns(df, {"host": host, "path": path})
    depths = sorted(r[0] for r in rules.select("labels").distinct().collect())
    probes = judged.select(
        _target(id_column).alias("target"),
        "path",
        F.split("host", r"\.").alias("labels"),
    )
    # Only suffixes with as many labels as some rule's host; hosts have few labels.
    suffixes = F.array_compact(
        F.array(
            F.lit(None).cast("string"),
            *(
                F.when(
                    F.size("labels") >= n,
                    F.array_join(F.reverse(F.slice("labels", F.size("labels") - (n - 1), F.lit(n))), "."),
                )
                for n in depths
            ),
        )
    )
    probes = probes.select("target", "path", F.explode(suffixes).alias("suffix"))
    hosts = as_lookup(rules.select("suffix").distinct(), "rule_hosts")
    probes = probes.join(hosts, "suffix", "left_semi").select(
        "target", F.encode(F.concat("suffix", "path"), "utf-8").alias("key")
    )
    # The second column parts the copies of a URL that very many rows have.
    probes = _ranges(probes, "key", "target")
    bounds = probes.groupBy("bin").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    bounds = bounds.orderBy("first", "last").collect()  # a row for each shuffle partition
    found_type = "struct<length: int, host_length: int, rule: string, verdict: string>"
    if bounds:
        found = swept(probes, _reach(rules.select("top", "key"), bounds))
        found = found.groupBy("target").agg(F.max("top").alias(f"{RESERVED}top"))
        found = found.where(F.col(f"{RESERVED}top").isNotNull())
        found = cut_lineage(spark, found.withColumnRenamed("target", f"{RESERVED}target"), "judged")
        judged = judged.withColumn(f"{RESERVED}target", _target(id_column))
        judged = judged.join(found, f"{RESERVED}target", "left").drop(f"{RESERVED}target")
    else:
        judged = judged.withColumn(f"{RESERVED}top", F.lit(None).cast(found_type))
    top = F.col(f"{RESERVED}top")
    verdict = F.coalesce(top["verdict"], F.lit(default))
    return with_columns(judged, {"rule": top["rule"], "verdict": verdict}).drop(f"{RESERVED}top")
