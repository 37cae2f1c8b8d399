"""Roll-ups of the access ledger, and its completion from other records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import sinks, tables

KINDS = ("fetch", "robots", "fail", "denied", "capped")


def by_host(ledger: DataFrame, host: str, day: str, kind: str, size: str, kinds: tuple[str, ...] = KINDS, other: str = "fail") -> DataFrame:
    """(host, first, last, one count per kind, bytes): unknown kinds count as `other`, sizes that aren't digits as nothing."""
    folded = F.when(F.col(kind).isin(*kinds), F.col(kind)).otherwise(other)
    days = F.when(F.col(day) != "", F.col(day))
    return ledger.groupBy(host).agg(
        F.min(days).alias("first"), F.max(days).alias("last"), *[F.count_if(folded == k).alias(k) for k in kinds],
        F.sum(F.when(F.col(size).rlike("^[0-9]+$"), F.col(size).try_cast("bigint")).otherwise(0)).alias("bytes"),
    )


def by_day(ledger: DataFrame, day: str, kind: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(day, one count per kind, other): raw kinds; what is none of them is `other`, so malformed rows stay visible."""
    return ledger.groupBy(day).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds], F.count_if(~F.col(kind).isin(*kinds) | F.col(kind).isNull()).alias("other"))


def by_group(hosts: DataFrame, groups: DataFrame, host: str, group: str, label: str = "unlabelled") -> DataFrame:
    """Counts of responding hosts and their totals per group of hosts; hosts in no group count under `label`."""
    answered = hosts.filter(F.col("fetch") > 0)
    return answered.join(groups.select(host, group).dropDuplicates([host]), host, "left").groupBy(F.coalesce(group, F.lit(label)).alias(group)).agg(
        F.count("*").alias("hosts"), F.sum("fetch").alias("fetch"), F.sum("bytes").alias("bytes")
    )


def backfill(ledger: DataFrame, failures: DataFrame, kind: str = "kind", url: str = "url") -> DataFrame:
    """Rows of failures that the ledger doesn't have, as ledger rows: `HTTP NNN` in the reason gives the status."""
    status = F.regexp_extract("reason", r"HTTP ([0-9]{3})", 1)
    rows = failures.select(F.col("date").alias("ts"), F.lit("fail").alias(kind), F.col(url), status.alias("status"), F.lit("0").alias("bytes"), F.lit("").alias("final_url"), F.col("reason").alias("note"))
    return rows.join(ledger.select(kind, url).distinct(), [kind, url], "left_anti").select(rows.columns)


def update_counts(spark: SparkSession, log: str, state: str, keep: int = sinks.KEPT_VERSIONS) -> DataFrame:
    """Brings the counts kept in `state` up to date with the ledger's folder `log`; gives (host, day, kind, n, bytes, through).

    Only files whose path sorts behind `through`, the last one counted, are read: a ledger's files are only ever added, each
    with a path behind all earlier ones (a folder a day, numbered files). Partial counts of the new lines are merged with
    those kept, so a run costs the new lines and the number of (host, day, kind), not the ledger. The counts and the
    mark are one versioned table: a run that dies changes nothing, and of two runs at once one raises ConflictError.
    """
    base = sinks.table_version(spark, state)
    old = sinks.read_current(spark, state, base) if base else None
    through = old.agg(F.max("through")).first()[0] if old is not None else None
    lines = spark.read.option("recursiveFileLookup", "true").text(log)
    path = F.col("_metadata.file_path")
    fresh = lines if through is None else lines.filter(path > through)
    cells = tables.ledger_cells(fresh.select("value", path.alias("file")).filter("value <> ''"), "file")
    named = cells.withColumn("host", F.coalesce(F.lower(F.try_parse_url("url", F.lit("AUTHORITY"))), F.lit(""))).withColumn("day", F.substring("ts", 1, 10))
    counted = named.groupBy("host", "day", "kind").agg(F.count("*").alias("n"), F.sum(F.when(F.col("bytes").rlike("^[0-9]+$"), F.col("bytes").try_cast("bigint")).otherwise(0)).alias("bytes"), F.max("file").alias("through"))
    both = counted if old is None else counted.unionByName(old)
    merged = both.groupBy("host", "day", "kind").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max("through").alias("through"))
    sinks.replace_table(merged, state, base, keep)
    return sinks.read_current(spark, state, base + 1)


def hosts_of_counts(counts: DataFrame, kinds: tuple[str, ...] = KINDS, other: str = "fail") -> DataFrame:
    """by_host from partial counts: the same rows as from the ledger's lines."""
    folded = F.when(F.col("kind").isin(*kinds), F.col("kind")).otherwise(other)
    days = F.when(F.col("day") != "", F.col("day"))
    total = lambda k: F.coalesce(F.sum(F.when(folded == k, F.col("n"))), F.lit(0)).alias(k)
    return counts.groupBy("host").agg(F.min(days).alias("first"), F.max(days).alias("last"), *[total(k) for k in kinds], F.sum("bytes").alias("bytes"))


def days_of_counts(counts: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """by_day from partial counts."""
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return counts.groupBy("day").agg(*[total(F.col("kind") == k).alias(k) for k in kinds], total(~F.col("kind").isin(*kinds) | F.col("kind").isNull()).alias("other"))
