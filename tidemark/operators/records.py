"""From candidate rows to one record per event: prefix variants, representative names, groups, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged


def prefix_targets(df: DataFrame, scope: list[str], key: str, least: int = 4) -> DataFrame:
    """(scope, key, target): the shortest other key of the scope, of `least` characters or more, that begins the key.

    One hop: a target is looked up for each key on its own. Instead of comparing keys pairwise, every key offers its
    own prefixes to an equality join, so the cost is the keys' length and a scope with many keys is no hot spot.
    """
    keys = df.select(*scope, key).distinct()
    lengths = F.sequence(F.lit(least), F.length(key) - 1)
    offers = keys.filter(F.length(key) > least).select(*scope, key, F.explode(lengths).alias("__n")).withColumn("__p", F.substring(F.col(key), F.lit(1), F.col("__n")))
    bases = keys.filter(F.length(key) >= least).select(*scope, F.col(key).alias("__p"))
    found = offers.join(bases, [*scope, "__p"]).groupBy(*scope, key).agg(F.min_by("__p", "__n").alias("target"))
    return keys.join(found, [*scope, key], "left").select(*scope, key, F.coalesce("target", key).alias("target"))


def representative(df: DataFrame, group: list[str], name: str, ord_col: str, own_key: Column) -> DataFrame:
    """(group, name, n_names): of a group's names one that equals the group's own key first, then the most frequent, the shortest, the first seen.

    Two aggregates: names with their counts, then the best of them; no window and no list of all rows.
    """
    counted = df.groupBy(*group, name).agg(F.count("*").alias("__c"), F.min(ord_col).alias("__o"), F.max(own_key.cast("int")).alias("__own"))
    rank = F.struct((1 - F.col("__own")).alias("a"), (-F.col("__c")).alias("b"), F.length(name).alias("c"), F.col("__o").alias("d"))
    return counted.groupBy(*group).agg(F.min_by(name, rank).alias(name), F.count("*").alias("n_names"), F.array_sort(F.collect_set(name)).alias("__names"))


def normalize_groups(
    df: DataFrame, group: list[str], name: str, ord_col: str, own_key: Column, url: str, venue: str, date: str, origin: str, reason: str, context: str,
    cap: int = 8, most_context: int = 600,
) -> DataFrame:
    """One record per group: name, aliases, venue, date, source_count, source_urls, origins, reasons, context.

    First values are those of the smallest ord; sets are sorted; urls are counted before they are capped.
    """
    chosen = representative(df, group, name, ord_col, own_key)
    # No more than most_context rows can show in the context; the rank limit is applied before the shuffle.
    early = df.filter(F.col(context).isNotNull()).withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(ord_col))).filter(F.col("__r") <= most_context)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", context))), lambda s: s[context]), " ")
    contexts = early.groupBy(*group).agg(F.substring(joined, 1, most_context).alias("context"))
    facts = df.groupBy(*group).agg(
        F.coalesce(F.min_by(F.when(F.col(venue) != "", F.col(venue)), F.when(F.col(venue) != "", F.col(ord_col))), F.lit("")).alias("venue"),
        F.coalesce(F.min_by(F.when(F.col(date) != "", F.col(date)), F.when(F.col(date) != "", F.col(ord_col))), F.lit("")).alias("date_text"),
        F.array_sort(F.collect_set(F.when(F.col(url) != "", F.col(url)))).alias("__urls"),
        F.array_sort(F.collect_set(origin)).alias("origins"), F.array_sort(F.collect_set(reason)).alias("reasons"),
    )
    out = chosen.join(facts, group).join(contexts, group, "left")
    return out.select(
        *group, name, F.array_except("__names", F.array(name)).alias("aliases"), "venue", "date_text", F.size("__urls").cast("long").alias("source_count"),
        F.slice("__urls", 1, cap).alias("source_urls"), "origins", "reasons", "context",
    )


def own_ids(df: DataFrame, slug: str, id_col: str) -> DataFrame:
    """df with owner: the smallest id of the rows that want the same slug; that row keeps the slug, the others are its aliases."""
    owners = df.filter(F.coalesce(F.col(slug), F.lit("")) != "").groupBy(slug).agg(F.min(id_col).alias("owner"))
    return df.join(owners, slug, "left").withColumn("keeps_slug", F.col("owner") == F.col(id_col))


def in_rank_order(df: DataFrame, group: list[str], values: Column, rank: Column, name: str) -> DataFrame:
    """(group, name): the distinct values of an array column over a group's rows, by the first row and place that has each.

    Two aggregates: values with their best place, then those sorted; a group's rows are never gathered.
    """
    each = df.select(*group, rank.alias("__rank"), F.posexplode(values).alias("__pos", "__value"))
    best = each.groupBy(*group, "__value").agg(F.min(F.struct("__rank", "__pos")).alias("__at"))
    listed = F.array_sort(F.collect_list(F.struct("__at", "__value")))
    return best.groupBy(*group).agg(F.transform(listed, lambda x: x["__value"]).alias(name))


def merge_same_names(df: DataFrame, group: list[str], id_col: str, name: str, urls: str, cap: int = 8) -> DataFrame:
    """One row per group: the canonical row (most urls, then smallest id), its aliases and the union of urls in that order, capped after counting."""
    rank = F.struct((-F.size(urls)).alias("r"), F.col(id_col).alias("id"))
    heads = df.groupBy(*group).agg(F.min_by(id_col, rank).alias("canonical"), F.min_by(name, rank).alias("name"), F.count("*").alias("members"))
    names = in_rank_order(df, group, F.array(name), rank, "__names")
    links = in_rank_order(df, group, F.col(urls), rank, "__urls")
    same = lambda a, b: a.join(b, group, "left")
    listed = F.coalesce("__urls", F.array().cast(dict(df.dtypes)[urls]))
    return same(same(heads, names), links).select(
        *group, "canonical", "name", F.array_remove("__names", F.col("name")).alias("aliases"), F.size(listed).cast("long").alias("source_count"), F.slice(listed, 1, cap).alias("source_urls"), "members",
    )


def numbered(df: DataFrame, order: list[str], partition: list[str] | None = None, width: int = 5) -> DataFrame:
    """df with a 1-based, zero-padded id in the given order, within each partition if one is given.

    Without a partition, ranks come from a range partitioning: each range is counted, and its rows are numbered
    from the sum of the ranges before it, so no task holds the whole table.
    """
    number = F.lpad(F.col("__n").cast("string"), width, "0").alias("id")
    if partition:
        w = Window.partitionBy(*partition).orderBy(*order)
        return df.withColumn("__n", F.row_number().over(w)).select("*", number)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: the range borders come from a sample, and both uses below must see the same ones.
    ranged = staged(df.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id()), "ranked")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return ranged.join(F.broadcast(sizes.select("__p", before.alias("__b"))), "__p").withColumn("__n", local + F.col("__b")).select(*df.columns, number, "__n")


def batches(df: DataFrame, order: list[str], size: int, partition: list[str] | None = None) -> DataFrame:
    """df with id and batch_no: rows in order, `size` to a batch."""
    return numbered(df, order, partition).withColumn("batch_no", (F.floor((F.col("__n") - 1) / size) + 1).cast("int")).drop("__n")


def carry_forward(df: DataFrame, partition: list[str], order: str, value: Column, name: str) -> DataFrame:
    """df with the last non-null value at or before each row (headings over rows)."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))
