"""The published table: checks, merge, deduplication, renaming, pruning, districts' fill, nested counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import rules as R
from tidemark.operators.records import in_rank_order
from tidemark.session import delete, staged, staging_path
from tidemark.sources.tables import RECORDS

HASH_ID = "-x[0-9a-f]{8}$"
PENDING = "PENDING"

# What a record that the pipeline made says of itself; its origin is read from the first note ---------
PIPELINE_MARK = "のパイプライン (S1-S4) による収集"
ORIGIN_NOTE = (
    "2026-09-08 のパイプライン (S1-S4) による収集。自治体・観光協会・県教育委員会のページ本文から名称を抽出し、対象judgment・別名統合・所在の帰属をAIが行った。"
    "個別ページによる裏取りは未実施のため status は candidate。"
)
SOCIETY_NOTE = "情報源では保存会・連合会の名称として現れた。行事名に整形してあるが、行事そのものの名称としての確認は未実施。"
HASH_NOTE = "名称の読みを確認できなかったため、IDはハッシュで採番している。"
SUPPORTS = "name_mentioned"
REQUIRED = ("name", "status", "confidence", "prefecture", "municipality")
NON_EMPTY = ("categories", "sources")


class PublishError(ValueError):
    """The table breaks a rule of its consumers; nothing was written."""


def is_blank(c: Column, kind: str) -> Column:
    """Null, '' or an empty array: what a merge may fill."""
    if kind == "string":
        return F.coalesce(c, F.lit("")) == ""
    return c.isNull() | (F.size(c) == 0) if kind.startswith("array") else c.isNull()


def violations(df: DataFrame, id_col: str, required: Sequence[str], non_empty: Sequence[str] = ()) -> DataFrame:
    """(rule, n): rows with a blank required column or an empty list, and ids that more than one row has. One pass and one aggregate."""
    kinds = dict(df.dtypes)
    counts = [F.sum(is_blank(F.col(c), kinds[c]).cast("long")).alias(f"blank:{c}") for c in [*required, *non_empty]]
    blank = df.agg(*counts)
    rows = blank.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in blank.columns]), F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in blank.columns]))).alias("rule", "n"))
    repeated = df.groupBy(id_col).count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit(f"repeated:{id_col}").alias("rule"), "n")
    return rows.unionByName(repeated)


def check(df: DataFrame, id_col: str, required: Sequence[str], non_empty: Sequence[str] = ()) -> None:
    bad = [f"{r['rule']}: {r['n']} rows" for r in violations(df, id_col, required, non_empty).filter("n > 0").collect()]
    if bad:
        raise PublishError("; ".join(bad))


def checked(df: DataFrame, id_col: str, required: Sequence[str], non_empty: Sequence[str] = ()) -> DataFrame:
    """df, staged, if it breaks no rule of `violations`; otherwise PublishError, and what was staged is deleted.

    Blank columns are counted by observation while the table is staged, so df is computed once; ids are looked through in
    the staged table, where only their column is read. What is checked is what is there to be written.
    """
    kinds = dict(df.dtypes)
    seen = Observation("blank")
    counts = {f"blank:{c}": F.count_if(is_blank(F.col(c), kinds[c])) for c in [*required, *non_empty]}
    spark, path = df.sparkSession, staging_path(df.sparkSession, "checked")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[n.alias(f"c{i}") for i, n in enumerate(counts.values())]).write.parquet(path)
    rows, found = spark.read.schema(df.schema).parquet(path), seen.get
    bad = [f"{name}: {found[f'c{i}']} rows" for i, name in enumerate(counts) if found.get(f"c{i}")]
    if repeated := rows.groupBy(id_col).count().filter("count > 1").count():
        bad.append(f"repeated:{id_col}: {repeated} rows")
    if bad:
        delete(spark, path)
        raise PublishError("; ".join(bad))
    return rows


def merge_groups(df: DataFrame, key: list[str], id_col: str, name: str, ord_col: str, aliases: str, sources: str, fill: Sequence[str], curated: str) -> DataFrame:
    """One row per key that several rows have, if none of them is curated: the merged record.

    The head is the row with a reading id, then the most sources, then the first. Blank fields of the head are
    filled from the others in that order; aliases take the others' names and aliases, sources the union.
    """
    kinds = dict(df.dtypes)
    none = lambda c: F.coalesce(F.col(c), F.array().cast(kinds[c]))
    rank = F.struct(F.when(F.col(id_col).rlike(HASH_ID), 1).otherwise(0).alias("a"), (-F.size(none(sources))).alias("b"), F.col(ord_col).alias("c"))

    def filled(c: str) -> Column:
        full = ~is_blank(F.col(c), kinds[c])
        return F.coalesce(F.min_by(F.when(full, F.col(c)), F.when(full, rank)), F.min_by(c, rank)).alias(c)

    heads = df.groupBy(*key).agg(
        F.count("*").alias("merged"), F.max(F.col(curated).cast("int")).alias("__curated"), F.min_by(id_col, rank).alias(id_col), F.min_by(name, rank).alias(name), *[filled(c) for c in fill]
    ).filter("merged > 1 and __curated = 0")
    names = in_rank_order(df, key, F.concat(F.array(name), none(aliases)), rank, "__names")
    links = in_rank_order(df, key, none(sources), rank, "__sources")
    return heads.join(names, key, "left").join(links, key, "left").select(
        *key, id_col, name, F.array_remove("__names", F.col(name)).alias(aliases), F.coalesce("__sources", F.array().cast(kinds[sources])).alias(sources), *fill, "merged"
    )


def id_clashes(kept: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """The ids that both tables have: any of them stops a merge."""
    return kept.select(id_col).intersect(new.select(id_col))


def upsert(existing: DataFrame, new: DataFrame, id_col: str, scope: Column, made_here: Column, replace: bool) -> DataFrame:
    """existing plus new: with replace, rows of the scope that the pipeline itself made go first; curated rows always stay."""
    kept = existing.filter(~(scope & made_here)) if replace else existing
    clash = [r[0] for r in id_clashes(kept, new, id_col).limit(5).collect()]
    if clash:
        raise PublishError(f"ids exist already: {clash}")
    return kept.unionByName(new, allowMissingColumns=True)


def made_here(notes: str = "notes") -> Column:
    """Whether a record's notes carry the pipeline's mark."""
    return F.contains(F.coalesce(notes, F.lit("")), F.lit(PIPELINE_MARK))


def build_records(rows: DataFrame, accessed: str) -> DataFrame:
    """Published records (the schema RECORDS) from judged rows.

    rows: (slug, name, aliases, prefecture, municipality, venue, usual_schedule, date_note, categories, source_urls,
    s4_reason), lists as arrays. Only what a source stated goes in: every address becomes a source that supports the name
    alone, blank venues and schedules are null, everything else is null or empty. Without a category a record is
    unclassified; its own name is no alias.
    """
    none = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    full = lambda c: F.filter(none(c), lambda x: x != "")
    blank = lambda c: F.nullif(c, F.lit(""))
    source = lambda u: F.struct(u.alias("url"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("publisher"), F.lit(accessed).alias("accessed"), F.array(F.lit(SUPPORTS)).alias("supports"))
    notes = F.concat_ws(" / ", blank("date_note"), F.lit(ORIGIN_NOTE), F.when(F.col("s4_reason") == "organization", SOCIETY_NOTE), F.when(F.regexp_extract("slug", "[^-]*$", 0).startswith("x"), HASH_NOTE))
    given = {
        "id": F.col("slug"), "name": F.col("name"), "aliases": F.filter(full("aliases"), lambda x: x != F.col("name")), "status": F.lit("candidate"), "confidence": F.lit("low"), "prefecture": F.col("prefecture"),
        "municipality": F.col("municipality"), "venue": blank("venue"), "usual_schedule": blank("usual_schedule"), "categories": F.when(F.size(full("categories")) > 0, full("categories")).otherwise(F.array(F.lit("unclassified"))),
        "sources": F.transform(full("source_urls"), source), "notes": notes, "event_dates": F.array(), "features": F.array(),
    }
    scale = F.from_json(F.lit('{"other": []}'), RECORDS["scale"].dataType)
    return rows.select(*[(scale if f.name == "scale" else given.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in RECORDS.fields])


def merge_actions(existing: DataFrame, judged: DataFrame, prefecture: str, accessed: str, replace: bool = False) -> DataFrame:
    """(action, rule, id, record) of a prefecture's merge: what becomes of every existing record and of every judged row.

    existing: RECORDS, ids unique. judged: what build_records reads, with s4_verdict and s4_alias_of; rows of other
    prefectures, dropped rows and aliases play no part. Actions: kept, removed and replaced of existing records; added,
    withheld and blocked of new ones. rule names what decided: other_prefecture, curated, existing, pipeline, same_id (for
    existing records); new, pending (no id yet), id, name (an id, or a name or alias of one place, that is there already).

    With replace, records of the prefecture that the pipeline itself made go, or give way to the new record of their id,
    and only curated ones of the prefecture guard their ids and names; otherwise all existing records stay and guard.
    One full join on ids decides; names are looked up before it by place and key.
    """
    home = F.col("prefecture") == prefecture
    goes = home & made_here() if replace else F.lit(False)
    guards = home & ~made_here() if replace else F.lit(True)
    have = existing.withColumn("__goes", goes).withColumn("__guards", guards)
    own = judged.filter((F.col("s4_verdict") == "keep") & (F.coalesce("s4_alias_of", F.lit("")) == "") & home & (F.coalesce("slug", F.lit("")) != ""))
    new = build_records(own, accessed).withColumn("__key", K.dedup_key(F.col("name")))
    place = ["prefecture", "municipality", "__key"]
    none = F.coalesce("aliases", F.array().cast("array<string>"))
    taken = have.filter("__guards").select("prefecture", "municipality", F.explode(F.concat(F.array("name"), none)).alias("__name")).select("prefecture", "municipality", K.dedup_key(F.col("__name")).alias("__key")).distinct()
    new = new.join(taken.withColumn("__taken", F.lit(True)), place, "left")
    names = [f.name for f in RECORDS.fields]
    pending = F.col("id") == PENDING
    left = have.select(F.col("id").alias("__id"), F.struct(*names).alias("__old"), "__goes", "__guards", home.alias("__home"), made_here().alias("__made"))
    # Rows without an id of their own must not meet anything: they join by null.
    right = new.select(F.when(~pending, F.col("id")).alias("__new_id"), F.struct(*names).alias("__new"), F.col("__taken").isNotNull().alias("__taken"), pending.alias("__pending"))
    both = left.join(right, F.col("__id") == F.col("__new_id"), "full")
    of = lambda action, rule, record: F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"), record.alias("record"))
    old, fresh, there = F.col("__old"), F.col("__new"), F.col("__id").isNotNull()
    blocked = F.when(F.col("__pending"), of("withheld", "pending", fresh)).when(there & F.col("__guards"), of("blocked", "id", fresh)).when(F.col("__taken"), of("blocked", "name", fresh))
    of_old = (
        F.when(F.col("__goes") & fresh.isNotNull() & blocked.isNull(), of("replaced", "same_id", old)).when(F.col("__goes"), of("removed", "pipeline", old))
        .when(~F.col("__home"), of("kept", "other_prefecture", old)).when(~F.col("__made"), of("kept", "curated", old)).otherwise(of("kept", "existing", old))
    )
    outcomes = F.array_compact(F.array(F.when(there, of_old), F.when(fresh.isNotNull(), F.coalesce(blocked, of("added", "new", fresh)))))
    return both.select(F.explode(outcomes).alias("x")).select("x.action", "x.rule", F.col("x.record.id").alias("id"), "x.record")


def merge(existing: DataFrame, judged: DataFrame, prefecture: str, accessed: str, replace: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, actions): the published table after merge_actions, and those.

    replace None refuses to run where the prefecture has records that the pipeline made. A record without what its
    readers need, or an id that the table would have twice, raises PublishError. Actions are staged: they are computed
    once, for the checks, the counts and the table.
    """
    if replace is None and (old := existing.filter((F.col("prefecture") == prefecture) & made_here()).limit(1).count()):
        raise PublishError(f"{prefecture} has pipeline records ({old} or more): say whether to replace or to add")
    actions = staged(merge_actions(existing, judged, prefecture, accessed, bool(replace)), "merge-actions")
    check(actions.filter("action = 'added'").select("record.*"), "id", REQUIRED, NON_EMPTY)
    table = actions.filter(F.col("action").isin("kept", "added")).select("record.*")
    if twice := [r[0] for r in table.groupBy("id").count().filter("count > 1").select("id").orderBy("id").limit(5).collect()]:
        raise PublishError(f"ids exist already: {twice}")
    return table, actions


def action_counts(actions: DataFrame) -> DataFrame:
    """(action, rule, n)."""
    return actions.groupBy("action", "rule").agg(F.count("*").alias("n"))


def rename(df: DataFrame, name: str, new_name: Column, aliases: str, made_here: Column) -> DataFrame:
    """Names to new_name in pipeline rows where that leaves two characters; the old name joins the aliases, ids stay."""
    change = made_here & (F.length(new_name) >= 2) & (new_name != F.col(name))
    old = F.array_union(F.coalesce(F.col(aliases), F.array().cast("array<string>")), F.array(F.col(name)))
    return df.withColumn(aliases, F.when(change, F.array_remove(old, new_name)).otherwise(F.col(aliases))).withColumn(name, F.when(change, new_name).otherwise(F.col(name)))


def prune(df: DataFrame, name: str, not_a_name: str = R.NOT_A_NAME) -> DataFrame:
    return df.filter(~F.coalesce(F.col(name).rlike(not_a_name), F.lit(False)))


def fill_blank(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Fills blanks only; what is there stays."""
    return df.withColumn(column, F.when(is_blank(F.col(column), "string"), value).otherwise(F.col(column)))


def nested_counts(df: DataFrame, levels: list[str]) -> DataFrame:
    """(levels, n, depth): counts of every level and in total, as a page's headings show them."""
    grouping = reduce(lambda a, b: a + b, [F.grouping(c) for c in levels])
    return df.rollup(*levels).agg(F.count("*").alias("n"), (F.lit(len(levels)) - grouping).cast("long").alias("depth"))
