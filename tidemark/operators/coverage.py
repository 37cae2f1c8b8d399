"""Vocabulary, gaps, novelty and evaluation against known sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.session import staged


def vocabulary(df: DataFrame, scope: str, terms: Column, category: str, example: str, ord_col: str, covered: Column) -> DataFrame:
    """(scope, term): how many rows give the term, whether the given words cover it, its categories and first example."""
    rows = df.select(scope, category, example, ord_col, F.posexplode(terms).alias("__pos", "term"))
    out = rows.groupBy(scope, "term").agg(F.count("*").alias("source_count"), F.array_sort(F.collect_set(category)).alias("categories"), F.min_by(example, F.struct(ord_col, "__pos")).alias("example"))
    return out.withColumn("covered", F.when(covered, "yes").otherwise("no"))


def named_rows(national: DataFrame, registries: list[DataFrame]) -> DataFrame:
    """(prefecture, name, category, subcategory, ord) of all registries, in their order.

    national: (prefecture, name, category, subcategory, ord). registries: (prefecture, name, kind, ord); a kind is their
    category. ord: the registry's place in the list, then the row's in it.
    """
    at = lambda i: F.struct(F.lit(i).alias("registry"), F.col("ord").cast("long").alias("ord")).alias("ord")
    rows = national.select("prefecture", "name", "category", F.coalesce("subcategory", F.lit("")).alias("subcategory"), at(0))
    for i, registry in enumerate(registries, 1):
        rows = rows.unionByName(registry.select("prefecture", "name", F.col("kind").alias("category"), F.lit("").alias("subcategory"), at(i)))
    return rows


def regional_vocabulary(national: DataFrame, registries: list[DataFrame], places: DataFrame, terms: Column, covered: Column, skip: str = R.SKIP_SUBCATEGORY) -> DataFrame:
    """(prefecture, term, covered, source_count, categories, example): the words of designated names, ready to be looked for on pages.

    national, registries: see named_rows; places: (place). terms: the terms of `name`, an array; covered: whether the known
    words cover `term`. Rows without prefecture or name, and of subcategories that `skip` finds, give no terms; terms that
    are or hold a place are left out. Blank categories don't count; the example is the first name by registry and row.
    """
    rows = named_rows(national, registries).filter((F.coalesce("prefecture", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "") & ~F.col("subcategory").rlike(skip))
    rows = rows.withColumn("category", F.nullif("category", F.lit("")))
    out = vocabulary(rows, "prefecture", terms, "category", "name", "ord", covered)
    return without_places(out, "term", places, "place")


def without_places(terms: DataFrame, term: str, places: DataFrame, place: str, least: int = 3) -> DataFrame:
    """Terms that are no place and hold no place name of `least` characters or more.

    Each term offers its substrings of the lengths that place names have to an equality anti join, so the places may be
    many and a term's length costs its own characters times those few lengths.
    """
    names = places.select(F.col(place).alias("__g")).filter(F.col("__g") != "").distinct()
    keyed = terms.select(term).distinct()
    size = F.length(term)
    lengths = sorted(r["n"] for r in names.select(F.length("__g").alias("n")).filter(F.col("n") >= least).distinct().collect())  # as many as there are lengths
    own = F.array(F.col(term))

    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1)))
        return F.when(size >= n, F.transform(starts, lambda i: F.substring(F.col(term), i, F.lit(n)))).otherwise(own)

    runs = [runs_of(n) for n in lengths]
    pieces = keyed.filter(size > 0).select(term, F.explode(F.array_distinct(F.concat(own, *runs))).alias("__g"))
    bad = pieces.join(names, "__g", "left_semi").select(term).distinct()
    return terms.join(bad, term, "left_anti")


def uncovered(sites: DataFrame, key: list[str], registries: list[DataFrame], has_site: Column) -> DataFrame:
    """Sites that no registry has a row for: one anti join against the union of the registries' keys."""
    seen = reduce(lambda a, b: a.unionByName(b), [r.select(*key) for r in registries]).distinct()
    return sites.filter(has_site).join(seen, key, "left_anti")


def novelty(df: DataFrame, scope: str, key: str, known: DataFrame, other: DataFrame) -> DataFrame:
    """Per scope and in total: distinct keys, of them in known, in other, in neither, and the share that is new.

    Two left joins on distinct keys and one rollup.
    """
    rows = df.select(scope, key).distinct()
    out = rows.join(known.select(scope, key).distinct().withColumn("__a", F.lit(1)), [scope, key], "left").join(other.select(scope, key).distinct().withColumn("__b", F.lit(1)), [scope, key], "left")
    a, b = F.coalesce("__a", F.lit(0)), F.coalesce("__b", F.lit(0))
    new = F.when((a + b) == 0, 1).otherwise(0)
    return out.rollup(scope).agg(
        F.count("*").alias("total"), F.sum(a).cast("long").alias("in_known"), F.sum(b).cast("long").alias("in_other"), F.sum(new).cast("long").alias("new"),
        F.floor(F.sum(new) * 100 / F.greatest(F.lit(1), F.count("*"))).cast("long").alias("new_percent"), F.grouping(scope).cast("long").alias("is_total"),
    )


def match_gold(gold: DataFrame, output: DataFrame, scope: str, key: str, aliases: str, ord_col: str) -> DataFrame:
    """gold with matched: same (name or alias in the scope), elsewhere (the key in another scope) or null.

    Names win over aliases; of several outputs with a key the last one is reported.
    """
    names = output.select(scope, F.col(key).alias("__k"), F.lit(0).alias("__alias"), ord_col)
    other = output.select(scope, F.explode(aliases).alias("__k"), F.lit(1).alias("__alias"), ord_col)
    every = names.unionByName(other)
    order = F.struct(-F.col("__alias"), F.col(ord_col))
    same = every.groupBy(scope, "__k").agg(F.max_by(ord_col, order).alias("hit"))
    anywhere = every.groupBy("__k").agg(F.max_by(ord_col, order).alias("far"))
    out = gold.withColumn("__k", F.col(key)).join(same, [scope, "__k"], "left").join(anywhere, "__k", "left")
    return out.withColumn("matched", F.when(F.col("hit").isNotNull(), "same").when(F.col("far").isNotNull(), "elsewhere")).drop("__k", "far", "hit")


def recall(matched: DataFrame, tier: str) -> DataFrame:
    """(tier, hits, total, percent) per tier and over all (tier null); percent is rounded down."""
    hit = F.when(F.col("matched") == "same", 1).otherwise(0)
    return matched.rollup(tier).agg(F.sum(hit).cast("long").alias("hits"), F.count("*").alias("total"), F.floor(F.sum(hit) * 100 / F.greatest(F.lit(1), F.count("*"))).cast("long").alias("percent"))


def evaluation(matched: DataFrame, output: DataFrame, scope: str, key: str, urls: str, slug: str) -> DataFrame:
    """(part, name, hits, total) of a run against a known set: what a report lists.

    matched: the known rows with `matched` (match_gold). Parts: 'scope' (hits of each municipality), 'zero_hit' and
    'unreached' (municipalities without a hit, without any output), 'new' (output rows whose key the known set lacks),
    'no_url' and 'pending' (sanity: output rows without an address, without an id).
    """
    hit = F.sum(F.when(F.col("matched") == "same", 1).otherwise(0)).cast("long")
    per = matched.groupBy(scope).agg(hit.alias("hits"), F.count("*").alias("total"))
    known = matched.select(scope, key).distinct().withColumn("__known", F.lit(True))
    # The output is gone through once: what is asked of it is counted for each municipality.
    counted = output.join(known, [scope, key], "left").groupBy(scope).agg(
        F.count_if(F.col("__known").isNull()).alias("new"), F.count_if(F.size(urls) == 0).alias("no_url"), F.count_if(F.col(slug) == "PENDING").alias("pending"), F.lit(True).alias("reached")
    )
    both = staged(per.join(counted, scope, "full"), "evaluation")
    row = lambda df, part, name, hits, total: df.select(F.lit(part).alias("part"), name.cast("string").alias("name"), hits.alias("hits"), total.alias("total"))
    asked = both.filter("total is not null")
    parts = [row(asked, "scope", F.col(scope), F.col("hits"), F.col("total")), row(asked.filter("hits = 0"), "zero_hit", F.col(scope), F.col("hits"), F.col("total"))]
    parts.append(row(asked.filter("reached is null"), "unreached", F.col(scope), F.col("hits"), F.col("total")))
    sums = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("new", "no_url", "pending")])
    parts += [row(sums, c, F.lit(None), F.col(c), F.col(c)) for c in ("new", "no_url", "pending")]
    return reduce(lambda a, b: a.unionByName(b), parts)
