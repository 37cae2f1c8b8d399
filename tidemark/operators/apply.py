"""Applying a judge's verdicts to normalised rows: places, readings, display names, merges, ids. One DataFrame chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions import rules as R
from tidemark.functions.clean import display_name
from tidemark.functions.kana import romanize_udf
from tidemark.operators import records, resolve
from tidemark.session import ship, staged

# Labels that a name or its reading carries before or behind the event's own -----------------------
NAME_LABEL = "^(?:国|都|道|府|県|市|町|村|区)(?:指定|登録|選択)"
READING_LABEL = "^(?:くに|と|どう|ふ|けん|し|ちょう|まち|むら|く)(?:してい|とうろく|せんたく)(?:じゅうよう)?(?:むけい|ゆうけい)?(?:みんぞく)?(?:ぶんかざい)?"
SOCIETY_NAME = "(?:保存会|愛好会|同好会|連合会|振興会)$"
SOCIETY_READING = "(?:ほぞんかい|あいこうかい|どうこうかい|れんごうかい|しんこうかい)$"
SLUG = "^[a-z0-9]+(?:-[a-z0-9]+)+$"
VERDICTS = ("keep", "drop", "unsure")

KANA = r"(?U)^[ぁ-ゖァ-ヺーゝゞ・　\s]+$"

__all__ = ["DriftError", "JudgmentError", "apply_verdicts", "designated_places", "event_reading", "guessed_places", "verdict_problems"]


class DriftError(ValueError):
    """Rows differ from the index that the judge was shown, so answers would meet other rows."""


class JudgmentError(ValueError):
    """A judge's answers break a rule."""


def _named(rows: DataFrame) -> str:
    """The first five ids, for an error's text."""
    return ", ".join(str(r[0]) for r in rows.select("id").orderBy("id").limit(5).collect())


def refuse_drift(rows: DataFrame, index: DataFrame) -> None:
    """Raises DriftError if a row of the index (id, municipality, name; prefecture too where it has one) is not among rows as it was."""
    compared = [c for c in ("prefecture", "municipality", "name") if c in index.columns]
    status = resolve.judgment_status(index, rows, "id", compared).filter(F.col("status").isin("missing", "drift"))
    if first := _named(status):
        raise DriftError(f"{status.count()} rows differ from the index: {first}")


def verdict_problems(index: DataFrame, verdicts: DataFrame, wide: str = R.PREFECTURE_WIDE) -> DataFrame:
    """(id, problem) of the answers, a row for each problem that an id has.

    index: (id, prefecture, municipality). missing: no answer; extra: an id that nobody asked for; verdict: none of VERDICTS;
    reading: not kana; unknown, self, other_place, not_kept, cycle: the alias (resolve.alias_problems; a place that the
    answer itself gives counts, and rows of a whole prefecture may be the alias of any of its rows).
    """
    asked = index.select("id", "prefecture", F.col("municipality").alias("__asked"))
    given = verdicts.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("verdict", "alias_of", "municipality", "reading")])
    both = staged(asked.withColumn("__a", F.lit(True)).join(given.withColumn("__g", F.lit(True)), "id", "full"), "answers")
    lone = F.when(F.col("__g").isNull(), "missing").when(F.col("__a").isNull(), "extra")
    wrong = F.array_compact(F.array(lone, F.when(lone.isNull() & ~F.col("verdict").isin(*VERDICTS), "verdict"), F.when(lone.isNull() & (F.col("reading") != "") & ~F.col("reading").rlike(KANA), "reading")))
    place = F.when(F.col("__asked") == wide, wide).otherwise(F.coalesce(F.nullif("municipality", F.lit("")), "__asked"))
    known = both.filter("__a and __g").select("id", "prefecture", F.nullif("alias_of", F.lit("")).alias("alias_of"), place.alias("place"), "verdict")
    aliases = resolve.alias_problems(known, "id", "alias_of", "place", "verdict", wide, scope="prefecture")
    return both.select("id", F.explode(wrong).alias("problem")).unionByName(aliases.filter("problem is not null").select("id", "problem"))


def event_reading(reading: Column, name: Column) -> Column:
    """The reading without the designation's, where the name carries a designation."""
    return F.when(name.rlike(NAME_LABEL), F.regexp_replace(reading, READING_LABEL, "")).otherwise(reading)


def designated_places(sources: list[DataFrame], wide: str = R.PREFECTURE_WIDE) -> DataFrame:
    """(prefecture, key, municipality, spread): per name key the municipality of the first source, and row, that has one.

    sources: registries (prefecture, municipality, name, ord) in the order of trust. spread: some source says that the
    event spans several municipalities.
    """
    numbered = [s.select("prefecture", "municipality", K.dedup_key(F.col("name")).alias("key"), F.struct(F.lit(i).alias("source"), F.col("ord").cast("long").alias("ord")).alias("at")) for i, s in enumerate(sources)]
    rows = numbered[0]
    for more in numbered[1:]:
        rows = rows.unionByName(more)
    rows = rows.filter(F.coalesce("municipality", F.lit("")) != "")
    one = F.col("municipality") != wide
    return rows.groupBy("prefecture", "key").agg(F.min_by(F.when(one, F.col("municipality")), F.when(one, F.col("at"))).alias("municipality"), F.max(~one).alias("spread"))


def guessed_places(rows: DataFrame, designated: DataFrame, municipalities: DataFrame, name: str = "name", texts: tuple[str, ...] = ("name", "venue", "date_note")) -> DataFrame:
    """rows with guess and guess_by: 'designation' by name key, else 'name' by a municipality's stem in the texts.

    A name that a registry spreads over several municipalities is not guessed by its stem. municipalities:
    (prefecture, municipality, ord); a prefecture's names become one array (bounded by its municipalities), so each row
    is decided where it lies. The first stem of two characters or more, in registry order, counts.
    """
    stem = F.regexp_replace("municipality", R.MUNICIPAL_SUFFIX, "")
    listed = municipalities.select("prefecture", "municipality", "ord", stem.alias("stem")).filter(F.length("stem") >= 2)
    stems = listed.groupBy("prefecture").agg(F.array_sort(F.collect_list(F.struct("ord", "municipality", "stem"))).alias("__stems"))
    lookup = designated.select("prefecture", F.col("key").alias("__key"), F.col("municipality").alias("__known"), F.col("spread").alias("__spread"))
    keyed = rows.withColumn("__key", K.dedup_key(F.col(name))).join(lookup, ["prefecture", "__key"], "left").join(stems, "prefecture", "left")
    blob = F.concat_ws(" ", *[F.coalesce(F.col(t), F.lit("")) for t in texts])
    hit = F.try_element_at(F.filter("__stems", lambda s: F.contains(blob, s["stem"])), F.lit(1))["municipality"]
    by_stem = F.when(~F.coalesce("__spread", F.lit(False)), hit)
    out = keyed.withColumn("guess", F.coalesce("__known", by_stem)).withColumn("guess_by", F.when(F.col("__known").isNotNull(), "designation").when(by_stem.isNotNull(), "name"))
    return out.select(*rows.columns, "guess", "guess_by")


def _merged(rows: DataFrame, cap: int) -> DataFrame:
    """rows after rows of one place and merge key were joined: the best sourced one takes the others' names and urls."""
    place = ["prefecture", "municipality", "__m"]
    free = (F.col("s4_verdict") == "keep") & (F.col("s4_alias_of") == "")
    keyed = rows.withColumn("__m", F.when(free, K.merge_key(F.col("name"), F.col("municipality"))))
    able = keyed.filter("__m is not null")
    rank = F.struct((-F.greatest(F.size("source_urls"), F.lit(1))).alias("r"), F.col("id").alias("id"))
    heads = able.groupBy(*place).agg(F.count("*").alias("__n"), *[F.min_by(c, rank).alias(f"__{c}") for c in ("id", "name", "aliases", "source_urls")]).filter("__n > 1")
    heads = staged(heads, "merge-heads")
    # The head first, then the others in id order, as rows are seen; values with their best place are sorted, rows never gathered.
    members = able.join(heads.select(*place, F.col("__id").alias("__head")), place)
    is_head = F.col("id") == F.col("__head")
    order = F.struct((~is_head).alias("h"), F.col("id").alias("id"))
    names = records.in_rank_order(members, place, F.when(is_head, F.col("aliases")).otherwise(F.concat(F.array("name"), "aliases")), order, "__names")
    links = records.in_rank_order(members, place, F.col("source_urls"), order, "__links")
    groups = heads.join(names, place, "left").join(links, place, "left")
    none = F.array().cast("array<string>")
    # The head's own aliases stay as they are; what joins is no repetition and not the head's name.
    joined = F.concat("__aliases", F.array_except(F.filter(F.coalesce("__names", none), lambda a: (a != "") & (a != F.col("__name"))), F.col("__aliases")))
    urls = F.filter(F.coalesce("__links", none), lambda u: u != "")
    facts = groups.select(*place, F.col("__id").alias("__head"), joined.alias("__all_names"), F.slice(urls, 1, cap).alias("__all_urls"), F.size(urls).cast("long").alias("__count"))
    out = keyed.join(facts, place, "left")
    return out.select(
        *[c for c in rows.columns if c not in ("aliases", "source_urls", "source_count", "s4_alias_of")],
        F.when(is_head, F.col("__all_names")).otherwise(F.col("aliases")).alias("aliases"), F.when(is_head, F.col("__all_urls")).otherwise(F.col("source_urls")).alias("source_urls"),
        F.when(is_head, F.col("__count")).otherwise(F.col("source_count")).alias("source_count"),
        F.when(F.col("__head").isNotNull() & ~is_head, F.col("__head")).otherwise(F.col("s4_alias_of")).alias("s4_alias_of"),
    )


def apply_verdicts(
    rows: DataFrame, verdicts: DataFrame, designated: DataFrame, municipalities: DataFrame, romaji: DataFrame, cap: int = 8, wide: str = R.PREFECTURE_WIDE,
    index: DataFrame | None = None, strict: bool = False,
) -> DataFrame:
    """The judged table: rows with their verdict, place, cleaned name, aliases, urls, slug and alias.

    rows: (id, prefecture, municipality, name, venue, date_note, aliases, source_urls, source_count, slug, ...), ids unique
    and in the order of names; further columns stay. verdicts: (id, verdict, reason, alias_of, municipality, reading).
    romaji: (prefecture, municipality, pref_romaji, muni_romaji). Rows of any number of prefectures go together: places are
    told apart by prefecture and municipality.

    index: (id, municipality, name, ...) as the judge saw it; without it rows are taken as the index. A difference raises
    DriftError, a verdict for an id that is not there JudgmentError; strict raises it for every problem that
    verdict_problems lists. Otherwise a row whose alias is wrong becomes unsure and is no alias, one without a valid
    verdict unsure, and a reading that is not kana counts as none.

    Only kept rows are cleaned; rows that are an alias have no slug; a row whose place has no known romanisation stays
    PENDING. Of rows that want one slug the first by id keeps it.
    """
    if index is not None:
        refuse_drift(rows, index)
    problems = staged(verdict_problems(rows, verdicts, wide), "verdict-problems")
    fatal = problems if strict else problems.filter("problem = 'extra'")
    if first := _named(fatal):
        raise JudgmentError(f"{fatal.count()} problems in the verdicts: {first}")
    astray = problems.filter(F.col("problem").isin("unknown", "self", "other_place", "not_kept", "cycle")).select("id", F.lit(True).alias("__astray")).distinct()
    ship(rows.sparkSession)
    given = verdicts.select("id", *[F.coalesce(c, F.lit("")).alias(f"__{c}") for c in ("verdict", "reason", "alias_of", "municipality", "reading")])
    judged = rows.join(given, "id", "left").join(astray, "id", "left").fillna("", [f"__{c}" for c in ("verdict", "reason", "alias_of", "municipality", "reading")])
    fine = F.col("__verdict").isin(*VERDICTS) & F.col("__astray").isNull()
    judged = judged.withColumns({
        "s4_verdict": F.when(fine, F.col("__verdict")).otherwise("unsure"), "__alias_of": F.when(F.col("__astray").isNull(), F.col("__alias_of")).otherwise(""),
        "__reading": F.when(F.col("__reading").rlike(KANA), F.col("__reading")).otherwise(""),
    }).drop("__astray")
    guessed = guessed_places(judged, designated, municipalities)
    is_wide = F.col("municipality") == wide
    place = F.when(is_wide & (F.col("__municipality") != ""), F.col("__municipality")).when(is_wide & (F.col("s4_verdict") == "keep"), F.coalesce("guess", "municipality")).otherwise(F.col("municipality"))
    kept = F.col("s4_verdict") == "keep"
    society = (F.col("__reason") == "organization") | F.col("name").rlike(SOCIETY_NAME)
    placed = guessed.withColumn("municipality", place).withColumn("__said", event_reading(F.col("__reading"), F.col("name"))).withColumn("__society", society)
    named = placed.withColumn("__clean", F.when(kept, display_name(F.col("name"), F.col("__society"), F.col("municipality"))).otherwise(F.col("name")))
    changed = F.col("__clean") != F.col("name")
    named = staged(
        named.withColumns({
            "__said": F.when(kept & F.col("__society") & changed, F.regexp_replace("__said", SOCIETY_READING, "")).otherwise(F.col("__said")),
            "aliases": F.when(kept & changed & ~F.array_contains("aliases", F.col("name")), F.concat("aliases", F.array("name"))).otherwise(F.col("aliases")),
        }).withColumn("name", F.col("__clean")).withColumnsRenamed({"__reason": "s4_reason", "__alias_of": "s4_alias_of"})
        .drop("guess", "guess_by", "__verdict", "__municipality", "__reading", "__society", "__clean"),
        "judged",
    )
    merged = _merged(named, cap)
    canonical = (F.col("s4_verdict") == "keep") & (F.col("s4_alias_of") == "")
    with_romaji = merged.join(romaji.select("prefecture", "municipality", "pref_romaji", "muni_romaji"), ["prefecture", "municipality"], "left")
    made = K.stable_id(F.col("pref_romaji"), F.col("muni_romaji"), K.dedup_key(F.col("name")), romanize_udf("__said"))
    wanted = F.when(F.col("slug") != "PENDING", F.col("slug")).when(made.rlike(SLUG), made).otherwise("PENDING")
    slugged = with_romaji.withColumn("slug", F.when(canonical, wanted).otherwise(""))
    owned = records.own_ids(slugged.withColumn("__want", F.when(~F.col("slug").isin("", "PENDING"), F.col("slug"))), "__want", "id")
    lost = F.col("owner").isNotNull() & ~F.col("keeps_slug")
    return owned.withColumn("s4_alias_of", F.when(lost, F.col("owner")).otherwise(F.col("s4_alias_of"))).withColumn("slug", F.when(lost, "").otherwise(F.col("slug"))).select(
        "id", "prefecture", "municipality", "name", "aliases", "source_urls", "source_count", "slug", "s4_verdict", "s4_reason", "s4_alias_of",
        *[c for c in rows.columns if c not in ("id", "prefecture", "municipality", "name", "aliases", "source_urls", "source_count", "slug")],
    )
