"""Joins that attach places, judgments and known records to rows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm import textwork as T
from tidemark.session import ship, staged

#: Names of so many characters are looked up whole, longer ones by one of their n-grams of this length.
ANCHOR = 16
#: The filter of looked-up grams has at most two to the power of this many bits (32 MB); it is what the driver sees of the names.
FILTER_BITS = 28
#: Bits of the filter that a task packs together, and rows of a batch of found grams.
SEGMENT, OFFERED_ROWS = 1 << 18, 50_000
#: Names, whole and bare, of up to ANCHOR characters that a Python worker holds at once (about 60 bytes each).
PART_FORMS = 2_000_000


def lookup(df: DataFrame, table: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """Left lookup join whose build side has one row per key: the first by order, or the last."""
    rest = [c for c in table.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    one = table.groupBy(*keys).agg(*[pick(c, order).alias(c) for c in rest])
    return df.join(one, keys, "left")


def _grams(text: Column, n: int) -> Column:
    """The distinct substrings of n characters; none of shorter texts. A look-ahead captures them at every place."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _filter(offered: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, as bytes: those of the slots that the offered grams (__s, __g) hash to. They are put together by tasks, SEGMENT of them in a row."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, scopes = batch.column("__g").to_pylist(), batch.column("__s").to_numpy().view(np.uint64)
            at = np.zeros(len(grams), np.int64)
            for n in {len(g) for g in grams}:
                which = np.array([i for i, g in enumerate(grams) if len(g) == n])
                points = T.code_points([grams[i] for i in which])
                at[which] = _slots(T.mix(T.window_hash(T.prefix_hash(points), n)[::n] ^ scopes[which]), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at // SEGMENT), pa.array(at % SEGMENT)], ["segment", "at"])

    def packed(group: pa.Table) -> pa.Table:
        flags = np.zeros(SEGMENT, np.uint8)
        flags[group.column("at").to_numpy()] = 1
        return pa.table({"segment": group.column("segment").slice(0, 1), "bits": [np.packbits(flags, bitorder="little").tobytes()]}, schema=pa.schema([("segment", pa.int64()), ("bits", pa.binary())]))

    rows = offered.mapInArrow(slots, "segment long, at long").distinct().groupBy("segment").applyInArrow(packed, "segment long, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[r["segment"] * (SEGMENT // 8) :][: SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _offers(texts: DataFrame, keys: list[str], text: str, scope: list[str], sizes: list[int], offered: DataFrame) -> DataFrame:
    """(keys, __g), once each: the substrings, of the given sizes, of each text that are among the grams offered in its scope (scope, __g), and a few others.

    Which those may be is told by a filter of at most 2**FILTER_BITS bits that every task has, so texts stay where they are
    and only what is found travels.
    """
    spark = texts.sparkSession
    ship(spark)
    T.small_batches(spark)
    mark = F.xxhash64(*scope) if scope else F.lit(0).cast("long")
    n_offered = offered.count()
    bits = min(FILTER_BITS, max(SEGMENT.bit_length() - 1, (32 * n_offered).bit_length()))
    known = spark.sparkContext.broadcast(_filter(offered.select(mark.alias("__s"), "__g"), bits))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings, marks = batch.column(text).to_pylist(), batch.column("__s").to_numpy().view(np.uint64)
            for a, b in T.chunked([len(t) + 1 for t in strings]):
                at, grams = _known_grams(strings[a:b], marks[a:b], sizes, known.value, bits)
                for i in range(0, len(grams), OFFERED_ROWS):
                    part = pa.array(at[i : i + OFFERED_ROWS], pa.int64())
                    rows = batch.slice(a, b - a).select(keys).take(part)
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(grams[i : i + OFFERED_ROWS], pa.string())], [*keys, "__g"])

    rows = texts.select(*keys, text, mark.alias("__s")) if text not in keys else texts.select(*keys, mark.alias("__s"))
    schema = StructType([texts.schema[c] for c in keys] + [StructField("__g", StringType())])
    return rows.mapInArrow(found, schema).distinct()


def _known_grams(texts: list[str], marks: np.ndarray, sizes: list[int], known: np.ndarray, bits: int) -> tuple[list[int], list[str]]:
    """(number of the text, gram): each text's distinct substrings that pass the filter."""
    points = T.code_points(texts)
    prefix = T.prefix_hash(points)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)
    begins, salt = ends - lengths, marks[owner]
    at, grams = [], []
    for n in sizes:
        if len(points) < n:
            continue
        slots = _slots(T.mix(T.window_hash(prefix, n) ^ salt[: len(points) - n + 1]), bits)
        hit = np.flatnonzero(known[slots >> 3] >> (slots & 7).astype(np.uint8) & 1)
        of = owner[hit]
        inside = hit + n <= ends[of]
        hit, of = hit[inside], of[inside]
        first = (hit - begins[of]).tolist()
        got = {(i, texts[i][j : j + n]) for i, j in zip(of.tolist(), first, strict=True)}
        at += [i for i, _ in got]
        grams += [g for _, g in got]
    return at, grams


def containing(df: DataFrame, key: list[str], text: str, forms: DataFrame, form: str, scope: list[str] | None = None) -> DataFrame:
    """(key, forms' columns): a row for each text and each form of its scope that it contains.

    key: columns that tell df's texts apart. forms: (scope, form, ...), any number; null and empty forms are in nothing.
    Forms come to texts by equality joins: those of up to ANCHOR characters as they are, so that what meets contains each other;
    longer ones by the n-gram that the fewest texts have, and what that brings together is compared in full. Texts travel only
    for the latter; no text or form is multiplied by the other side.
    """
    by = scope or []
    forms = staged(forms.filter(F.col(form) != ""), "forms")
    lengths = F.least(F.length(form), F.lit(ANCHOR + 1))
    sizes = sorted(r["n"] for r in forms.select(lengths.alias("n")).distinct().collect())  # ANCHOR + 1 numbers at most
    own = [c for c in by if c not in key]
    rest = [c for c in forms.columns if c not in by]
    texts = df.filter(F.col(text).isNotNull()).select(*dict.fromkeys([*key, *own, text]))
    if not sizes:
        return texts.limit(0).join(forms.select(*rest), F.lit(False)).select(*key, *rest)
    long = sizes[-1] > ANCHOR
    offered = forms.filter(F.length(form) <= ANCHOR).select(*by, F.col(form).alias("__g"))
    if long:
        cut = forms.filter(F.length(form) > ANCHOR).select(*by, form, F.explode(_grams(F.col(form), ANCHOR)).alias("__g"))
        offered = offered.unionByName(cut.select(*by, "__g"))
    offers = _offers(texts, [*key, *own], text, by, sorted({min(n, ANCHOR) for n in sizes}), staged(offered.distinct(), "offered"))
    if long:
        offers = staged(offers, "offers")
    short = forms.filter(F.length(form) <= ANCHOR)
    pairs = offers.join(short.withColumn("__g", F.col(form)), [*by, "__g"]).select(*key, *rest)
    if not long:
        return pairs
    counts = offers.filter(F.length("__g") == ANCHOR).groupBy(*by, "__g").agg(F.count("*").alias("__n"))
    rated = cut.join(counts, [*by, "__g"], "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    best = rated.groupBy(*by, form).agg(F.min_by("__g", F.struct("__n", "__g")).alias("__g"), F.min("__n").alias("__least")).filter("__least > 0")
    index = staged(forms.join(best.drop("__least"), [*by, form]), "form-anchors")
    whole = texts.select(*key, F.col(text).alias("__text")).dropDuplicates(key)
    met = offers.join(index, [*by, "__g"]).select(*key, *rest).join(whole, key)
    return pairs.unionByName(met.filter(F.contains("__text", F.col(form))).select(*key, *rest))


def contained_names(df: DataFrame, key: list[str], text: str, names: DataFrame, name: str, wide: str, scope: list[str] | None = None) -> DataFrame:
    """df with n_names and assigned: the one name of the row's scope that the text contains; `wide` where none or several do.

    key: columns that tell df's texts apart. names: (scope, name), any number; null and empty names count as none, and a
    name that is listed twice is one. Names of more than two characters are tried without their last character if no
    name is the only one. A null text contains nothing.
    """
    by = scope or []
    listed = names.select(*by, F.col(name).alias("__name")).filter(F.col("__name") != "").distinct()
    whole = listed.select(*by, "__name", F.col("__name").alias("__form"), F.lit(True).alias("__whole"))
    bare = listed.filter(F.length("__name") > 2).select(*by, "__name", F.expr("substring(__name, 1, length(__name) - 1)").alias("__form"), F.lit(False).alias("__whole"))
    forms = staged(whole.unionByName(bare), "name-forms")
    is_whole, long = F.col("__whole"), F.length("__form") > ANCHOR
    known = df.filter(F.col(text).isNotNull())
    # A row for each text and part of the names: how many are in it, and of one that is the only one its name.
    found = _counted(known, key, by, text, forms.filter(~long))
    if not forms.filter(long).isEmpty():
        rest = containing(known, key, text, forms.filter(long), "__form", scope).groupBy(*key).agg(
            F.count_if(is_whole).alias("__w"), F.min(F.when(is_whole, F.col("__name"))).alias("__one"), F.count_if(~is_whole).alias("__b"), F.min(F.when(~is_whole, F.col("__name"))).alias("__bare"),
        )
        found = found.unionByName(rest)
    found = found.groupBy(*key).agg(F.sum("__w").alias("n_names"), F.min("__one").alias("__one"), F.sum("__b").alias("__n_bare"), F.min("__bare").alias("__bare"))
    out = df.join(found, key, "left").withColumn("n_names", F.coalesce("n_names", F.lit(0).cast("long")))
    one = F.when(F.col("n_names") == 1, F.col("__one")).when(F.col("__n_bare") == 1, F.col("__bare")).otherwise(F.lit(wide))
    return out.withColumn("assigned", one).drop("__one", "__n_bare", "__bare")


class _Names:
    """Forms of one length in arrays sorted by hash, found by the hash's first bits and compared by their characters."""

    def __init__(self, n: int, forms: list[str], scopes: np.ndarray, rows: list[np.ndarray]):
        points = T.code_points(forms)
        hashes = T.mix(T.window_hash(T.prefix_hash(points), n)[::n] ^ T.mix(scopes.astype(np.uint64)))
        order = np.argsort(hashes, kind="stable")
        self.n, self.hashes, self.points, self.scopes = n, hashes[order], points.reshape(-1, n)[order], scopes[order]
        self.whole, self.bare, self.last = (r[order] for r in rows)
        self.shift = np.uint64(64 - max(8, len(forms).bit_length()))
        self.starts = np.searchsorted(self.hashes >> self.shift, np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64))

    def find(self, prefix: np.ndarray, points: np.ndarray, scope_of: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the form) of every place, of those `inside`, where a form of the place's scope begins."""
        hashes = T.mix(T.window_hash(prefix, self.n)[inside] ^ T.mix(scope_of[inside].astype(np.uint64)))
        first = (hashes >> self.shift).astype(np.int64)
        at, end = self.starts[first], self.starts[first + 1]
        places, numbers = [], []
        left = np.flatnonzero(at < end)
        while len(left):
            same = left[self.hashes[at[left]] == hashes[left]]
            if len(same):
                place, number = inside[same], at[same]
                equal = self.scopes[number] == scope_of[place]
                for j in range(self.n):
                    equal &= points[place + j] == self.points[number, j]
                places.append(place[equal])
                numbers.append(number[equal])
            at[left] += 1
            left = left[at[left] < end[left]]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *numbers])


def _names(paths: list[str]) -> tuple[dict[str, int], list[_Names]]:
    """(numbers of the scopes, the forms by length) of a part of the names."""
    tables = []
    for path in paths:
        where, file = fs.FileSystem.from_uri(path)
        tables.append(pq.read_table(file, filesystem=where))
    rows = pa.concat_tables(tables)
    marks = rows.column("__scope").combine_chunks().dictionary_encode()
    scopes, forms = marks.indices.to_numpy().astype(np.int32), np.array(rows.column("__form").to_pylist(), object)
    columns = [rows.column(c).to_numpy() for c in ("__w", "__b", "__last")]
    lengths = np.fromiter(map(len, forms), np.int64, len(forms))
    out = []
    for n in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == n)
        out.append(_Names(n, forms[which].tolist(), scopes[which], [c[which] for c in columns]))
    return {m: i for i, m in enumerate(marks.dictionary.to_pylist())}, out


def _counts(texts: list[str], scopes: np.ndarray, names: list[_Names]) -> tuple[np.ndarray, list, np.ndarray, list]:
    """Of each text: how many whole names it has, the name if it is one, how many bare ones, the name if it is one."""
    w, b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    one: list[str | None] = [None] * len(texts)
    bare: list[str | None] = [None] * len(texts)
    points = T.code_points(texts)
    prefix = T.prefix_hash(points)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    ends, scope_of = np.cumsum(lengths)[owner], scopes[owner]
    for part in names:
        inside = np.flatnonzero((np.arange(len(points)) + part.n <= ends) & (scope_of >= 0))
        if not len(inside):
            continue
        place, number = part.find(prefix, points, scope_of, inside)
        both = np.unique(owner[place] * len(part.hashes) + number)
        of, number = both // len(part.hashes), both % len(part.hashes)
        for total, kept, each, tail in ((w, one, part.whole, False), (b, bare, part.bare, True)):
            total += np.bincount(of, weights=each[number], minlength=len(texts)).astype(np.int64)
            for i in np.flatnonzero((total[of] == 1) & (each[number] == 1)).tolist():
                form = part.points[number[i]].tobytes().decode("utf-32-le")
                kept[of[i]] = form + chr(part.last[number[i]]) if tail else form
    return w, [x if n == 1 else None for x, n in zip(one, w, strict=True)], b, [x if n == 1 else None for x, n in zip(bare, b, strict=True)]


def _counted(df: DataFrame, key: list[str], by: list[str], text: str, forms: DataFrame) -> DataFrame:
    """(key, __w, __one, __b, __bare): for each text and part of the forms the number of names in it whole and bare, and the name that is the only one.

    A text has many of a long list of names, so they are counted where it lies: a task reads a part of at most PART_FORMS
    forms from the shared folder, and every text is read once for each part.
    """
    spark = df.sparkSession
    ship(spark)
    T.small_batches(spark)
    mark = F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by]), F.to_json(F.struct(*by))) if by else F.lit("")
    is_whole = F.col("__whole")
    index = forms.select(mark.alias("__scope"), "__name", "__form", "__whole").filter("__scope is not null").groupBy("__scope", "__form").agg(
        F.count_if(is_whole).alias("__w"), F.count_if(~is_whole).alias("__b"), F.min(F.when(~is_whole, F.ascii(F.right("__name", F.lit(1))))).alias("__last"),
    )
    index = staged(index.withColumn("__last", F.coalesce("__last", F.lit(0))), "name-index")
    n_forms = index.count()
    parts = -(-n_forms // PART_FORMS)
    own = [*dict.fromkeys([*key, text])]
    texts = df.select(*own, mark.alias("__scope"))
    schema = StructType([df.schema[c] for c in key] + [StructField("__w", LongType()), StructField("__one", StringType()), StructField("__b", LongType()), StructField("__bare", StringType())])

    def count(paths: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers, names = T.held("names", tuple(paths), lambda: _names(paths))
                strings = batch.column(text).to_pylist()
                scopes = np.array([numbers.get(m, -1) for m in batch.column("__scope").to_pylist()], np.int64)
                got = [_counts(strings[a:b], scopes[a:b], names) for a, b in T.chunked([len(t) + 1 for t in strings], T.CHUNK_BYTES // 4)]
                columns = [pa.array([x for g in got for x in g[i]], pa.string() if i % 2 else pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*batch.select(key).columns, *columns], [*key, "__w", "__one", "__b", "__bare"])

        return run

    out = spark.createDataFrame([], schema)
    for i in range(parts):
        part = index if parts == 1 else staged(index.filter(F.pmod(F.xxhash64("__scope", "__form"), F.lit(parts)) == i), "name-part", PART_FORMS)
        rows = texts.mapInArrow(count(sorted(part.inputFiles())), schema)
        # Rows that repeat a key are one text.
        out = out.unionByName(rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in ("__w", "__one", "__b", "__bare")]))
    return out


def canonical_place(df: DataFrame, known: DataFrame, scope: str, place: str, variants: list[Column], wide: str) -> DataFrame:
    """df with resolved: the first of the place's variants that the registry has in its scope, otherwise `wide`.

    Each row offers all its variants to one equality join; the earliest that hits is kept.
    """
    rows = df.select(scope, place).distinct()
    tries = rows.select(scope, place, F.posexplode(F.array(*variants)).alias("__try", "__v"))
    registry = known.select(F.col(scope), F.col(place).alias("__v")).distinct()
    hit = tries.join(registry, [scope, "__v"]).groupBy(scope, place).agg(F.min_by("__v", "__try").alias("resolved"))
    return df.join(hit, [scope, place], "left").withColumn("resolved", F.coalesce("resolved", F.lit(wide)))


def zip_rows(left: DataFrame, right: DataFrame, order_left: str, order_right: str) -> DataFrame:
    """Joins two tables row by row in their orders; rows without a partner have nulls (zip_checked refuses them)."""
    from tidemark.operators.records import numbered

    a = numbered(left, [order_left]).drop("id").withColumnRenamed("__n", "ordinal")
    b = numbered(right, [order_right]).drop("id").withColumnRenamed("__n", "ordinal")
    return a.join(b, "ordinal", "full")


class ZipError(ValueError):
    """Two lists that should run side by side do not."""


def zip_checked(left: DataFrame, right: DataFrame, order_left: str, order_right: str, fits: Column) -> DataFrame:
    """zip_rows of two tables of one length whose rows fit each other one by one; otherwise a ZipError names the first misfits."""
    if problem := row_count_problem(left, right):
        raise ZipError(problem)
    both = staged(zip_rows(left, right, order_left, order_right), "zipped")
    misfits = [r["ordinal"] for r in both.filter(~F.coalesce(fits, F.lit(False))).select("ordinal").orderBy("ordinal").limit(5).collect()]
    if misfits:
        raise ZipError(f"rows do not fit: {misfits}")
    return both


def row_count_problem(left: DataFrame, right: DataFrame) -> str | None:
    a, b = left.count(), right.count()
    return None if a == b else f"{a} rows against {b}"


def judgment_status(index: DataFrame, verdicts: DataFrame, id_col: str, compared: list[str]) -> DataFrame:
    """(id, status): missing (no verdict), extra (no index row), drift (a compared column differs, null-safe) or ok."""
    a = index.select(F.col(id_col), *[F.col(c).alias(f"__i_{c}") for c in compared], F.lit(True).alias("__i"))
    b = verdicts.select(F.col(id_col), *[F.col(c).alias(f"__v_{c}") for c in compared], F.lit(True).alias("__v"))
    same = reduce(lambda x, y: x & y, [F.col(f"__i_{c}").eqNullSafe(F.col(f"__v_{c}")) for c in compared])
    status = F.when(F.col("__v").isNull(), "missing").when(F.col("__i").isNull(), "extra").when(~same, "drift").otherwise("ok")
    return a.join(b, id_col, "full").select(id_col, status.alias("status"))


def alias_problems(df: DataFrame, id_col: str, alias: str, place: str, verdict: str, wide: str, keep: str = "keep", scope: str | None = None) -> DataFrame:
    """(id, alias, problem) of rows with an alias: unknown, self, other_place, not_kept, cycle; null problem if it is fine.

    scope: a column beside the place that has to agree even for rows of the `wide` place. Chains are followed by pointer doubling; a chain that has not ended after as many steps as there are rows is a cycle.
    """
    target = df.select(F.col(id_col).alias(alias), F.col(place).alias("__p"), F.col(verdict).alias("__k"), (F.col(scope) if scope else F.lit("")).alias("__s"))
    rows = df.filter(F.col(alias).isNotNull())
    checked = rows.join(target, alias, "left")
    in_cycle = cycles(df, id_col, alias)
    other = (F.col(place) != F.col("__p")) & (F.col(place) != wide) & (F.col("__p") != wide)
    if scope:
        other = other | (F.col(scope) != F.col("__s"))
    problem = (
        F.when(F.col("__k").isNull() & F.col("__p").isNull(), "unknown").when(F.col(alias) == F.col(id_col), "self").when(other, "other_place")
        .when(F.col("__k") != keep, "not_kept").when(F.col("__c"), "cycle")
    )
    return checked.join(in_cycle.select(id_col, F.lit(True).alias("__c")), id_col, "left").select(id_col, alias, problem.alias("problem"))


def cycles(df: DataFrame, id_col: str, alias: str) -> DataFrame:
    """(id) of rows whose alias chain never ends, by pointer doubling.

    After n doublings the rows whose chain has more than 2**n steps are left. A longer chain that ends runs through rows
    with every smaller number of steps, so once a doubling leaves as many rows as before, only cycles are left.
    """
    step = staged(df.filter(F.col(alias).isNotNull()).select(F.col(id_col).alias("v"), F.col(alias).alias("to")), "alias-steps")
    left = step.count()
    while left:
        onward = step.select(F.col("v").alias("to"), F.col("to").alias("far"))
        step = staged(step.join(onward, "to").select("v", F.col("far").alias("to")), "alias-steps", left)
        before, left = left, step.count()
        if left == before:
            break
    return step.select(F.col("v").alias(id_col)).distinct()


def guard(new: DataFrame, existing: DataFrame, id_col: str, name_keys: list[str], names: str) -> DataFrame:
    """new with guard: id_clash, name_clash (a name or alias of an existing record with the same keys) or null.

    names: an array column of keys in both tables. Two left joins against distinct keys; nothing multiplies.
    """
    ids = existing.select(id_col).distinct().withColumn("__id", F.lit(True))
    known = existing.select(*name_keys, F.explode(names).alias("__k")).distinct()
    hit = new.select(id_col, *name_keys, F.explode(names).alias("__k")).join(known, [*name_keys, "__k"], "left_semi").select(id_col).distinct().withColumn("__name", F.lit(True))
    out = new.join(ids, id_col, "left").join(hit, id_col, "left")
    return out.withColumn("guard", F.when(F.col("__id"), "id_clash").when(F.col("__name"), "name_clash")).drop("__id", "__name")


def loose_matches(left: DataFrame, right: DataFrame, scope: list[str], text: str, n: int = 4) -> DataFrame:
    """Distinct (scope, text) of left that share a substring of n characters with a text of right in the scope, or contain or lie in one.

    Sharing a substring of n characters is sharing an n-gram, so a semi join on exploded n-grams finds it; texts
    shorter than n can only contain or lie in others and offer all their substrings' owners by equality too.
    """

    def grams(df: DataFrame) -> DataFrame:
        size = F.length(text)
        return df.filter(size >= n).select(*scope, text, F.explode(F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substring(F.col(text), i, F.lit(n)))).alias("__g"))

    def pieces(df: DataFrame) -> DataFrame:  # substrings shorter than n
        size = F.length(text)
        starts = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(size - w + 1, F.lit(1))), lambda i: F.substring(F.col(text), i, w))))
        return df.filter(size > 0).select(*scope, text, F.explode(F.array_distinct(starts)).alias("__g"))

    a, b = left.select(*scope, text).distinct(), right.select(*scope, text).distinct()
    keys = [*scope, "__g"]
    short_b = b.filter((F.length(text) < n) & (F.length(text) > 0)).select(*scope, F.col(text).alias("__g"))
    short_a = a.filter((F.length(text) < n) & (F.length(text) > 0)).withColumn("__g", F.col(text))
    found = grams(a).join(grams(b).select(*keys).distinct(), keys, "left_semi").select(*scope, text)
    found = found.unionByName(pieces(a).join(short_b, keys, "left_semi").select(*scope, text))
    found = found.unionByName(short_a.join(pieces(b).select(*keys).distinct(), keys, "left_semi").select(*scope, text))
    return found.distinct()


def scoped_url(df: DataFrame, scopes: DataFrame, url: str, keys: list[str], label: str, path: str) -> DataFrame:
    """df with the one label whose scope path begins the url's path (one leading segment may come before); null if none or several.

    scopes: (keys, host, label, path). An address offers the beginnings of its path, of the lengths that scope paths have,
    to one equality join on keys, host and path, so a host with many addresses and many scopes multiplies nothing.
    """
    rows = df.withColumn("__host", F.lower(F.try_parse_url(F.col(url), F.lit("AUTHORITY")))).withColumn("__path", F.try_parse_url(F.col(url), F.lit("PATH")))
    s = scopes.select(*keys, F.col("host").alias("__host"), F.col(label).alias("__label"), F.col(path).alias("__scope"))
    lengths = sorted(r["n"] for r in s.filter("__scope is not null").select(F.length("__scope").alias("n")).distinct().collect())  # as many as there are lengths
    after = F.nullif(F.regexp_extract("__path", "^/[^/]+(/.*)$", 1), F.lit(""))
    starts = [F.when(F.length(whole) >= n, F.substring(whole, 1, n)) for n in lengths for whole in (F.col("__path"), after)]
    offers = rows.select(url, *keys, "__host", "__path").distinct().select(url, *keys, "__host", F.explode(F.array_distinct(F.array_compact(F.array(*starts)))).alias("__scope") if starts else F.lit(None).cast("string").alias("__scope"))
    hits = offers.join(s, [*keys, "__host", "__scope"])
    one = hits.groupBy(*keys, url).agg(F.countDistinct("__label").alias("n_scopes"), F.min("__label").alias("__l"))
    out = df.join(one, [*keys, url], "left")
    return out.withColumn(label, F.when(F.col("n_scopes") == 1, F.col("__l"))).withColumn("n_scopes", F.coalesce("n_scopes", F.lit(0)).cast("long")).drop("__l")
