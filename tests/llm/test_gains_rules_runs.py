"""Gain resampling, the rule ledger and periodic runs, against brute force."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from common import SCHEMA, empty, frame, rows
from tidemark.llm import gains, queries, rulebits, runs

lower = lambda s: s.translate({c: c + 32 for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def features(text):
    w = WORD.findall(lower(text or ""))
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def brute_sample(data, items, least=20, percent=25):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [r[1] for r in data]), (t, items)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10_000) / ((x + 1) * (sum(t) + 10_000)))) for x, y in zip(s, t, strict=True)]
    out = []
    for doc, text, *_ in data:
        n, f = features(text)
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    place = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted([tuple([*r[:4], place.get(id(r))]) for r in out], key=repr)


@pytest.mark.parametrize("least,percent", [(20, 25), (0, 100), (1, 50), (20, 0)])
def test_ranked_sample(spark, least, percent):
    data = [*rows(), (None, "a null id " * 15, None, None, None), (9, "repeated row " * 20, None, None, None), (9, "repeated row " * 20, None, None, None), (9, "same id, " * 20, None, None, None)]
    items = ["abc abcd 42 it's", None, "", "Ünï 日本 " * 3]
    target = spark.createDataFrame([(x,) for x in items], "text string")
    got = gains.ranked_sample(frame(spark, data, clash=True), target, least_words=least, share_percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_sample(data, items, least, percent)


def test_ranked_sample_of_empty_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert gains.ranked_sample(empty(spark), target).count() == 0
    data = rows(5, 40)
    got = gains.ranked_sample(frame(spark, data), target).collect()
    assert sorted(map(tuple, got), key=repr) == brute_sample(data, [])


def test_scores_need_no_shuffle(spark):
    plan = gains.scores(frame(spark), [0] * 10_000)._jdf.queryExecution().executedPlan().toString()
    above_input = plan[: plan.index("Exchange")] if "Exchange" in plan else plan
    assert "Explode" not in plan and "Join" not in above_input and "Generate" not in plan


def brute_measures(text):
    text = text or ""
    words, lines = PLAIN.findall(text), text.split("\n")
    full = [x for x in lines if PLAIN.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {q for i, w in enumerate(windows) if windows.count(w) > 1 for q in (i, i + 1, i + 2)}
    return (
        len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines), len(full) - len(set(full)), len(again), sum(c.isupper() and c.isalpha() for c in text),
        len(re.findall(rulebits.INSULT.replace(r"[^\p{L}\p{N}]", r"[\W_]"), text)),
    )


def ledger_rows():
    rnd = random.Random(4)
    out = [r for r in rows() if len(r[1] or "") < 10_000]
    some = ["a b c a b c", "x x x", "x x x x", "You IDIOT! idiot, clown", "loser", "THE WHOLE TEXT SHOUTS " * 20, "## ** $$ | <b> & %", "\n\n a\na\n a\n\n", "a\x0bb\x0cc a\x0bb\x0cc", "\x1c \x85 \xa0", "é è é è é"]
    some += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    return out + [(10_000 + i, t, None, None, None) for i, t in enumerate(some)] + [(None, "a null id", None, None, None), (3, "x", None, None, None), (3, "x", None, None, None)]


def test_ledger(spark):
    data = ledger_rows()
    extra = frame(spark, data, clash=True).withColumn("N_words", F.lit("clash")).withColumn("Failures", F.lit("clash"))
    got = rulebits.ledger(extra)
    assert set(extra.columns) - {"N_words", "Failures", "n_words"} <= set(got.columns)
    want = []
    for r in data:
        m = dict(zip(rulebits.MEASURES, brute_measures(r[1]), strict=True))
        fails = [
            m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], 100 * m["n_symbols"] > 10 * m["n_words"], 100 * m["n_dup_lines"] > 30 * m["n_lines"],
            m["word_chars"] < 2 * m["n_words"], m["word_chars"] > 15 * m["n_words"], 100 * m["n_capitals"] > 40 * m["word_chars"], m["n_insults"] > 0,
        ]
        want.append((r[0], *m.values(), sum(f << i for i, f in enumerate(fails))))
    assert sorted(map(tuple, got.select("doc_id", *rulebits.MEASURES, "failures").collect()), key=repr) == sorted(want, key=repr)
    for policy, rules in rulebits.POLICIES.items():
        kept = got.filter(rulebits.passes(policy)).count()
        assert kept == sum(not any(w[-1] >> rulebits.BIT[r] & 1 for r in rules) for w in want)
    cases = {(r["policy"], r["rule"]): r for r in rulebits.ablations(got).collect()}
    assert len(cases) == sum(map(len, rulebits.POLICIES.values()))
    for (policy, rule), r in cases.items():
        inside = [w[-1] & rulebits.mask(rulebits.POLICIES[policy]) for w in want]
        one = 1 << rulebits.BIT[rule]
        assert tuple(r)[2:] == (len(want), sum(x & one > 0 for x in inside), sum(x == 0 for x in inside), sum(x in (0, one) for x in inside))
    by_source = {r["source"]: r for r in rulebits.common_failures(rulebits.ledger(frame(spark, data)), "source").collect()}
    for source in {r[3] for r in data}:
        bits = [w[-1] for w, r in zip(want, data, strict=True) if r[3] == source]
        some, every = 0, -1
        for b in bits:
            some, every = some | b, every & b
        assert (by_source[source]["failed_by_any"], by_source[source]["failed_by_all"]) == (some, every)


def test_ledger_of_an_empty_table_and_a_long_text(spark):
    assert rulebits.ledger(empty(spark)).count() == 0
    none = rulebits.ablations(rulebits.ledger(empty(spark))).collect()
    assert len(none) and all(tuple(r)[2:] == (0, 0, 0, 0) for r in none)
    rnd = random.Random(1)
    text = " ".join(f"w{rnd.randrange(300)}" for _ in range(300_000))
    got = rulebits.measured(spark.createDataFrame([(1, text, None, None, None)], SCHEMA)).first()
    w = text.split()
    count = {}
    for i in range(len(w) - 2):
        count.setdefault((w[i], w[i + 1], w[i + 2]), []).append(i)
    assert got["n_repeat_words"] == len({p + j for at in count.values() if len(at) > 1 for p in at for j in range(3)})


def test_ledger_has_no_python_and_no_shuffle(spark):
    plan = rulebits.ledger(spark.range(3).selectExpr("id AS doc_id", "cast(id AS string) AS text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute_next(t):
    out = []
    for i in range(len(t)):
        j = next(j for j in range(i + 1, len(t) + 1) if t[j:] < t[i:])
        c = 0
        while j + c < len(t) and t[i + c] == t[j + c]:
            c += 1
        out.append((j, c))
    return out


def brute_runs(t, least=24, periods=3):
    out = []
    for q in range(1, len(t) // periods + 1):
        i = 0
        while i + q < len(t):
            start = i
            while i + q < len(t) and t[i] == t[i + q]:
                i += 1
            part = t[start : i + q]
            if i > start and len(part) >= max(least, periods * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, len(part), q))
            i += i == start
    return sorted(out, key=lambda x: (x[0], x[2]))


def sequences(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        k = rnd.choice([1, 2, 2, 3, 5])
        t = [rnd.randrange(k) for _ in range(rnd.randint(1, 50))]
        if rnd.random() < 0.6:
            p = rnd.randint(1, 8)
            t = (t[:p] * 20)[: rnd.randint(1, 70)]
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(len(t))] = rnd.randrange(k)
            t *= rnd.choice([1, 1, 2, 3])
        yield t


def test_next_smaller_and_runs_against_the_definitions():
    for t in sequences(1500, 1):
        assert list(zip(*(x[: len(t)] for x in runs.next_smaller(t)), strict=True)) == brute_next(t)
        assert runs.find_runs(t, 8, 3) == brute_runs(t, 8, 3)


class Counted(int):
    seen = 0

    def __eq__(self, other):
        Counted.seen += 1
        return int(self) == int(other)

    __hash__ = int.__hash__


def test_comparisons_are_linear():
    rnd = random.Random(2)
    fib, last = [0, 1], [0]
    while len(fib) < 20_000:
        fib, last = fib + last, fib
    period = [rnd.randrange(3) for _ in range(97)]
    texts = [fib[:20_000], [0] * 20_000, [0, 1] * 10_000, [i.bit_count() % 2 for i in range(20_000)], [rnd.randrange(2) for _ in range(20_000)], [((i + 1) & -(i + 1)).bit_length() for i in range(20_000)], period * 200]
    for t in texts:
        for order in (t, [max(t) - x for x in t]):
            Counted.seen = 0
            runs.next_smaller([Counted(x) for x in order])
            assert Counted.seen <= 2 * len(t)


def run_rows():
    rnd = random.Random(9)
    texts = [None, "", " \n", "a", "a " * 23, "a " * 24, "b a " * 40 + "c", "x y z\n" * 8, "x y z\t" * 7 + "x", "Ü b " * 30, "one two " * 11 + "one two one three " * 30]
    for t in sequences(150, 3):
        texts.append(" ".join(f"w{x}" for x in t))
    for _ in range(40):
        w = [f"v{rnd.randrange(200)}" for _ in range(rnd.randint(1, 400))]
        if rnd.random() < 0.7:
            a, p = rnd.randrange(len(w)), rnd.randint(1, 40)
            w[a:a] = (w[a : a + p] or ["q"]) * rnd.randint(2, 30)
        texts.append(rnd.choice([" ", "\n", "  "]).join(w))
    return [(i * 2, t, None, None, None) for i, t in enumerate(texts)] + [(None, "k " * 50, None, None, None), (2, "k " * 50, None, None, None), (2, "k " * 50, None, None, None)]


def brute_collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs(spark):
    data = run_rows()
    got = runs.periodic_runs(frame(spark, data, clash=True).withColumn("runs", F.lit(1)))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed_text"]
    want = []
    for doc, text, *_ in data:
        words = PLAIN.findall(text or "")
        found = brute_runs(words)
        want.append((doc, len(words), found, brute_collapsed(words, found)))
    assert sum(len(w[2]) for w in want) > 50
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert runs.periodic_runs(empty(spark)).count() == 0


def test_runs_of_a_long_text(spark):
    rnd = random.Random(5)
    period = [f"w{rnd.randrange(50_000)}" for _ in range(40_000)]
    words = ["start"] + period * 5 + ["stop"] + [f"w{rnd.randrange(50_000)}" for _ in range(300_000)] + ["la"] * 100_000
    got = runs.periodic_runs(spark.createDataFrame([(1, " ".join(words), None, None, None)], SCHEMA)).first()
    assert [tuple(x) for x in got["runs"]] == [(1, 200_000, 40_000), (500_002, 100_000, 1)]
    assert len(got["collapsed_text"].split()) == 1 + 40_000 + 1 + 300_000 + 1


def test_runs_query(spark, tmp_path):
    data = [(i, t, None, None, None) for i, (_, t, *_) in enumerate(run_rows())]
    rnd = random.Random(8)
    data += [(1_000 + i, " ".join(f"u{rnd.randrange(90)}" for _ in range(rnd.randint(1, 300))), None, None, None) for i in range(200)]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op13_lyndon_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(data)
    changed = 0
    for doc, text, *_ in data:
        words = PLAIN.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        found = brute_runs(words)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        r = got[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest()
    assert changed > 10
