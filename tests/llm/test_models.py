"""Learned and sampling operators: held-out accuracy, statistics over all rows, determinism, awkward rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from common import SCHEMA, empty, frame, rows, texts
from comparing import same_rows
from tidemark.llm import digest, langid, order, queries, resample, sql
from tidemark.llm import textwork as T


def labelled(spark, n=600, seed=2):
    """Good, spam and toxic documents with labels for a part of them."""
    rnd = random.Random(seed)
    clean = [f"word{i}" for i in range(400)]
    data, labels, kinds = [], [], {}
    for i in range(n):
        w = [rnd.choice(clean) for _ in range(rnd.randint(5, 80))]
        kind = rnd.choice(["good"] * 7 + ["toxic", "spam", "stutter"])
        if kind == "toxic":
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(["scum", "trash"])
        elif kind == "spam":
            w = [x + "!!" for x in w]
        elif kind == "stutter":
            w = [x for x in w for _ in range(9)]
        kinds[i] = kind
        data.append((i, " ".join(w), None, None, None))
        if rnd.random() < 0.5:
            labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic")))
    return data, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), kinds


def test_resampling_keeps_good_and_rejects_bad(spark):
    data, labels, kinds = labelled(spark, 3000)
    kept = [r["doc_id"] for r in resample.importance_resample(frame(spark, data, clash=True), labels).collect()]
    assert len(kept) == len(set(kept)) and kept == kept
    good = [i for i, k in kinds.items() if k == "good"]
    assert len(set(kept) & set(good)) >= 0.94 * len(good)
    assert len(set(kept) - set(good)) <= 0.2 * (len(data) - len(good))
    again = {r["doc_id"] for r in resample.importance_resample(frame(spark, data), labels).collect()}
    assert again == set(kept)


def test_resampling_rejects_a_rare_kind_of_bad_document(spark):
    data, _, kinds = labelled(spark, 3000)
    rare = list(range(10_000, 10_120))
    data += [(i, f"{data[i - 10_000][1]} vermin", None, None, None) for i in rare if kinds[i - 10_000] == "good"]
    rare = [r[0] for r in data if r[0] >= 10_000]
    marks = [(i, int(k in ("good", "toxic")), int(k == "toxic")) for i, k in kinds.items() if i % 2] + [(i, 1, 1) for i in rare[::2]]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in resample.importance_resample(frame(spark, data), labels).collect()}
    good = [i for i, k in kinds.items() if k == "good"]
    # One telling word in a few rows lends a weight of a half to a tenth, and the draw keeps about as many.
    scored = {r["doc_id"]: r["log_weight"] for r in resample.importance_resample(frame(spark, data), labels, scored=True).collect()}
    assert max(scored[i] for i in rare) < -0.5 and np.mean([scored[i] for i in good]) > -0.1
    assert len(kept & set(rare)) <= 0.6 * len(rare) and len(kept & set(good)) >= 0.93 * len(good)


def test_resampling_edges(spark):
    data, labels, _ = labelled(spark, 60)
    assert resample.importance_resample(empty(spark), labels).count() == 0
    assert resample.importance_resample(frame(spark, data), labels.limit(0)).count() == len(data)
    odd = [*data, data[0], (None, "a null id", None, None, None), (None, None, None, None, None), (900, None, None, None, None), (901, "", None, None, None)]
    out = resample.importance_resample(frame(spark, odd), labels, k=len(odd)).collect()
    assert len(out) == len(odd) and set(out[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "log_weight", "log_weight_noisy"}
    assert resample.importance_resample(frame(spark, odd), labels, k=7).count() == 7
    assert resample.importance_resample(frame(spark, odd), labels, share=0.5).count() == round(0.5 * len(odd))
    same = [(5, "one text", None, None, None)] * 9 + [(6, "another", None, None, None)]
    for k in range(11):
        assert resample.importance_resample(frame(spark, same), labels.limit(0), k=k).count() == k
    nulls = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, None)], labels.schema))
    assert resample.importance_resample(frame(spark, odd), nulls, k=5).count() == 5


@pytest.mark.parametrize("n,k", [(1000, 1), (1000, 999), (1000, 1000), (1000, 0), (200_500, 70_001)])
def test_top_k_is_exact(spark, n, k):
    df = spark.range(n).select("id", (F.pmod(F.xxhash64("id"), F.lit(n // 3)) / 7.0).alias("s"))
    got = sorted((r["s"], r["id"]) for r in resample.top_k(df, k, "s", ["id"]).collect())
    want = sorted(sorted(((r["s"], r["id"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))[:k])
    assert got == want


def test_gumbel_is_standard(spark):
    got = spark.range(20_000).select(F.avg(resample.gumbel(1, F.col("id"))), F.stddev(resample.gumbel(1, F.col("id")))).first()
    assert abs(got[0] - 0.5772) < 0.03 and abs(got[1] - math.pi / math.sqrt(6)) < 0.03


def test_counts_are_of_all_rows(spark):
    data = rows()
    wanted = np.unique(np.array([r[0] for r in frame(spark, data).filter("doc_id % 2 = 0").select(F.xxhash64(F.col("doc_id").cast("string"))).collect()], np.int64))
    target, raw, n_target, n_raw = resample.fit_counts(frame(spark, data).withColumn("h", F.xxhash64(F.col("doc_id").cast("string"))), "h", "text", wanted, 8)
    want = np.zeros(4 << 8)
    for _, t, *_ in data:
        _, a, b = resample.buckets([(t or "").encode()], 8)
        np.add.at(want, a, 1)
        np.add.at(want, b, 1)
    assert (raw == want).all() and n_raw == len(data) and n_target == sum(i % 2 == 0 for i, *_ in data) and (target <= raw).all()


def test_ratios_and_weights_against_brute_force(spark):
    data, labels, _ = labelled(spark, 1500)
    marks = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.collect()}
    bits = 12
    found = {i: resample.buckets([t.encode()], bits)[1:] for i, t, *_ in data}
    raw, target = {}, {}
    for i, pair in found.items():
        for b in [*pair[0].tolist(), *pair[1].tolist()]:
            raw[b] = raw.get(b, 0) + 1
            if marks.get(i) == (1, 0):
                target[b] = target.get(b, 0) + 1
    f = sum(target.values()) / sum(raw.values())

    def ratio(b):
        e, t = raw[b] * f, target.get(b, 0)
        if abs(t - e) <= resample.LEAST_SIGMAS * math.sqrt(max(e, 1)):
            return 0.0
        value = math.log((t + resample.PRIOR) / (e + resample.PRIOR))
        return math.copysign(max(abs(value) - resample.SHRINK, 0.0), value)

    want = {}
    for i, (first, second) in found.items():
        pairs = [(ratio(x), ratio(y)) for x, y in zip(first.tolist(), second.tolist(), strict=True)]
        want[i] = sum(min(p, key=abs) for p in pairs if p[0] * p[1] > 0)
    got = {r["doc_id"]: r["log_weight"] for r in resample.importance_resample(frame(spark, data), labels, bits=bits, scored=True).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-4 for i in want) and min(want.values()) < -0.5


def test_the_draw_follows_the_weights(spark):
    """Inclusion by seed: the rates of a draw without replacement, worked out by simulating it."""
    weights = np.array([0.0] * 40 + [-1.0] * 40 + [-3.0] * 40)
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "id long, w double")
    seen, samples = np.zeros(len(weights)), []
    for seed in range(60):
        rows = resample.top_k(df.select("id", (F.col("w") + resample.gumbel(seed, F.col("id"))).alias("s")), 50, "s", ["id"]).collect()
        samples.append(frozenset(r["id"] for r in rows))
        seen[list(samples[-1])] += 1
    assert len(set(samples)) == 60
    rng = np.random.default_rng(0)
    want = np.zeros(len(weights))
    for _ in range(400):
        want[rng.choice(len(weights), 50, replace=False, p=np.exp(weights) / np.exp(weights).sum())] += 1
    for part in (slice(0, 40), slice(40, 80), slice(80, 120)):
        assert abs(seen[part].mean() / 60 - want[part].mean() / 400) < 0.04


def test_two_seeds_draw_two_samples(spark):
    data, labels, _ = labelled(spark, 300)
    one, two = ({r["doc_id"] for r in resample.importance_resample(frame(spark, data), labels, share=0.4, seed=s).collect()} for s in (1, 2))
    assert len(one) == len(two) == 120 and len(one & two) < 100


LANGS = {"aa": "the and thing with", "bb": "der und nicht schön", "cc": "ciónes para señor que"}


def language_rows(n=240, seed=6):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(LANGS))
        syllables = [s for w in LANGS[lang].split() for s in (w, w[:3])]
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(4, 60))]
        out.append((i, " ".join(words), lang, "s", 1))
    return out


def test_language_of_held_out_documents(spark):
    data = language_rows()
    out = {r["doc_id"]: r for r in langid.identify(frame(spark, data, clash=True)).collect()}
    held = [(i, lang) for i, _, lang, *_ in data if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in out.items() if r["held_out"]} == {i for i, _ in held}
    assert sum(out[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_language_edges(spark):
    odd = [(1000, None, "aa", None, None), (1001, "", None, None, None), (1002, "12 !! 😀", "bb", None, None), (1003, "日本", None, None, None), (None, "the and thing", None, None, None), (1004, "the " * 40_000, None, None, None)]
    out = {r["doc_id"]: r for r in langid.identify(frame(spark, [*language_rows(), *odd])).collect()}
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1000]["score"] == 0
    assert out[1003]["lang_pred"] in LANGS and out[None]["lang_pred"] == "aa" and out[1004]["lang_pred"] == "aa"
    assert {r["lang_pred"] for r in langid.identify(frame(spark, [(1, "text", None, None, None)])).collect()} == {"und"}
    assert langid.identify(empty(spark)).count() == 0


def test_code_switched_words():
    data = language_rows()
    model = langid.train([t.encode() for _, t, *_ in data], [x for _, _, x, *_ in data])
    got = langid.label_words(model, "thing with thethe undder schönnicht nichtund señorpara ciónes".encode())
    assert [x for _, x, _ in got] == ["aa", "aa", "aa", "bb", "bb", "bb", "cc", "cc"]


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_forward_backward_against_enumeration(block):
    import itertools

    rng = np.random.default_rng(3)
    scores, jump = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    start, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    got, expected = langid.forward_backward(scores, start, size, jump, pairs=True, block=block)
    want, pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for s, n in zip(start, size, strict=True):
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([np.exp(sum(scores[s + t, y] for t, y in enumerate(p)) + sum(jump[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths])
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for t, y in enumerate(p):
                want[s + t, y] += w
            for a, b in zip(p, p[1:], strict=False):
                pairs[a, b] += w
    assert np.allclose(got, want) and np.allclose(expected, pairs)


def test_prediction_against_enumeration():
    import itertools

    data = language_rows()
    model = langid.train([t.encode() for _, t, *_ in data], [x for _, _, x, *_ in data])
    shift = 64 - model.bits
    one = lambda b: int(T.span_hash(T.prefix_hash(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)]))[0])
    mixed = lambda x: int(T.mix(np.array([x % 2**64], np.uint64))[0]) >> shift
    text = "Thing und-die señor schönn thewith x"
    words = [w for w in __import__("re").findall(rb"[a-z\x80-\xff]+", text.lower().encode())]
    scores = []
    for w in words:
        padded = b" " + w + b" "
        rows_ = [one(w) >> shift] + [mixed(one(part) + salt) for n in (1, 2, 3) for part, salt in ((w[:n], n), (w[-n:], n + 8))]
        rows_ += [mixed((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) + (1 << 40)) for i in range(len(w))]
        known = np.flatnonzero(model.lexicon == np.uint64(one(w)))
        scores.append(model.table[rows_].sum(axis=0) + model.lexicon_weight[model.lexicon_language[known[0]] if len(known) else len(model.languages)])
    n = len(model.languages)
    paths = list(itertools.product(range(n), repeat=len(words)))
    weight = np.array([np.exp(sum(scores[t][y] for t, y in enumerate(p)) + sum(model.transitions[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths])
    share = np.zeros(n)
    for p, w in zip(paths, weight / weight.sum(), strict=True):
        for y in p:
            share[y] += w / len(words)
    (name,), (score,) = langid.predict(model, [text.encode()])
    assert name == model.languages[int(share.argmax())] and abs(score - share.max()) < 1e-4


def test_many_languages_and_a_repeatable_sample(spark):
    assert langid.bits_for(4) == 18 and langid.bits_for(64) == 18 and langid.bits_for(1000) == 14
    rnd = random.Random(8)
    data = [(i, " ".join(f"{'abcdefghijklmnopqrst'[i % 80 // 4]}{'uvwx'[i % 4]}{rnd.randrange(30)}z" for _ in range(12)).replace("0", "o"), f"l{i % 80:02d}", None, None) for i in range(1600)]
    texts, languages = langid.training_rows(frame(spark, data), "lang", "doc_id", "text", 5)
    again = langid.training_rows(frame(spark, data).repartition(7), "lang", "doc_id", "text", 5)
    assert len(set(languages)) == 80 and max(languages.count(x) for x in set(languages)) == 5 and (texts, languages) == again
    long = [(1, "ab " * 9000, "x", None, None)]
    assert [len(t) for t in langid.training_rows(frame(spark, long), "lang", "doc_id", "text", 5)[0]] == [langid.TRAIN_CHARS]


def test_transitions_learn_a_switch():
    data = language_rows()
    model = langid.train([t.encode() for _, t, *_ in data], [x for _, _, x, *_ in data])
    off = model.transitions[~np.eye(3, dtype=bool)]
    assert (np.diag(model.transitions) > off.max()).all() and off.min() > -4


def test_next_and_edited(spark):
    data = [*rows(), (None, "null id", None, None, None), (6, "zz repeated id", None, None, None), (6, "aa repeated id", None, None, None)]
    out = order.with_next(frame(spark, data, clash=True), shard_docs=11).collect()
    listed = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = sorted((r[0], r[1] or "", listed[(i + 1) % len(listed)][1] or "") for i, r in enumerate(listed) if r[0] is not None)
    assert sorted((r["doc"], r["text"], r["next"]) for r in out if r["doc"] is not None) == want and len(out) == len(data)
    one = order.with_next(frame(spark, [(5, "only", None, None, None)])).collect()
    assert [(r["doc"], r["text"], r["next"]) for r in one] == [(5, "only", "only")]
    assert order.with_next(empty(spark)).count() == 0


def test_entropy_levels_against_the_definition():
    buf = np.frombuffer(("Some text, with aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa run and ünïcödé 12345 " * 3).encode(), np.uint8)
    got = digest.levels(buf)
    for i in range(len(buf) - digest.WINDOW + 1):
        _, c = np.unique(buf[i : i + digest.WINDOW], return_counts=True)
        p = c / digest.WINDOW
        level = -(p * np.log2(p)).sum() * digest.LEVELS / np.log2(digest.WINDOW)
        assert abs(got[i] + 0.5 - level) <= 0.51


def test_digests(spark):
    data = rows() + [(5000, rows()[10][1], None, None, None)]
    ranks = digest.entropy_ranks(frame(spark, data))
    assert sorted(ranks) == list(range(digest.LEVELS))
    out = {r["doc_id"]: r for r in digest.fingerprints(frame(spark, data, clash=True), {"text": "fingerprint"}, ranks).collect()}
    by_text = {}
    for i, t, *_ in data:
        by_text.setdefault(t or "", set()).add(out[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert digest.fingerprints(empty(spark), {"text": "f"}, ranks).count() == 0
    table = np.array(ranks)
    prints = lambda *t: [digest.Print.of(x) for x in digest.features([x.encode() for x in t], table)]
    rnd = random.Random(1)
    for size in (4, 12, 30, 200, 3000, 40_000):
        a, b = ("".join(rnd.choice("abcdefghijklmnop qrstuvw") for _ in range(size)) for _ in (1, 2))
        edited = a[: size - size // 4] + b[: size // 4]
        fa, fb, fe, fe2 = prints(a, b, edited, edited)
        assert fe.text() == fe2.text() and digest.compare(fa, fa) == 1 and digest.likeness(fa.text(), fa.text()) == 1
        assert digest.compare(fa, fe) > 0.3 and digest.compare(fa, fe) > digest.compare(fa, fb) + 0.15
        assert digest.compare(fa, fe) == digest.compare(fe, fa) == digest.likeness(fa.text(), fe.text())
    none = prints("")[0]
    assert digest.compare(none, fa) == 0 and digest.likeness(none.text(), none.text()) == 1 and digest.likeness(None, none.text()) is None


def test_digests_of_every_size():
    table = np.random.default_rng(0).permutation(digest.LEVELS)
    prints = lambda *t: [digest.Print.of(x) for x in digest.features([x.encode() for x in t], table)]
    rnd = random.Random(2)
    for size in range(2, 301):
        text = "".join(rnd.choice(rnd.choice(["abcdefghijklmnop qrstuvw", "ab"])) for _ in range(size))
        whole, front, back = prints(text, text[:-1], text[1:])
        assert digest.compare(whole, front) >= 0.8 and digest.compare(whole, back) >= 0.8, size
    a, b, dash, ab, the, la = prints("a" * 300, "b" * 300, "-" * 300, "ab" * 150, "the " * 180, "la " * 180)
    assert digest.compare(a, b) == 0 and digest.compare(dash, ab) < 0.1 and digest.compare(the, la) < 0.2
    long, longer = prints("ab" * 5000, "ab" * 5001)
    assert long.n_few == longer.n_few > 0 and digest.compare(long, longer) == 1


def test_digest_features_against_brute_force():
    table = np.random.default_rng(1).permutation(digest.LEVELS)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefgh ijklmnü") for _ in range(n)) for n in (0, 1, 7, 40, 90, 400)] + ["x" * 200, "ab" * 900]
    got = digest.features([t.encode() for t in texts], table)
    for text, (few, rare) in zip(texts, got, strict=True):
        b = text.encode()
        code = lambda w: int(T.mix(np.array([(int.from_bytes(w, "little") + len(w) * int(T.STEP)) % 2**64], np.uint64))[0])

        def hashed(window):
            out = 0
            for j in range(0, digest.WINDOW, 8):
                out = (out * int(T.STEP) + code(window[j : j + 8])) % 2**64
            return int(T.mix(np.array([out], np.uint64))[0])

        keys = set()
        for rank, width in enumerate(digest.BASE_WIDTHS):
            keys |= {(rank << 62) | (code(b[i : i + width]) >> 2) for i in range(len(b) - width + 1)}
        want = sorted(keys)[: digest.BASE_FEATURES]
        assert sorted(few.tolist()) == sorted(int(T.mix(np.array([k], np.uint64))[0]) for k in want)
        wins = {}
        windows = []
        for i in range(len(b) - digest.WINDOW + 1):
            level = int(digest.levels(np.frombuffer(b[i : i + digest.WINDOW], np.uint8))[0])
            windows.append(None if level < digest.LEAST_LEVEL else (table[level], hashed(b[i : i + digest.WINDOW]) >> 40, i))
        for i in range(len(windows) - digest.POPULAR + 1):
            among = [w for w in windows[i : i + digest.POPULAR] if w]
            if among:
                wins[min(among)[2]] = wins.get(min(among)[2], 0) + 1
        best = [hashed(b[i : i + digest.WINDOW]) for i in sorted(wins) if wins[i] >= digest.LEAST_WINS]
        assert rare.tolist() == list(dict.fromkeys(best))


def test_op3_query(spark, sf_dir):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    out = {r["doc_id"]: r for r in queries.op3_improbable_digest(spark, sf_dir).collect()}
    for n, (i, text) in enumerate(docs):
        after, cut = docs[(n + 1) % len(docs)][1], len(text) // 4
        assert out[i]["n_chars"] == len(text) and out[i]["edited_sha256"] == hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()
    assert np.mean([r["near_edited"] > r["near_next"] for r in out.values()]) > 0.98


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_oracles(name, spark, sf_dir, duck):
    same_rows(queries.queries()[name](spark, sf_dir), duck.sql(sql.ORACLES[name]))


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]


def stage_rows():
    return [*rows(5, 60), *rows(5, 60)[:3], (None, "a null id", None, None, None), (None, None, None, None, None), (7, "", "en", "s", 0), (7, "seven again", "en", "s", 0)]


def brute_stage(name, data, bench):
    """The rows (id, text) that the stage's rule keeps, in any order; None where a draw decides."""
    if name == "line_dedup":
        from test_exact import brute_lines

        lines = brute_lines(data)
        return [(i, None if t is None else lines[i, t][2]) for i, t, *_ in data if lines[i, t][1] == 0 or lines[i, t][2].strip(" \t\n\x0b\x0c\r")]
    if name == "near_duplicates":
        from test_exact import brute_classes

        known = [r for r in data if r[0] is not None]
        numbered = [(n, t) for n, (_, t, *_) in enumerate(known)]
        classes = brute_classes(numbered, 5, 80, 100)
        least = {}
        for n, (_, c) in classes.items():
            least[c] = min(least.get(c, known[n][0]), known[n][0])
        kept = {}
        for n, (size, c) in classes.items():
            if size == 0:
                kept[n] = known[n]
            elif known[n][0] == least[c]:
                kept.setdefault((c, tuple((known[n][1] or "").lower().split())), known[n])
        return [(r[0], r[1]) for r in kept.values()] + [(i, t) for i, t, *_ in data if i is None]
    if name == "benchmark_leaks":
        from test_exact import brute_leaks

        return [(i, t) for i, t, *_ in data if not brute_leaks([(i, t)], bench)[i][1]]
    return None


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_rows(spark, tmp_path, number):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    name, stage = corpus_pipeline.STAGES[number]
    data = stage_rows()
    bench = [("a", " ".join((data[20][1] or "x").split()[:12])), ("b", None)]
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0), (6, 1, 0), (9, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, data)
    for n in ("N_lines", "ITEMS", "hash", "Log_Weight", "spans"):
        docs = docs.withColumn(n, F.lit("clash"))
    out = stage(spark, docs, str(tmp_path))
    got = out.collect()
    if name == "bpe":
        assert len(got) == len(data) and sum(r["n_tokens"] == 0 for r in got) == sum(not (t or "").strip() for _, t, *_ in data)
    else:
        assert out.columns == docs.columns and all(r["ITEMS"] == "clash" for r in got)
        want = brute_stage(name, data, bench)
        key = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")
        if want is None:
            assert {(r["doc_id"], r["text"]) for r in got} <= {(i, t) for i, t, *_ in data} and len(got) <= len(data)
        else:
            assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(want, key=key)
    none = stage(spark, docs.limit(0), str(tmp_path))
    assert none.count() == 0 and (name == "bpe" or none.columns == docs.columns)


def test_pipeline(spark, sf_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()} if "text" in docs.columns else {}
        from tidemark.session import staged

        docs = staged(stage(spark, docs, sf_dir), "test-pipeline")
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= set(before) and (name == "bpe" or docs.columns == names)
        seen[name] = after
    clean = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(seen["quality"] & clean) >= 0.95 * len(clean)
    assert seen["bpe"] == seen["benchmark_leaks"] and seen["bpe"]
    assert texts(10) and SCHEMA
