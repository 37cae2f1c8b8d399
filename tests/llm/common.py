"""Small document tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(n: int = 120, seed: int = 3) -> list[str | None]:
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(300)] + ["Ünï", "日本", "it's", "42", "###", "|"]
    sentence = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    shared = [sentence(14) for _ in range(6)]
    out: list[str | None] = [None, "", " \n\t", "x", "two words", "one two three", "A\nb\nA\n", "\n" * 5]
    while len(out) < n:
        body = [sentence(rnd.randint(1, 25)) for _ in range(rnd.randint(1, 8))]
        if rnd.random() < 0.4:
            body.insert(rnd.randint(0, len(body)), rnd.choice(shared).upper() if rnd.random() < 0.3 else rnd.choice(shared) + "  ")
        out.append("\n".join(body))
        if rnd.random() < 0.25:
            copy = out[-1].split(" ")
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            out.append(" ".join(copy))
    return out


def rows(seed: int = 3, n: int = 120) -> list[tuple]:
    rnd = random.Random(seed)
    out = [(i * 3, t, rnd.choice(["en", "de", None]), f"s{i % 3}", len(t or "")) for i, t in enumerate(texts(n, seed))]
    out.append((1, "long " * 30_000 + "end", "en", "s0", 1))
    rnd.shuffle(out)
    return out


def frame(spark, data=None, clash: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        for name in ("slot", "shard", "n_words", "items", "hit_spans", "n_lines", "n_dropped", "kept_text", "ids", "n_tokens", "ids_sha256", "spans", "log_weight", "held_out", "lang_pred", "score", "fingerprint", "c", "v", "rep", "sig"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
