"""A documents table with what can go wrong in one, and columns whose names operators might use themselves."""

import random

CLASH = "kept keep_id group_size digest norm row state size h1 h2 tie shard slot node component id a b n ll best host declared suffix text_sha256 site pos line hits pattern posterior stay_id stay_sha doc topic lot probability n_tokens tree sketch s1 s2 at part block turns raw".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def words(seed, n, k=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(k)}" for _ in range(n)]


def texts():
    base = words(1, 300)
    near = [*base]
    near[150] = "changed"
    far = [*base]
    far[::7] = ["x"] * len(far[::7])
    junk = " ".join(f"{w}###" for w in words(2, 120))
    long_ = " ".join(words(3, 60_000, 10**6))
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, "\n".join([" ".join(base[:150]), " ".join(base[150:])])), (5, None), (6, ""), (7, " \t\n\x0b\x0c\r "), (8, "one"), (9, "One"), (10, "one two three four"),
        (11, junk), (12, "same line here again\n" * 30), (13, long_), (14, long_ + "  "), (15, "Ärger 日本語 \U0001f389 naïve café İΣ"), (16, "A.\nB.\n\nA."), (17, "a" * 5000), (18, " ".join(base).upper()), (19, "\x00 odd \x1c bytes   space"),
        (20, " ".join(base)), (20, " ".join(base)), (None, " ".join(base)), (None, "nobody's text"), (21, "a, b. c! d? e; f: g (h) [i] {j}"), (2**62, "big id"), (-5, "negative id"),
    ]


def table(spark, rows=None):
    out = []
    for i, (d, t) in enumerate(texts() if rows is None else rows):
        out.append((d, t, ["en", "de", None, "xx"][i % 4], [None, "s0", "s0", "s0", f"s{i}"][i % 5], None if i % 3 else 7, *["clash"] * len(CLASH)))
    return spark.createDataFrame(out, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
