import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import collocations

from messy import empty, table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count(rows, least):
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        for piece in re.split("[.,;:!?\n-\r]", (r.text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for i in range(len(w)) for k in range(1, 6) if i + k <= len(w))
    return {k: v for k, v in f.items() if v >= least}, n


def brute(rows, least, top, percent=100):
    f, n = count(rows, least)
    out = {}
    for (lang, w), a in f.items():
        if len(w) > 1:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang, w] = (a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)
    inside = {(lang, w[i : i + k]) for (lang, w), a in f.items() if len(w) > 2 for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= percent * f[lang, w[i : i + k]]}
    rows = []
    for lang in {x for x, _ in out}:
        mine = sorted((-v[4], -v[0], " ".join(w).encode(), v) for (g, w), v in out.items() if g == lang and (g, w) not in inside)
        rows += [(lang, i + 1, p.decode(), *v) for i, (_, _, p, v) in enumerate(mine[:top])]
    return sorted(rows)


@pytest.fixture(scope="module")
def crowd(spark):
    """Repeated passages, a very common pair, one-word pieces, odd spaces, another language, null columns."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Ärger", "日本", "A", "a"]
    text = lambda n: "".join(r.choice(words) + r.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!? "]) for _ in range(n))
    copied = text(60)
    rows = [(i, r.choice([text(r.randrange(80)), copied, "of the " + text(20), "of the end", "x", "", None, text(20) + copied]), r.choice(["en", "fr", "fr", None, "und"])) for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).cache()


@pytest.mark.parametrize("kinds", [{}, {"filter_words": 1}, {"crowd": 0}, {"crowd": 40, "filter_words": 64}])
def test_counts_against_brute_force(crowd, kinds):
    f, totals = collocations.counts(crowd, 15, **kinds)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in f.collect()}
    want, n = count(crowd.collect(), 15)
    assert got == want and f.count() == len(want) and {r.lang: r.n for r in totals.collect()} == {k: v for k, v in n.items() if v}


@pytest.mark.parametrize("top,percent", [(2000, 100), (7, 100), (50, 60)])
def test_collocations_against_brute_force(crowd, top, percent):
    got = sorted(map(tuple, collocations.collocations(crowd, 12, top, percent, crowd=100).collect()))
    assert got == brute(crowd.collect(), 12, top, percent) and len(got) > 20


def test_small_chunks_and_buffers(spark, sf, monkeypatch):
    """Texts that are cut between pieces, and a sort that goes through many buffers, give the same counts."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()
    monkeypatch.setattr(collocations, "CHUNK", 200)
    monkeypatch.setattr(collocations, "HELD", 50)
    import pyarrow as pa

    seen = Counter()
    for lang, c in collocations.chunks_of(pa.record_batch({"lang": pa.array([r.lang for r in rows]), "text": pa.array([r.text for r in rows], pa.string())})):
        words = c.words.to_pylist()
        seen.update((lang, (words[x],)) for x in c.codes.tolist())
        seen.update((lang, (words[x], words[y])) for x, y, p, q in zip(c.codes, c.codes[1:], c.piece, c.piece[1:], strict=False) if p == q)
    want, _ = count(rows, 1)
    assert seen == {k: v for k, v in want.items() if len(k[1]) < 3}


def test_quicksort_on_random_rows():
    r = np.random.default_rng(5)
    for _ in range(40):
        n, least = int(r.integers(1, 400)), int(r.integers(1, 9))
        words = r.integers(0, int(r.integers(1, 5)), (n, 5))
        for i, k in enumerate(r.integers(2, 6, n)):
            words[i, k:] = -1
        group = np.unique(words[:, :2], axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(group, kind="stable")
        words, group, weight = words[order], group[order], r.integers(1, 4, n)
        got = {}
        for at, size, c in collocations.quicksort(words, weight, group, np.full(n, 2), least):
            for a, k, x in zip(at, size, c, strict=True):
                assert tuple(words[a, :k]) not in got
                got[tuple(words[a, :k])] = x
        want = Counter()
        for w, x in zip(words.tolist(), weight.tolist(), strict=True):
            for k in range(3, 6):
                if -1 not in w[:k]:
                    want[tuple(w[:k])] += x
        assert got == {k: v for k, v in want.items() if v >= least}


def test_messy_phrases(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    rows = table(spark)
    assert sorted(map(tuple, collocations.collocations(rows, 3).collect())) == brute(rows.collect(), 3, 2000)


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**12
    f = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)], "lang string, phrase string, words int, f long")
    n = 9 * 10**12
    got = collocations.scored(f, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got["score"] == 1000 * (big - 1) * n // (big * big)


def test_texts_of_many_suffixes_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    text = " ".join(f"w{i % 977} x" for i in range(700_000))
    batch = pa.record_batch({"lang": pa.array(["en"]), "text": pa.array([text[: 1 << 22].replace("w976 ", "w976.")])})
    tracemalloc.start()
    try:
        n = 0
        for _, c in collocations.chunks_of(batch):
            before = tracemalloc.get_traced_memory()[0]
            tracemalloc.reset_peak()
            at = np.arange(len(c.codes) - 4)
            out = c.phrases(at, np.full(len(at), 5))
            assert tracemalloc.get_traced_memory()[1] - before < 60e6
            words = c.words.to_pylist()
            for i in {0, 65535, 65536, len(at) - 1} & set(at.tolist()):
                assert out[i].as_py() == " ".join(words[k] for k in c.codes[i : i + 5])
            n += len(out)
        assert n > 500_000
    finally:
        tracemalloc.stop()


def test_routes_go_on_over_sorted_lots(spark, monkeypatch):
    """Lots of the sort that are smaller than a route change no count."""
    monkeypatch.setattr(collocations, "SORTED", 7)
    rng = random.Random(5)
    docs = table(spark, [(i, " ".join(rng.choice("abcdef") for _ in range(40))) for i in range(60)])
    f, _ = collocations.counts(docs, least=3)
    want, _ = count(docs.collect(), 3)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in f.collect()} == want
