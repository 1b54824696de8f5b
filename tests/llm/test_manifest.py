import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle_manifest

from messy import empty, table


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def steps_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        run, k = nodes[i // 16 * 16 : i // 16 * 16 + 16], i % 16
        out.append((run[:k], run[k + 1 :]))
        i //= 16
    return out


def brute(rows, change):
    trees = {}
    for r in rows:
        mine = leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        text = change(r)
        trees.setdefault(r.source, []).append(((r.doc_id is not None, r.doc_id or 0), mine, r.doc_id, mine if text is None else leaf(r.doc_id, r.source, r.lang, r.n_chars, text)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([x[1] for x in sorted(trees[s])]) for s in order}
    top = levels_of([built[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (_, mine, doc_id, tampered) in enumerate(sorted(trees[s])):
            steps, node = steps_of(built[s], i) + steps_of(top, at), tampered
            for a, b in steps:
                node = sha(*a, node, *b)
            out.append((doc_id, mine, built[s][-1][0], top[-1][0], sha(*(x for a, b in steps for x in a + b)), node, node == top[-1][0]))
    return out


def same(df, change_col, change):
    cols = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    got = [tuple(r[c] for c in cols) for r in merkle_manifest.verified(df, change_col).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(brute(df.collect(), change), key=key)


def test_manifest_against_brute_force(spark, sf):
    same(spark.read.parquet(f"{sf}/documents.parquet"), F.when(F.col("doc_id") % 3 == 0, F.upper("text")), lambda r: r.text.upper() if r.doc_id % 3 == 0 else None)


def test_manifest_of_messy_rows(spark):
    same(table(spark), F.when(F.col("doc_id") == 8, F.lit("two")), lambda r: "two" if r.doc_id == 8 else None)
    assert merkle_manifest.verified(empty(spark)).count() == 0 and merkle_manifest.manifest(empty(spark)).root is None


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16,), (17, 1), (256, 257, 15), (1,) * 40])
def test_trees_of_many_shapes(spark, sizes):
    r = random.Random(1)
    rows = [(r.randrange(10**9), f"text {r.random()}", "en", f"s{k}", None) for k, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same(df, None, lambda _: None)


def test_one_row_very_often(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1)] * 600 + [(2, "b", "en", None, 1)] * 30, "doc_id long, text string, lang string, source string, n_chars long")
    same(df, None, lambda _: None)


def test_manifest_keeps_sources(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", None, 1), (3, "c", "en", "", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    m = merkle_manifest.manifest(df)
    assert {r.source for r in m.sources.collect()} == {"s", None, ""} and m.sources.count() == 3 and len(m.root) == 64
