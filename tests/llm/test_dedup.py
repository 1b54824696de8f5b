import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import components as cc
from ledgerloom.llm import exact_dedup as E
from ledgerloom.llm import line_dedup as L
from ledgerloom.llm import near_dedup as N
from ledgerloom.llm.queries import ORACLES, QUERIES

from messy import empty, table, texts, words

WHITE = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(WHITE.sub("", t or ""), []).append((d, t or ""))
    out = []
    for norm, g in groups.items():
        best = min(g, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0]
        out += [(d, best, len(g), hashlib.sha256(norm.encode()).hexdigest()) for d, _ in g]
    return sorted(out, key=str)


def shown(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


DIGESTS = [E.sha256, lambda n: F.substring(F.sha2(n, 256), 1, 1), lambda n: F.lit("x")]


@pytest.mark.parametrize("digest", DIGESTS)
def test_exact_against_brute_force(spark, digest):
    out = E.dedup(spark, table(spark), digest=digest)
    assert shown(out) == brute_exact(texts())
    kept = out.where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({x[3] for x in shown(out)})
    assert all(r.doc_id == r.keep_id and r.locator == r.keep_locator for r in kept)


@pytest.mark.parametrize("digest", DIGESTS[::2])
def test_state_over_batches(spark, digest):
    """Three batches, rows added again, and unequal texts under one digest across batches."""
    rows = texts()
    state = E.ExactDedup(spark, digest=digest, files_per_batch=2)
    for i in range(3):
        assert state.add(table(spark, rows[i::3]).coalesce(1)) == i
    again = rows[::4]
    state.add(table(spark, again).coalesce(1))
    every = rows + again
    out = state.result()
    assert shown(out) == brute_exact(every)
    kept = out.where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({x[3] for x in brute_exact(every)}) and all(r.doc_id == r.keep_id for r in kept)
    assert sum(state.result(b).count() for b in range(4)) == len(every)
    later = E.ExactDedup(spark, state.path, digest)
    later.add(table(spark, [(99, "one")]).coalesce(1))
    assert shown(later.result(4)) == [x for x in brute_exact([*every, (99, "one")]) if x[0] == 99]


def test_a_callers_state_and_tables_stay(spark, tmp_path):
    path, first, second = str(tmp_path / "state"), str(tmp_path / "a"), str(tmp_path / "b")
    table(spark, [(1, "same"), (2, "same")]).coalesce(1).write.parquet(first)
    table(spark, [(0, "sa me"), (3, "other")]).coalesce(1).write.parquet(second)
    E.dedup(spark, first, path)
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in E.dedup(spark, second, path).collect()) == [(0, 0, True), (3, 3, True)]
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in E.ExactDedup(spark, path).result().collect()) == [(0, 0, True), (1, 0, False), (2, 0, False), (3, 3, True)]
    E.dedup(spark, first, path)  # the same files once more are rows of their own
    out = E.ExactDedup(spark, path).result().collect()
    assert len(out) == 6 and sum(r.kept for r in out) == 2


@pytest.mark.parametrize("stop", ["fingerprints", "fold", "updates"])
@pytest.mark.parametrize("kind", ["frame", "path"])
def test_a_repeated_add_counts_once(spark, tmp_path, monkeypatch, stop, kind):
    """add() fails after the fingerprints, in the fold, and after the updates; each time it is repeated."""
    rows = texts()
    state = E.ExactDedup(spark)

    def batch(i):
        df = table(spark, rows[i::2]).coalesce(1)
        if kind == "frame":
            return df
        df.write.mode("ignore").parquet(str(tmp_path / f"in{i}"))
        return str(tmp_path / f"in{i}")

    state.add(batch(0))
    real = E.ExactDedup._fold

    def fails(self):
        if stop == "updates":
            real(self)
        if stop == "fold":
            self.spark.readStream.schema(E.FINGERPRINT).parquet(self.rows)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(E.ExactDedup, "_fold", fails)
        for _ in range(2):
            with pytest.raises(OSError):
                state.add(batch(1))
    assert state.add(batch(1)) == 1
    out = state.result()
    assert shown(out) == brute_exact(rows) and sum(r.kept for r in out.collect()) == len({x[3] for x in brute_exact(rows)})
    assert state.add(batch(1)) == 2  # when nothing had failed, the same rows once more are rows of their own


def test_what_failed_is_finished_before_other_documents(spark, monkeypatch):
    state, rows = E.ExactDedup(spark), texts()
    with monkeypatch.context() as m:
        m.setattr(E.ExactDedup, "_fold", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.add(table(spark, rows[::2]).coalesce(1))
    assert state.add(table(spark, rows[1::2]).coalesce(1)) == 1 and shown(state.result()) == brute_exact(rows)


def test_exact_keeps_whole_rows(spark):
    df = table(spark)
    out = E.deduplicated(df)
    assert out.columns == df.columns and out.count() == len({WHITE.sub("", t or "") for _, t in texts()})
    assert E.dedup(spark, empty(spark)).count() == 0 and E.deduplicated(empty(spark)).count() == 0


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            c, b = sets[j]
            if a and b and d is not None and c is not None and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, len(s), least.get(find(i), d) if d is not None else None) for i, (d, s) in enumerate(sets)], key=str)


def copies(seed=5, n=160):
    """A chain of copies with more and more changes, copies of one original, and texts that share a passage."""
    r, rows = random.Random(seed), []
    base, shared = words(50, 200), words(51, 40)
    for i in range(n):
        t = [*base]
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 13])):
            t[r.randrange(len(t))] = f"m{r.randrange(10**6)}"
        rows.append((1000 + i, " ".join(t)))
    rows += [(3000 + i, " ".join(shared + words(100 + i, 120))) for i in range(80)]
    chain = words(60, 150)
    for i in range(20):
        chain = [*chain]
        chain[r.randrange(150)] = f"c{i}"
        rows.append((5000 + i, " ".join(chain)))
    return rows


PLANS = [N.Plan(), N.Plan(node=12, small=4, depth=3, group=3, rounds=1, trees=6), N.Plan(node=6, small=3, depth=3, group=20, group_bytes=9000, rounds=1, trees=4), N.Plan(node=40, small=3, group=10**6)]


@pytest.mark.parametrize("plan", PLANS)
def test_near_against_brute_force(spark, plan):
    rows = copies()
    got = N.near_groups(table(spark, rows), plan).collect()
    want = brute_near(rows)
    have = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str)
    assert have == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_two_texts_under_one_doc_id(spark):
    one, two = (" ".join(f"{k}{i}" for i in range(200)) for k in "ab")
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(1, one), (1, two), (1, two), (2, near(two)), (3, near(one)), (4, "something else"), (4, "again else"), (5, None), (5, two), (None, one), (6, "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want = [(1, 196, 1, True)] * 3 + [(2, 196, 1, False), (3, 196, 1, False), (4, 1, 4, True), (4, 1, 4, True), (5, 0, 5, True), (5, 196, 1, False), (None, 196, None, True), (6, 0, 6, True)]
    assert got == sorted(want, key=str)


def test_near_on_messy_rows(spark):
    got = N.near_groups(table(spark)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_near(texts())
    assert N.near_groups(empty(spark)).count() == 0
    df = table(spark)
    out = N.deduplicated(df)
    assert out.columns == df.columns and {1, 5, 6, 8, 10, None} <= {r.doc_id for r in out.collect()} and not {2, 4, 9, 14, 18, 20} & {r.doc_id for r in out.collect()}


def test_forest_joins_what_all_pairs_join():
    r = np.random.default_rng(6)
    for n, m in ((5, 3), (30, 25), (200, 900), (50, 0)):
        x, y, same = r.integers(0, n, m), r.integers(0, n, m), r.integers(0, 5, m)
        ok = x != y
        x, y, same = x[ok], y[ok], same[ok]
        keep = N.forest(x, y, same)

        def parts(pairs, n=n):
            label = list(range(n))
            for _ in range(n):
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert parts(list(zip(x[keep], y[keep], strict=True))) == parts(list(zip(x, y, strict=True)))
        assert len(keep) == n - len(set(parts(list(zip(x, y, strict=True)))))


def test_a_node_whose_sets_all_part():
    plan = N.Plan(small=2)
    sk = np.arange(5 * 128, dtype=np.uint32).reshape(5, 128)
    batch = N.pa.record_batch({"tree": N.pa.array([0] * 5, N.pa.int32()), "node": N.pa.array([7] * 5, N.pa.int64()), "id": N.pa.array(range(5), N.pa.int64()), "sketch": N.pa.array([x.tobytes() for x in sk], N.pa.binary())})
    assert sum(b.num_rows for b in N._compare(plan, 1)(iter([batch]))) == 0


def test_search_of_a_group():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, 50)).astype(np.uint64) for _ in range(120)]
    root = N.linked_groups(sets, 85)
    for i in range(120):
        for j in range(i):
            k = len(np.intersect1d(sets[i], sets[j]))
            if 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                assert root[i] == root[j]


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(60)] + [(5, 5), (2, 1), (1, 2)]
    got = {x["node"]: x["component"] for x in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {}
    for a, b in links:
        least.setdefault(a, a), least.setdefault(b, b)
    for _ in range(200):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {k: v for k, v in least.items() if k != 5}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines_against_brute_force(spark):
    r, rows = random.Random(4), []
    for i in range(120):
        lines = [f"line {r.randrange(25)}" for _ in range(r.randrange(6))] + [" common line \t", "", f"own {i}"]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines), f"site{r.randrange(14)}"))
    rows += [(None, "common line\nx", "site1"), (500, None, "site2"), (501, "common line", None), (3, "common line\nother text", "site3"), (502, "\n\n", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("hits", F.lit("clash")).withColumn("site", F.lit(1))
    got = sorted(((x.doc_id, x.n_lines, x.n_removed, x.text) for x in L.remove_lines(df, 12).collect()), key=str)
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if x.strip():
                sites.setdefault(x.strip(), set()).add(s or "")
    want = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (x.strip() and len(sites[x.strip()]) >= 12)]
        want.append((d, sum(bool(x.strip()) for x in lines), len(lines) - len(keep), "\n".join(keep)))
    assert got == sorted(want, key=str)
    assert L.remove_lines(empty(spark)).count() == 0 and L.remove_lines(table(spark)).count() == len(texts())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, sf, name):
    from oracle import compare

    compare(spark, sf, QUERIES[name], ORACLES[name])


def star(n, far=0):
    """An original and copies with one word changed, each linked to it alone: J 0.90 to it, 0.81 to each other."""
    r, base = random.Random(9), words(70, 100)
    rows = [(10**6, " ".join(base))]
    for i in range(n):
        t = [*base]
        t[10 + r.randrange(80)] = f"s{i}"
        rows.append((i, " ".join(t)))
    return rows + [(2 * 10**6 + i, " ".join(words(3000 + i, 100))) for i in range(far)]


def test_near_on_a_large_star(spark):
    rows = star(700, 50)
    got = {r.doc_id: r.component_id for r in N.near_groups(table(spark, rows), N.Plan(node=256, group=256)).collect()}
    assert {d for d, c in got.items() if c == 0} == {d for d, _ in rows if d <= 10**6}
    assert all(c == d for d, c in got.items() if d > 10**6)


def test_near_in_a_node_that_stays_large(spark):
    plan = N.Plan(trees=1, depth=1, node=2, group=2)
    for seed in range(100):
        base = words(seed, 100)
        x, y, z = [*base], [*base], [*base]
        y[99] = x[30] = x[60] = y[30] = y[60] = "other"
        z[10] = z[80] = "own"
        rows = [(3, " ".join(x)), (2, " ".join(y)), (1, " ".join(z))]
        sk = np.array([N.sketch(s, plan.coordinates) for s in N.shingle_sets(N.pa.array([t for _, t in rows]))])
        if (sk[:, :2] == sk[0, :2]).all():
            break
    got = N.near_groups(table(spark, rows), plan).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows) and {r.component_id for r in got} == {1, 2}


@pytest.mark.parametrize("percent,trees,depth", [(85, 12, 2), (85, 12, 8), (85, 12, 10), (85, 12, 24), (80, 14, 8), (80, 14, 10), (80, 14, 24)])
def test_recall_of_threshold_pairs_by_depth(percent, trees, depth):
    """How many pairs at the threshold are together in some node at that depth, by the join's own choice of children."""
    plan, r, pairs = N.Plan(percent=percent, trees=trees), np.random.default_rng(depth), 400
    left = r.integers(0, 2**32, (pairs, plan.coordinates), dtype=np.uint32)
    right = np.where(r.random(left.shape) < percent / 100, left, left + np.uint32(1))
    found = 0
    for x, y in zip(left, right, strict=True):
        for t in range(plan.trees):
            nodes = np.array([t])
            for level in range(depth):
                both = [(c[ok], nodes[ok]) for c, chosen in N._children(t, level, nodes, plan) if (ok := chosen & (x[c] == y[c])).any()]
                nodes = np.unique(np.concatenate([N._name(n, c, x[c]) for c, n in both]))[:500] if both else np.zeros(0, np.int64)
                if not len(nodes):
                    break
            if len(nodes):
                found += 1
                break
    assert found >= 0.99 * pairs
