"""Near duplicates by a chosen-path similarity join over sets of five-word shingles.

Equal sets are one set from the start. Each of several trees sends a set from a node to the children named by its minwise
tokens at one or two chosen coordinates, somewhat more than 1 / similarity of them on average: a pair at the threshold is
then expected in more than one child a level and survives to any depth with a fixed chance a tree, while unlike sets
part. Nodes too large for a task are split by a shuffle, level by level; smaller ones are split further inside a task, and
small nodes compare all their sketches. Pairs that pass a lenient sketch test form candidate groups, and a node that is
still large at the last level is one group as a whole. One law holds for groups of all sizes: every pair of their full
sets that could join two parts is compared. Where a group fits a task, that happens there; else its likeliest pairs are
confirmed first, then all sets that are still apart meet in blocks, a task for two blocks. Every link rests on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import done, rows_with, saved
from .textkernel import U, mix, shingle_sets


@dataclass(frozen=True)
class Plan:
    """Parameters of the join.

    trees, offspring: a pair at the threshold is expected in `offspring` children of its node. With p = 0.85 and 1.4
    coordinates a level it is lost by one tree, however deep, with probability 0.34 (branching process), by twelve with
    3e-6. The trees draw on one sketch, in which such a pair agrees on 0.85 +- 0.03 of the coordinates; over that spread
    about 1e-4 of pairs are lost at any depth (tests/llm has the recall by depth). A pair in a small node at level 1 is
    lost with 1e-12. coordinates: length of a sketch; agree: least number of equal coordinates of a candidate pair (a pair
    at 0.85 has fewer than 84 of 128 with probability 1e-8).
    depth: levels at most; a node that is large there is one candidate group as a whole.
    node: sets of one node inside one task; small: sets compared all with all.
    group, group_bytes: documents and bytes of text of a group that one task searches; two blocks hold as much.
    hubs: sets of a large group that all others meet; rounds: how often the likeliest pair of each of its parts is
    confirmed then. Both come before the blocks and only save work.
    """

    percent: int = 85
    size: int = 5
    trees: int = 12
    offspring: float = 1.19
    depth: int = 8
    coordinates: int = 128
    agree: int = 84
    node: int = 2048
    small: int = 48
    group: int = 4096
    group_bytes: int = 6_000_000
    rounds: int = 3
    hubs: int = 8


_SEED = np.random.default_rng(715)
_MULTIPLY = _SEED.integers(1, 2**63, 1024, dtype=U) * U(2) + U(1)
_ADD = _SEED.integers(1, 2**63, 1024, dtype=U)


def sketch(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Minwise tokens, 32 bits each."""
    low = np.full(coordinates, 2**32 - 1, np.uint32)
    a, b = _MULTIPLY[:coordinates], _ADD[:coordinates]
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            x = shingles[at : at + 512, None] * a
            x += b
            x >>= U(32)
            np.minimum(low, x.min(0).astype(np.uint32), out=low)
    return low


def sketches(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, n_shingles, s1 and s2 (128 bits that name the set), bytes, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, one, two, sk = [], [], [], []
            for s in shingle_sets(b.column(1), plan.size):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    one.append(mix(s).sum(dtype=U).view(np.int64))
                    two.append(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U).view(np.int64))
                sk.append(sketch(s, plan.coordinates).tobytes() if len(s) else None)
            yield pa.record_batch({"doc_id": b.column(0), "n_shingles": pa.array(n, pa.int64()), "s1": pa.array(one, pa.int64()), "s2": pa.array(two, pa.int64()), "bytes": b.column(2), "sketch": pa.array(sk, pa.binary())})

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text", "cast(coalesce(octet_length(text), 0) as bigint) bytes")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, bytes long, sketch binary")


def _children(tree: int, level: int, node: np.ndarray, plan: Plan) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chosen coordinates of nodes, and for which nodes: one for all, a second for as many as the offspring asks.

    Below the root they are drawn by the node's own hash, so that a pair which differs in one coordinate is not lost in
    all nodes of a level at once; the roots of different trees share none, as far as there are enough.
    """
    draw = [mix(node.view(U) ^ U((level * 7919 + tree) * 4 + k)) for k in range(3)]
    second = (draw[2] >> U(11)).astype(np.float64) / 2.0**53 < plan.offspring * 100 / plan.percent - 1
    if level == 0:
        return [(np.full(len(node), (2 * tree + k) % plan.coordinates), np.ones(len(node), bool) if k == 0 else second) for k in (0, 1)]
    one = (draw[0] % U(plan.coordinates)).astype(np.int64)
    two = (one + 1 + (draw[1] % U(plan.coordinates - 1)).astype(np.int64)) % plan.coordinates
    return [(one, np.ones(len(node), bool)), (two, second)]


def _name(node: np.ndarray, coordinate: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(node.view(U) * U(0x9E3779B97F4A7C15) + mix(token.astype(U) + (coordinate.astype(U) << U(40)))).view(np.int64)


def _branch(plan: Plan, level: int):
    """A task that gives each row (tree, node, id, sketch) its children at this level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees, nodes = b.column(0).to_numpy(), b.column(1).to_numpy()
            ids, raw = b.column(2).to_numpy(), b.column(3)
            sk = np.frombuffer(b"".join(raw.to_pylist()), np.uint32).reshape(len(ids), plan.coordinates)
            for t in np.unique(trees):
                here = np.flatnonzero(trees == t)
                for c, chosen in _children(int(t), level, nodes[here], plan):
                    rows, c = here[chosen], c[chosen]
                    if len(rows):
                        yield pa.record_batch({"tree": pa.array(trees[rows], pa.int32()), "node": pa.array(_name(nodes[rows], c, sk[rows, c]), pa.int64()), "id": pa.array(ids[rows], pa.int64()), "sketch": raw.take(pa.array(rows))})

    return run


def _plant(plan: Plan):
    """The first level of all trees: (tree, node, id) for each set, without its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            sk = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(ids), plan.coordinates)
            for t in range(plan.trees):
                root = np.full(len(ids), t, np.int64)
                for c, chosen in _children(t, 0, root, plan):
                    if chosen.any():
                        yield pa.record_batch({"tree": pa.array(np.full(chosen.sum(), t), pa.int32()), "node": pa.array(_name(root[chosen], c[chosen], sk[chosen, c[chosen]]), pa.int64()), "id": pa.array(ids[chosen], pa.int64())})

    return run


Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # both ids, and the number of equal coordinates


def _alike(i: np.ndarray, j: np.ndarray, ids: np.ndarray, sk: np.ndarray, plan: Plan) -> Found:
    same = (sk[i] == sk[j]).sum(1)
    ok = same >= plan.agree
    return ids[i[ok]], ids[j[ok]], same[ok]


def _descend(tree: int, level: int, node: int, ids: np.ndarray, sk: np.ndarray, plan: Plan) -> Iterator[Found]:
    """All candidate pairs below a node that a task holds."""
    stack = [(level, np.int64(node), np.arange(len(ids)))]
    while stack:
        lv, name, rows = stack.pop()
        if len(rows) <= plan.small:
            i, j = np.triu_indices(len(rows), 1)
            yield _alike(rows[i], rows[j], ids, sk, plan)
            continue
        if lv >= plan.depth:  # one group whole, in which no pair is left out later, and likely links between neighbours in order
            yield np.full(len(rows) - 1, ids[rows].min()), np.sort(ids[rows])[1:], np.zeros(len(rows) - 1, np.int64)
            line = rows[np.lexsort(sk[rows][:, ::-1].T[-8:])]
            for k in range(1, 9):
                yield _alike(line[:-k], line[k:], ids, sk, plan)
            continue
        for c, chosen in _children(tree, lv, np.array([name]), plan):
            if chosen[0]:
                order = rows[np.argsort(sk[rows, c[0]], kind="stable")]
                cuts = np.flatnonzero(np.diff(sk[order, c[0]])) + 1
                for part in np.split(order, cuts):
                    if len(part) > 1:
                        stack.append((lv + 1, _name(np.array([name]), c, sk[part[:1], c[0]])[0], part))


def forest(x: np.ndarray, y: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Places of pairs that join all that these pairs join, the likeliest first, one less than the ids of each joined part."""
    ids, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = place[: len(x)], place[len(x) :]
    order = np.lexsort((y, x, same))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    label, chosen = np.arange(len(ids)), np.zeros(len(rank), bool)
    while True:
        a, b = label[x], label[y]
        cross = np.flatnonzero(a != b)
        if not len(cross):
            return np.flatnonzero(chosen)
        best = np.full(len(ids), -1)
        np.maximum.at(best, a[cross], rank[cross])
        np.maximum.at(best, b[cross], rank[cross])
        new = order[np.unique(best[best >= 0])]
        chosen[new] = True
        a, b = label[x[new]], label[y[new]]
        low = np.arange(len(ids))
        while (low[a] != low[b]).any():  # least label along the new pairs
            least = np.minimum(low[a], low[b])
            np.minimum.at(low, a, least)
            np.minimum.at(low, b, least)
            low = low[low]
        label = low[label]


def _compare(plan: Plan, level: int):
    """A task over rows (tree, node, id, sketch) that lie together by node: of each node's candidate pairs a likeliest forest.

    A forest joins into one group what all pairs would, and groups are searched whole; so a node of copies of one text
    gives a pair a set and not all their pairs.
    """

    def nodes(batches):
        held = None
        for b in batches:
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            key = b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            done = int(cuts[-1]) if len(cuts) else 0
            if done:
                yield b.slice(0, done)
            held = b.slice(done)
        if held is not None and held.num_rows:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in nodes(batches):
            trees, key, ids = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()
            sk = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32).reshape(len(ids), plan.coordinates)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            size = np.diff(cuts)
            two = cuts[:-1][size == 2]
            found = [_alike(two, two + 1, ids, sk, plan)]
            for k in np.flatnonzero(size > 2):
                a, z = cuts[k], cuts[k + 1]
                below = [*_descend(int(trees[a]), level, int(key[a]), ids[a:z], sk[a:z], plan)]
                if not below:  # all parted
                    continue
                pairs = [np.concatenate([f[i] for f in below]) for i in range(3)]
                keep = forest(*pairs) if len(pairs[0]) > 1 else slice(None)
                found.append(tuple(p[keep] for p in pairs))
            x, y, same = (np.concatenate([f[i] for f in found]) for i in range(3))
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y), same], 1), axis=0)
            yield pa.record_batch({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64()), "same": pa.array(pairs[:, 2], pa.int64())})

    return run


def candidates(sets: DataFrame, plan: Plan) -> DataFrame:
    """Candidate pairs (a, b, same) of sets (id, sketch), each once; same is 0 where no sketches were compared."""
    level, found, read = 1, [], []
    rows = saved(sets.mapInArrow(_plant(plan), "tree int, node long, id long"), "near-nodes")
    while True:
        # written, so that the join's sides come straight from shuffles and a hot node's rows can be split
        sizes = saved(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "near-sizes")
        many = rows.join(sizes, "node")
        many = saved((many.join(sets, "id") if level == 1 else many).select("tree", "node", "id", "sketch", "n"), "near-shared")
        done(rows, sizes)
        read.append(many)
        fit = many.where(F.col("n") <= plan.node).select("tree", "node", "id", "sketch")
        found.append(fit.repartition("node").sortWithinPartitions("node", "id").mapInArrow(_compare(plan, level), "a long, b long, same long"))
        large = many.where(F.col("n") > plan.node).select("tree", "node", "id", "sketch")
        if not large.head(1):
            break
        if level >= plan.depth:  # as alike as that: one group whole, in which all_links leaves out no pair
            low = large.groupBy("node").agg(F.min("id").alias("a"))
            found.append(large.join(low, "node").where("id <> a").select("a", F.col("id").alias("b"), F.lit(0).cast("long").alias("same")))
            break
        rows = saved(large.mapInArrow(_branch(plan, level), "tree int, node long, id long, sketch binary"), "near-nodes")
        level += 1
    pairs = saved(reduce(DataFrame.unionByName, found).groupBy("a", "b").agg(F.max("same").alias("same")), "near-pairs")
    done(*read)
    return pairs


def linked_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of the first set that is reached over links, all sets compared through an inverted index."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    token, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(code, kind="stable")
    posted, start = owner[order], np.searchsorted(code[order], np.arange(len(token) + 1))
    at = np.concatenate([[0], np.cumsum(sizes)])
    root, left = np.full(n, -1), np.ones(n, bool)
    for first in range(n):
        if root[first] >= 0:
            continue
        queue, left[first], root[first] = [first], False, first
        while queue and left.any():
            u = queue.pop()
            mine = code[at[u] : at[u + 1]]
            shared = np.bincount(np.concatenate([posted[start[c] : start[c + 1]] for c in mine]), minlength=n)
            near = np.flatnonzero(left & (100 * shared >= percent * (sizes + sizes[u] - shared)))
            left[near], root[near] = False, first
            queue += near.tolist()
    return root


def _search(plan: Plan):
    """A task over rows (group, id, text) that lie together by group: (id, root)."""

    def answer(ids: list[int], texts: list[str]) -> pa.RecordBatch:
        order = np.argsort(np.array(ids), kind="stable")
        sets = list(shingle_sets(pa.array([texts[i] for i in order], pa.large_string()), plan.size))
        names = np.array(ids)[order]
        return pa.record_batch({"id": pa.array(names, pa.int64()), "root": pa.array(names[linked_groups(sets, plan.percent)], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, texts = None, [], []
        for b in batches:
            for g, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if g != group and ids:
                    yield answer(ids, texts)
                    ids, texts = [], []
                group = g
                ids.append(i)
                texts.append(t)
        if ids:
            yield answer(ids, texts)

    return run


def _confirm(plan: Plan):
    """A task over (a, b, text_a, text_b): the links among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [100 * (k := len(np.intersect1d(x, y, assume_unique=True))) >= plan.percent * (len(x) + len(y) - k) for x, y in zip(shingle_sets(b.column(2), plan.size), shingle_sets(b.column(3), plan.size), strict=True)]
            yield pa.record_batch([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def links_across(left: list[np.ndarray], right: list[np.ndarray], parts: np.ndarray, others: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (index in left, index in right) that join all parts which some link joins; parts, others: what is joined already."""
    sizes = np.array([len(s) for s in right])
    token, code = np.unique(np.concatenate(right), return_inverse=True)
    posted = np.repeat(np.arange(len(right)), sizes)[np.argsort(code, kind="stable")]
    start = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(token)))])
    _, label = np.unique(np.concatenate([parts, others]), return_inverse=True)
    mine, theirs = label[: len(left)], label[len(left) :]
    out = []
    for u, s in enumerate(left):
        if (theirs == mine[u]).all():
            continue
        at = np.minimum(np.searchsorted(token, s), len(token) - 1)
        at = at[token[at] == s]
        if not len(at):
            continue
        shared = np.bincount(np.concatenate([posted[start[c] : start[c + 1]] for c in at]), minlength=len(right))
        near = np.flatnonzero((theirs != mine[u]) & (100 * shared >= percent * (sizes + len(s) - shared)))
        for v in near:
            if theirs[v] != mine[u]:
                out.append((u, int(v)))
                label[label == theirs[v]] = mine[u]
    return out


def _across(plan: Plan):
    """A task over rows (job, side, id, part, text) that lie together by job: links (a, b) of two blocks, or within one."""

    def answer(sides: list[int], ids: list[int], parts: list[int], texts: list[str]) -> pa.RecordBatch:
        sets = list(shingle_sets(pa.array(texts, pa.large_string()), plan.size))
        ids, parts = np.array(ids), np.array(parts)
        here = [np.flatnonzero(np.array(sides) == k) for k in (0, 1)]
        x, y = here[0], here[1] if len(here[1]) else here[0]
        got = links_across([sets[i] for i in x], [sets[i] for i in y], parts[x], parts[y], plan.percent) if len(x) else []
        return pa.record_batch({"a": pa.array([ids[x[u]] for u, _ in got], pa.int64()), "b": pa.array([ids[y[v]] for _, v in got], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, held = None, ([], [], [], [])
        for b in batches:
            for j, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if j != job and held[0]:
                    yield answer(*held)
                    held = ([], [], [], [])
                job = j
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        if held[0]:
            yield answer(*held)

    return run


def _joined(texts: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component, n_shingles, bytes, part): what links join within the groups of texts."""
    part = components(links).select("node", F.col("component").alias("part"))
    return saved(texts.select("node", "component", "n_shingles", "bytes").join(part, "node", "left").withColumn("part", F.coalesce("part", "node")), "near-parts")


def _open(state: DataFrame) -> DataFrame:
    """state's groups of several parts, each row with `main`: whether it is of the group's largest part."""
    parts = saved(state.groupBy("component", "part").agg(F.count("*").alias("n")), "near-sizes")
    groups = parts.groupBy("component").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.count("*").alias("k")).where("k > 1")
    return saved(state.join(groups, "component").withColumn("main", F.col("part") == F.col("largest")).drop("largest", "k"), "near-open")


def _likeliest(pairs: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of pairs between two parts the likeliest of each part, at most one a part; and the other such pairs."""
    at = lambda n: state.select(F.col("node").alias(n), F.col("part").alias("p" + n))
    apart = saved(pairs.select("a", "b", "same").join(at("a"), "a").join(at("b"), "b").where("pa <> pb").select("a", "b", "same", "pa", "pb"), "near-apart")
    each = apart.select(F.explode(F.array("pa", "pb")).alias("part"), F.struct("same", "a", "b").alias("pair"))
    best = saved(each.groupBy("part").agg(F.max("pair").alias("pair")).select("pair.a", "pair.b").distinct(), "near-best")
    rest = saved(apart.join(best, ["a", "b"], "left_anti").select("a", "b", "same"), "near-rest")
    done(apart)
    return best, rest


def _met(rows: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) found by jobs over rows (job, side, node, part); a text goes once to each job that asks for it."""
    asked = rows.join(texts.select("node", "text"), "node").select("job", "side", F.col("node").alias("id"), "part", "text")
    return saved(asked.repartition("job").sortWithinPartitions("job").mapInArrow(_across(plan), "a long, b long"), "near-links")


def _blocked(rows: DataFrame, keys: list[str], plan: Plan) -> tuple[DataFrame, DataFrame]:
    """rows with `block`, dealt by hash so that two blocks of the same keys fit a task; and the number of blocks by keys."""
    most = F.greatest(F.ceil(2 * F.count("*") / plan.group), F.ceil(2 * F.sum("bytes") / plan.group_bytes), F.lit(1)).cast("int")
    cells = saved(rows.groupBy(*keys).agg(most.alias("blocks")), "near-cells")
    return rows.join(cells, keys).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("blocks"), cells


def all_links(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) that join what any links join within groups too large for a task.

    texts: node, component (its group), text, n_shingles, bytes. First all sets of a group meet a few with many candidates.
    Where parts stay apart, the likeliest candidate pair of each part is confirmed, in a few rounds, so that the texts sent
    are a few for each set whatever the number of pairs. Then each set outside the group's largest part meets all of the
    group that are near in size, block by block, so that no pair of sets which could still join two parts is left out.
    """
    links: list[DataFrame] = []

    def apart() -> DataFrame | None:
        state = _joined(texts, reduce(DataFrame.unionByName, links))
        out = _open(state)
        done(state)
        return out if out.head(1) else None

    rest = saved(pairs.where("same > 0").select("a", "b", "same"), "near-rest")
    degree = rest.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    slot = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(plan.hubs)).alias("slot")
    hubs = texts.select("node", "component").join(degree, "node", "left").groupBy("component", slot).agg(F.max_by("node", F.struct(F.coalesce("links", F.lit(0)), "node")).alias("node"))
    hubs = saved(hubs, "near-hubs")
    rows, cells = _blocked(texts.select("node", "component", "bytes"), ["component"], plan)
    job = F.concat_ws(" ", "component", "block").alias("job")
    centre = hubs.join(cells, "component").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = rows.select(job, F.lit(1).alias("side"), "node", F.col("node").alias("part")).unionByName(centre.select(job, F.lit(0).alias("side"), "node", F.col("node").alias("part")))
    links.append(_met(asked, texts, plan))
    done(hubs, cells)
    side = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias("t" + n))
    for _ in range(plan.rounds):
        if (left := apart()) is None:
            return reduce(DataFrame.unionByName, links)
        best, more = _likeliest(rest, left)
        done(rest, left)
        rest = more
        if not best.head(1):
            break
        both = best.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
        links.append(saved(both.mapInArrow(_confirm(plan), "a long, b long"), "near-links"))
        done(best)
    if (left := apart()) is None:
        return reduce(DataFrame.unionByName, links)
    # sets whose sizes are two steps apart are not linked; the base is a percent wider, so that rounding loses none
    step = F.floor(F.log("n_shingles") / float(np.log(100 / (plan.percent - 1)))).cast("int")
    rows, cells = _blocked(left.withColumn("step", step), ["component", "step", "main"], plan)
    blocks = cells.select("component", "step", "main", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    x = blocks.where("not main").select("component", F.col("step").alias("x_step"), F.col("block").alias("x_block"))
    y = blocks.select("component", F.col("step").alias("y_step"), F.col("block").alias("y_block"), "main")
    order = F.struct("x_step", "x_block") <= F.struct("y_step", "y_block")
    jobs = x.join(y, "component").where((F.abs(F.col("x_step") - F.col("y_step")) <= 1) & (F.col("main") | order))
    jobs = saved(jobs.withColumn("job", F.concat_ws(" ", "component", "x_step", "x_block", "y_step", "y_block", F.col("main").cast("string"))), "near-jobs")
    itself = ~F.col("main") & (F.col("x_step") == F.col("y_step")) & (F.col("x_block") == F.col("y_block"))
    one = jobs.select("component", F.col("x_step").alias("step"), F.lit(False).alias("main"), F.col("x_block").alias("block"), "job", F.lit(0).alias("side"))
    two = jobs.where(~itself).select("component", F.col("y_step").alias("step"), "main", F.col("y_block").alias("block"), "job", F.lit(1).alias("side"))
    asked = rows.join(one.unionByName(two), ["component", "step", "main", "block"]).select("job", "side", "node", "part")
    links.append(_met(asked, texts, plan))
    done(left, cells, jobs)
    return reduce(DataFrame.unionByName, links)


def near_groups(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    A document's set holds its distinct five-word shingles, A-Z as a-z; with fewer words the whole sequence is one; with
    none (also where the text is null) the set is empty and the row stands alone. Sets with 100 * shared >= 85 * united
    are linked, and the smallest doc_id that links reach is component_id. Rows that repeat a doc_id share a row's fate
    where their text is the same; with different texts each has its own links. A null doc_id is linked with nothing.
    Texts of any length count whole. An empty table gives an empty result; other columns are ignored.
    """
    plan = plan or Plan()
    rows = saved(sketches(docs, plan), "near-sketches")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    name = F.struct("s1", "s2", "n_shingles")
    shared = full.groupBy("doc_id").agg(F.min(name).alias("one"), F.max(name).alias("other")).where("one <> other")
    if shared.head(1):
        done(rows)
        return _by_text(docs, plan)
    classes = full.groupBy("s1", "s2", "n_shingles").agg(F.min_by(F.struct("doc_id", "sketch", "bytes"), "doc_id").alias("of"))
    sets = saved(classes.select("s1", "s2", "n_shingles", F.col("of.doc_id").alias("id"), F.col("of.sketch").alias("sketch"), F.col("of.bytes").alias("bytes")), "near-sets")
    pairs = candidates(sets.select("id", "sketch"), plan)
    groups = saved(components(pairs), "near-groups")
    of_node = sets.select(F.col("id").alias("node"), "n_shingles", "bytes")
    sized = groups.join(of_node, "node").groupBy("component").agg(F.count("*").alias("n"), F.sum("bytes").alias("total"))
    fits = (F.col("n") <= plan.group) & (F.col("total") <= plan.group_bytes)
    member = saved(groups.join(sized.select("component", fits.alias("fits")), "component"), "near-members")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    texts = saved(texts.join(member, "node").groupBy("node", "component", "fits").agg(F.max("text").alias("text")), "near-texts")
    inside = texts.where("fits").select("component", "node", "text").repartition("component").sortWithinPartitions("component", "node").mapInArrow(_search(plan), "id long, root long")
    links = inside.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    beyond = member.where("not fits")
    if beyond.head(1):
        large = texts.where("not fits").join(of_node, "node").select("node", "component", "text", "n_shingles", "bytes")
        found = all_links(pairs.join(beyond.select(F.col("node").alias("a")), "a", "left_semi"), large, plan)
        links = links.unionByName(components(found).select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b"))
    root = links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    named = sets.select("s1", "s2", "n_shingles", "id").join(root, "id", "left").select("s1", "s2", "n_shingles", F.coalesce("root", "id").alias("component_id"))
    named = saved(named, "near-named")
    done(sets, pairs, groups, member, texts)
    out = rows.drop("sketch", "bytes").join(named, ["s1", "s2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _by_text(docs: DataFrame, plan: Plan) -> DataFrame:
    """near_groups() where different texts go by one doc_id: rows are named by doc_id and text, and groups by their least doc_id."""
    doc_id = F.col("doc_id").cast("long")
    key = F.when(doc_id.isNotNull(), F.xxhash64(doc_id, F.coalesce("text", F.lit(""))))
    keyed = saved(docs.select(key.alias("doc_id"), doc_id.alias("own"), "text"), "near-keyed")
    groups = saved(near_groups(keyed, plan), "near-keyed-groups")
    own = keyed.where("own is not null").groupBy(F.col("doc_id").alias("key")).agg(F.min("own").alias("own"))
    named = saved(groups.join(own, groups["doc_id"] == own["key"], "left").select("own", "n_shingles", F.col("component_id").alias("root")), "near-own")
    least = named.groupBy("root").agg(F.min("own").alias("component_id"))
    out = named.alias("x").join(least.alias("y"), F.col("x.root") == F.col("y.root"), "left").select(F.col("x.own").alias("doc_id"), "x.n_shingles", "y.component_id")
    done(keyed, groups)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """The rows of docs of which one a group stays, whole, with all their columns, whatever these are called.

    Groups are those of near_groups(). Rows with an empty or null text or a null doc_id stay, rows that repeat a kept
    doc_id all stay, an empty table gives an empty result.
    """
    return rows_with(docs, near_groups(docs, plan).where("kept").select("doc_id").distinct())
