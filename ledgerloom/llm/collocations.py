"""Phrase collocations by multikey three-way quicksort of suffix pointers, after a global routing by leading words.

A suffix is what stands in a piece from one word on, up to five words. Routing is the outermost level of the sort, done by
shuffles: occurrences are counted by leading word, then by leading pair, and what is infrequent is abandoned, as a phrase is
no more frequent than any part of it. The suffixes that are left go by their leading words to tasks, each of which sorts
its own by the next word, and the next, three ways at a time: an equal partition's size is the count of a phrase. A pair
that leads too many suffixes for one task is routed by three words, or four, as far as that goes; with five, partitions
are whole counts. Equal suffixes are summed in tasks before they move.

Frequent words and pairs are known to tasks as a Bloom filter of fixed size: a false hit only lets an infrequent suffix
through, which the sort abandons, so counts are exact whatever its load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import done, saved
from .textkernel import U, mix, slices, span_hashes

DEPTH = 5
NONE = "und"
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
#: bytes of text in one go; a longer text is cut between pieces
CHUNK = 1 << 21
#: suffixes that a task sums before it hands them on
HELD = 1 << 19
#: suffixes that a task sorts at a time, and of which it makes the texts at a time
SORTED, SPELT = 1 << 17, 1 << 16
_NEXT = U(0x9E3779B97F4A7C15)


# --- words of a chunk ---


@dataclass
class Chunk:
    """Words of some text of one language: distinct ones with their hashes, and by position their codes and pieces."""

    words: pa.Array
    hashes: np.ndarray
    codes: np.ndarray
    piece: np.ndarray

    def phrases(self, at: np.ndarray, size: np.ndarray) -> pa.Array:
        """Words from each position on, with a space between; on the way a byte takes several numbers, so some at a time."""
        lens = np.diff(np.frombuffer(self.words.buffers()[1], np.int64)[: len(self.words) + 1])
        spaced = np.frombuffer(b" ".join([*(x.as_buffer().to_pybytes() for x in self.words.cast(pa.large_binary())), b""]), np.uint8)
        begin = np.concatenate([[0], np.cumsum(lens + 1)])
        n = lens[self.codes] + 1
        parts = [self._spelt(at[i : i + SPELT], size[i : i + SPELT], n, spaced, begin) for i in range(0, max(len(at), 1), SPELT)]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    def _spelt(self, at: np.ndarray, size: np.ndarray, n: np.ndarray, spaced: np.ndarray, begin: np.ndarray) -> pa.Array:
        most, out = int(size.max(initial=0)), []
        for k in range(most):  # word by word, so that a phrase is made of its own words only
            out.append(np.where(size > k, n[np.minimum(at + k, len(n) - 1)], 0))
        width = np.stack(out, 1) if out else np.zeros((len(at), 0), np.int64)
        source = np.stack([begin[self.codes[np.minimum(at + k, len(n) - 1)]] for k in range(most)], 1) if out else width
        flat, ends = width.ravel(), np.cumsum(width.ravel())
        index = np.repeat(source.ravel() - (ends - flat), flat) + np.arange(ends[-1] if len(ends) else 0)
        total = width.sum(1)
        stop = np.cumsum(total)
        keep = np.ones(len(index), bool)
        keep[stop[total > 0] - 1] = False  # the space after the last word
        data = spaced[index][keep]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.concatenate([[0], np.cumsum(np.maximum(total - 1, 0))]).astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _hash_of(words: pa.Array, lang: str) -> np.ndarray:
    """64 bits a word, by its language; words is a large_string array from offset 0."""
    _, offsets, data = words.buffers()
    offs = np.frombuffer(offsets, np.int64)[: len(words) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    name = np.frombuffer(lang.encode(), np.uint8)
    with np.errstate(over="ignore"):
        return mix(span_hashes(raw, offs[:-1], offs[1:]) + span_hashes(name, np.array([0]), np.array([len(name)]))[0])


def _chunks(raw: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while at < len(raw):
        to = min(at + CHUNK, len(raw))
        if to < len(raw):
            cuts = np.flatnonzero(_KIND[raw[at:to]] == 2)
            if len(cuts):
                to = at + int(cuts[-1]) + 1
            else:  # a piece longer than a chunk
                later = np.flatnonzero(_KIND[raw[to:]] == 2)
                to = to + int(later[0]) + 1 if len(later) else len(raw)
        yield raw[at:to]
        at = to


def chunks_of(batch: pa.RecordBatch) -> Iterator[tuple[str, Chunk]]:
    """Chunks of a batch of (lang, text), language by language."""
    for a, z in slices(batch.column(1), CHUNK):
        langs, texts = batch.column(0).slice(a, z - a).to_pylist(), batch.column(1).slice(a, z - a).to_pylist()
        for lang in sorted(set(langs)):
            joined = "\n".join([t for g, t in zip(langs, texts, strict=True) if g == lang and t])
            for raw in _chunks(np.frombuffer(joined.encode(), np.uint8)):
                kind = _KIND[raw]
                solid = kind == 0
                edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                if not len(starts):
                    continue
                offs = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
                coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offs), pa.py_buffer(_SMALL[raw][solid])).dictionary_encode()
                yield lang, Chunk(coded.dictionary, _hash_of(coded.dictionary, lang), coded.indices.to_numpy().astype(np.int64), np.cumsum(kind == 2)[starts])


# --- a Bloom filter of phrases ---


@dataclass
class Bloom:
    """Blocked filter: a phrase has three bits of one 64-bit word."""

    bits: np.ndarray

    @staticmethod
    def place(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        one = U(1)
        return (h >> U(20)) % U(size), (one << (h & U(63))) | (one << ((h >> U(6)) & U(63))) | (one << ((h >> U(12)) & U(63)))

    def has(self, h: np.ndarray) -> np.ndarray:
        block, bits = self.place(h, len(self.bits))
        return self.bits[block.astype(np.int64)] & bits == bits


def _then(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    with np.errstate(over="ignore"):
        return mix(before * _NEXT + word)


def bloom(phrases: DataFrame, size: int) -> Bloom:
    """Filter of size 64-bit words over (lang, phrase); that many rows at most come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _phrase_hashes(b.column(0).to_pylist(), b.column(1).to_pylist())
            block, bits = Bloom.place(h, size)
            yield pa.record_batch({"block": pa.array(block.astype(np.int64)), "bits": pa.array(bits.view(np.int64))})

    rows = phrases.select("lang", "phrase").mapInArrow(run, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size, U)
    out[rows["block"].to_numpy()] = rows["bits"].to_numpy().view(U)
    return Bloom(out)


def _phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    split = [p.split(" ") for p in phrases]
    coded = pa.array([w for s in split for w in s], pa.large_string())
    where = np.repeat(np.arange(len(split)), [len(s) for s in split])
    flat = np.zeros(len(coded), U)
    names = np.array(langs, object)[where] if len(langs) else np.zeros(0, object)
    for lang in set(langs):
        mine = np.flatnonzero(names == lang)
        part = coded.take(pa.array(mine))
        flat[mine] = _hash_of(pa.concat_arrays([part]), lang)
    first = np.concatenate([[0], np.cumsum([len(s) for s in split])])[:-1].astype(np.int64)
    size = np.array([len(s) for s in split], np.int64)
    h = flat[first] if len(first) else flat
    for k in range(1, int(size.max(initial=1))):
        more = size > k
        h = np.where(more, _then(h, flat[np.where(more, first + k, 0)]), h)
    return h


# --- counting by routes ---


@dataclass
class Routing:
    """What tasks know: filters of frequent words and pairs, and hashes of leads (2, 3, 4 words) that are routed deeper."""

    words: Bloom
    pairs: Bloom | None = None
    hot: list[np.ndarray] = field(default_factory=list)

    def suffixes(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For each position its length in words whose neighbours are frequent, its depth of routing, and lead hashes."""
        n = len(c.codes)
        word = c.hashes[c.codes]
        known = self.words.has(c.hashes)[c.codes]
        follow = np.zeros(n, bool)
        follow[:-1] = known[:-1] & known[1:] & (c.piece[:-1] == c.piece[1:])
        leads = [word]
        shift = lambda x, k: np.concatenate([x[k:], np.zeros(min(k, n), x.dtype)])
        leads.append(_then(word, shift(word, 1)))
        if self.pairs is not None:
            follow &= self.pairs.has(leads[1])
        length, run = np.ones(n, np.int64), np.ones(n, bool)
        for k in range(1, DEPTH):
            run = run & shift(follow, k - 1)
            length += run
        for k in range(2, DEPTH):
            leads.append(_then(leads[-1], shift(word, k)))
        depth, deeper = np.full(n, 2), np.ones(n, bool)
        for k, hot in enumerate(self.hot):  # leads of k + 2 words
            deeper &= np.isin(leads[k + 1], hot)
            depth += deeper
        return length, depth, leads


def _rows(lang: str, c: Chunk, at: np.ndarray, size: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of distinct phrases and how often each occurs; key is a hash, held against the words themselves."""
    _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    like = at[first][inverse]
    same = size[first][inverse] == size
    last = len(c.codes) - 1
    for k in range(int(size.max(initial=0))):
        same &= (size <= k) | (c.codes[np.minimum(at + k, last)] == c.codes[np.minimum(like + k, last)])
    if same.all():
        return first, count
    own = np.flatnonzero(~same)  # another phrase under the same hash goes by itself
    clean = np.bincount(inverse[same], minlength=len(first))
    return np.concatenate([first, own]), np.concatenate([clean, np.ones(len(own), np.int64)])


class _Sums:
    """Rows summed before they leave a task, while they are few enough to hold."""

    def __init__(self, keys: list[str]):
        self.keys, self.parts, self.n = keys, [], 0

    def add(self, t: pa.Table) -> Iterator[pa.RecordBatch]:
        self.parts.append(t)
        self.n += t.num_rows
        if self.n > HELD:
            yield from self.flush(HELD // 2)

    def flush(self, room: int = 0) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        t = pa.concat_tables(self.parts).group_by(self.keys).aggregate([("n", "sum")]).rename_columns([*self.keys, "n"])
        if t.num_rows > room:
            yield from t.combine_chunks().to_batches(1 << 16)
            self.parts, self.n = [], 0
        else:
            self.parts, self.n = [t], t.num_rows


def _each_chunk(docs: DataFrame, make: Callable[[str, Chunk], dict | None], schema: str, keys: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(keys)
        for b in batches:
            for lang, c in chunks_of(b):
                out = make(lang, c)
                if out is not None:
                    yield from sums.add(pa.table({"lang": pa.array([lang] * len(out["n"]), pa.string())} | out))
        yield from sums.flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), "text").mapInArrow(run, schema)


def _word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, n of each word; the row with a null phrase has the count of all."""

    def make(lang: str, c: Chunk) -> dict:
        n = np.bincount(c.codes, minlength=len(c.words))
        return {"phrase": pa.concat_arrays([c.words.cast(pa.string()), pa.nulls(1, pa.string())]), "n": pa.array(np.append(n, len(c.codes)))}

    return _each_chunk(docs, make, "lang string, phrase string, n long", ["lang", "phrase"]).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _lead_counts(docs: DataFrame, routing, words: int) -> DataFrame:
    """lang, phrase, n of leads of so many words, of those whose shorter leads are all routed deeper."""

    def make(lang: str, c: Chunk) -> dict | None:
        r = routing.value
        length, depth, leads = r.suffixes(c)
        at = np.flatnonzero((length >= words) & (depth >= words))
        if not len(at):
            return None
        size = np.full(len(at), words)
        first, n = _rows(lang, c, at, size, leads[words - 1][at])
        return {"phrase": c.phrases(at[first], size[first]), "n": pa.array(n.astype(np.int64))}

    return _each_chunk(docs, make, "lang string, phrase string, n long", ["lang", "phrase"]).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _suffixes(docs: DataFrame, routing) -> DataFrame:
    """lang, phrase, depth, n: distinct suffixes of a task that go further than their route of `depth` words."""

    def make(lang: str, c: Chunk) -> dict | None:
        length, depth, leads = routing.value.suffixes(c)
        at = np.flatnonzero(length > depth)
        if not len(at):
            return None
        size = length[at]
        first, n = _rows(lang, c, at, size, np.stack(leads)[size - 1, at])
        return {"phrase": c.phrases(at[first], size[first]), "depth": pa.array(depth[at][first].astype(np.int32)), "n": pa.array(n.astype(np.int64))}

    return _each_chunk(docs, make, "lang string, phrase string, depth int, n long", ["lang", "phrase", "depth"])


# --- the sort ---


def quicksort(words: np.ndarray, weight: np.ndarray, group: np.ndarray, depth: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to rows of `words` (codes, -1 behind the end): pointer, words, count.

    group is sorted and parts the pointers to begin with; depth is the column that each starts at. All partitions of a
    round are split at once, each by a pivot of its own into smaller, equal and greater ones. An equal partition goes on
    with the next word, and its size is the count of the phrase up to this one; partitions of less than `least` are
    abandoned. Each phrase is given with a pointer to one of its suffixes.
    """
    at = np.arange(len(words))
    part, col = group, depth[np.concatenate([[True], group[1:] != group[:-1]])] if len(group) else depth
    part = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if len(group) else group
    while len(at):
        key = words[at, col[part]]
        inside = key >= 0  # a suffix that ends here is in no longer phrase
        at, part, key = at[inside], part[inside], key[inside]
        if not len(at):
            return
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(starts[1:], len(at))
        ordinal = np.repeat(np.arange(len(starts)), ends - starts)
        col = col[part[starts]]
        a, b, c = key[starts], key[(starts + ends) // 2], key[ends - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[ordinal]
        label = ordinal * 3 + 1 + (key > pivot) - (key < pivot)
        order = np.argsort(label, kind="stable")
        at, label = at[order], label[order]
        starts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        size = np.add.reduceat(weight[at], starts)
        equal, enough = label[starts] % 3 == 1, size >= least
        col = col[label[starts] // 3] + equal
        found = equal & enough
        yield at[starts[found]], col[found], size[found]
        go_on = enough & (col < words.shape[1])
        spread = np.repeat(go_on, np.diff(np.append(starts, len(at))))
        number = np.cumsum(go_on) - 1
        part = np.repeat(number, np.diff(np.append(starts, len(at))))[spread]
        at, col = at[spread], col[go_on]


def _matrix(phrases: pa.Array) -> np.ndarray:
    """Codes of the words of each phrase, -1 behind the end."""
    split = pc.split_pattern(phrases.cast(pa.large_string()), " ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = split.flatten().dictionary_encode().indices.to_numpy()
    out = np.full((len(split), DEPTH), -1, np.int64)
    row = np.repeat(np.arange(len(split)), sizes)
    out[row, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = codes
    return out


def _sorted_counts(suffixes: DataFrame, least: int) -> DataFrame:
    """Counts of the phrases that go further than a route: suffixes meet by route, and a task sorts route by route."""
    route = F.expr("substring_index(phrase, ' ', depth)")

    def sort(t: pa.Table, routes: np.ndarray) -> pa.RecordBatch:
        phrases = t["phrase"].combine_chunks()  # in columns: only those that are found become objects
        found = list(quicksort(_matrix(phrases), t["n"].to_numpy(), routes, t["depth"].to_numpy().astype(np.int64), least))
        at, size, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        text = [" ".join(p.split(" ")[:k]) for p, k in zip(phrases.take(pa.array(at)).to_pylist(), size.tolist(), strict=True)]
        return pa.record_batch({"lang": t["lang"].combine_chunks().take(pa.array(at)), "phrase": pa.array(text, pa.string()), "n": pa.array(n.astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n > SORTED:
                t = pa.Table.from_batches(held)
                routes = _runs(t)
                cut = int(np.searchsorted(routes, routes[-1]))  # the last route may go on
                if cut:
                    yield sort(t.slice(0, cut), routes[:cut])
                t = t.slice(cut)
                held, n = t.to_batches(), 0  # counted anew, so that a long route is looked at once in so many rows
        if held:
            t = pa.Table.from_batches(held)
            if t.num_rows:
                yield sort(t, _runs(t))

    dealt = suffixes.withColumn("route", route).repartition("lang", "route").sortWithinPartitions("lang", "route")
    return dealt.mapInArrow(run, "lang string, phrase string, n long")


def _runs(t: pa.Table) -> np.ndarray:
    """The number of each row's route, where rows of a route follow one another."""
    pairs = pa.table({"lang": t["lang"], "route": t["route"]})
    change = np.zeros(t.num_rows, np.int64)
    for name in ("lang", "route"):
        codes = pairs[name].combine_chunks().dictionary_encode()
        codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(change)


def counts(docs: DataFrame, least: int = 100, filter_words: int = 1 << 20, crowd: int = 1 << 12) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to five words with f >= least, and (lang, n) with all words.

    A lead of more than `crowd` suffixes, and of more than a quarter of a shuffle partition's share, is routed deeper; so
    there are at most four such leads a partition, and their hashes are sent to tasks.
    """
    spark: SparkSession = docs.sparkSession
    words = saved(_word_counts(docs).where(F.col("phrase").isNull() | (F.col("n") >= least)), "phrases-words")
    totals, single = words.where("phrase is null").select("lang", "n"), words.where("phrase is not null")
    routing = Routing(bloom(single, filter_words))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels, k = [single], 2
    while k <= DEPTH:
        lead = saved(_lead_counts(docs, _shared(spark, routing), k).where(F.col("n") >= least), f"phrases-{k}")
        levels.append(lead)
        if k == 2:
            routing = Routing(routing.words, bloom(lead, filter_words))
            total = lead.agg(F.sum("n")).first()[0] or 0
        hot = lead.where(F.col("n") > max(crowd, total // (4 * parts))).select("lang", "phrase").toArrow() if k < DEPTH else []
        if not len(hot):
            break
        routing = Routing(routing.words, routing.pairs, [*routing.hot, np.unique(_phrase_hashes(hot["lang"].to_pylist(), hot["phrase"].to_pylist()))])
        k += 1
    levels.append(saved(_sorted_counts(_suffixes(docs, _shared(spark, routing)), least), "phrases-sorted"))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), F.col("n").alias("f")), totals


def _shared(spark: SparkSession, routing: Routing):
    return spark.sparkContext.broadcast(routing)


def scored(f: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each phrase of two words or more, by its lowest-scoring cut, the first of equal ones."""
    cut = f.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.col("words").alias("k"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', cut)")).withColumn("rest", F.expr("substring_index(phrase, ' ', cut - k)"))
    part = lambda to, n: f.select("lang", F.col("phrase").alias(to), F.col("f").alias(n))
    rows = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: c.cast("decimal(19,0)")
    rows = rows.withColumn("_up", wide(F.col("a") * 1000) * wide(F.col("n"))).withColumn("_down", wide(F.col("l")) * wide(F.col("r")))
    best = rows.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("_up div _down").cast("long").alias("score"), "cut", "l", "r", "a", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def covered(f: DataFrame, percent: int) -> DataFrame:
    """lang, phrase of those inside a longer phrase that is at least so many hundredths as frequent."""
    longer = f.where("words > 2").select("lang", F.split("phrase", " ").alias("w"), "words", "f")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))
    most = longer.select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_most"))
    return f.where("words > 1").join(most, ["lang", "phrase"]).where(F.col("_most") * 100 >= F.col("f") * percent).select("lang", "phrase")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language, in two steps, so that no language has to fit a task."""
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = rows.withColumn("_lot", F.pmod(F.xxhash64("phrase"), F.lit(256))).withColumn("_r", F.row_number().over(W.partitionBy("lang", "_lot").orderBy(*order))).where(F.col("_r") <= top)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("_lot", "_r")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, percent: int = 100, **kinds) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of two to five words that stand out most, by language.

    A-Z count as a-z; pieces end at .,;:!? and line ends, words at spaces and tabs. A null text is empty, a null lang is
    `und`; other columns and doc_ids are ignored, and repeated rows count as often as they are there. Score is 1000 times
    the count of a phrase against what its parts would give by chance. Phrases inside a longer one that is (percent) as
    frequent are left out. An empty table has no phrases. Whole texts of any length are read, a few megabytes, or one
    piece, at a time.
    """
    f, totals = counts(docs, least, **kinds)
    f = saved(f, "phrases")
    rows = saved(scored(f, totals).join(covered(f, percent), ["lang", "phrase"], "left_anti"), "phrases-scored")
    out = _ranked(rows, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    done(f)
    return out
