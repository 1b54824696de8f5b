"""Topics of documents for the mixture: spherical k-means over hashed word counts of all documents.

Each text becomes a short vector of signed word counts, of unit length, in whole numbers, so that sums and therefore
centroids do not depend on how rows are dealt. Centroids start from vectors far apart among those with the least keys and
are moved by a few passes over all vectors; only sums by topic and dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import U, slices, text_bytes, words_of

DIMS = 32
UNIT = 1000  # length of a vector


def counted(docs: DataFrame) -> DataFrame:
    """Replaces text, which comes first, by n_tokens (words [^\\x20\\x09-\\x0D]+) and vector (DIMS short integers)."""
    rest = docs.columns[1:]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for a, z in slices(x.column(0)):
                b = x.slice(a, z - a)
                hashes, _, _, at = words_of(*text_bytes(b.column(0)), lower=True)
                n = np.diff(at)
                place = np.repeat(np.arange(len(n)), n) * DIMS + (hashes >> U(59)).astype(np.int64)
                sums = np.bincount(place, np.where(hashes & U(1), 1.0, -1.0), len(n) * DIMS).reshape(-1, DIMS)
                size = np.sqrt((sums**2).sum(1, keepdims=True))
                vector = np.rint(UNIT * sums / np.maximum(size, 1e-9)).astype(np.int16)
                packed = pa.array([v.tobytes() for v in vector], pa.binary())
                yield pa.record_batch([*(b.column(i + 1) for i in range(len(rest))), pa.array(n, pa.int64()), packed], [*rest, "n_tokens", "vector"])

    return docs.mapInArrow(run, f"{kinds}, n_tokens long, vector binary")


def _nearest(raw: pa.Array, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(raw.to_pylist()), np.int16).reshape(-1, DIMS).astype(np.int64)
    return v, (v @ centres.T).argmax(1)


def _unit(sums: np.ndarray) -> np.ndarray:
    size = np.sqrt((sums.astype(float) ** 2).sum(1, keepdims=True))
    return np.rint(UNIT * sums / np.maximum(size, 1e-9)).astype(np.int64)


def fitted(rows: DataFrame, topics: int = 8, passes: int = 4, starts: int = 512) -> np.ndarray:
    """Centroids (topics, DIMS) over all rows (key, n_tokens, vector) with a word; fewer where there are fewer unlike rows."""
    full = rows.where("n_tokens > 0")
    first = [np.frombuffer(r["vector"], np.int16).astype(np.int64) for r in full.orderBy("key", "vector").limit(starts).select("vector").collect()]
    if not first:
        return np.zeros((1, DIMS), np.int64)
    pool = np.array(first)
    chosen = [pool[0]]
    while len(chosen) < topics:
        near = (pool @ np.array(chosen).T).max(1)
        if near.min() >= 0.999 * UNIT**2:
            break
        chosen.append(pool[near.argmin()])
    centres = np.array(chosen)
    for _ in range(passes):

        def sums(batches: Iterator[pa.RecordBatch], centres: np.ndarray = centres) -> Iterator[pa.RecordBatch]:
            total = np.zeros(centres.shape, np.int64)
            for b in batches:
                v, topic = _nearest(b.column(0), centres)
                np.add.at(total, topic, v)
            topic, dim = (x.ravel() for x in np.indices(total.shape))
            yield pa.record_batch({"topic": pa.array(topic, pa.int32()), "dim": pa.array(dim, pa.int32()), "v": pa.array(total.ravel(), pa.int64())})

        moved = np.zeros(centres.shape, np.int64)
        for r in full.select("vector").mapInArrow(sums, "topic int, dim int, v long").groupBy("topic", "dim").agg(F.sum("v").alias("v")).collect():
            moved[r["topic"], r["dim"]] = r["v"]
        empty = ~moved.any(1)
        new = np.where(empty[:, None], centres, _unit(moved))
        if (new == centres).all():
            break
        centres = new
    return centres


def named(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """rows with topic (topic0, topic1, ..) for vector; a row without words is of topic0."""
    rest = [c for c in rows.columns if c != "vector"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, topic = _nearest(b.column(len(rest)), centres)
            yield pa.record_batch([*(b.column(i) for i in range(len(rest))), pa.array([f"topic{t}" for t in topic], pa.string())], [*rest, "topic"])

    return rows.select(*rest, "vector").mapInArrow(run, f"{kinds}, topic string")
