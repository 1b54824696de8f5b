"""Mixing by iterative proportional fitting: token weights raked to source, language and topic marginals, then sampling.

Documents are summed to cells (source, language, topic), of which there are no more than the axes name, whatever the
input; fitting works on that table, and each document is kept with its cell's calibrated probability by a hash. A cell
gives no more than its tokens, so raking is bounded: weights are min(all tokens of the cell, product of one factor an
axis), and the factors of one axis after the other are set so that its marginal is met.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import done, saved
from .topics import counted, fitted, named

REST = "(rest)"
AXES = ("source", "lang", "topic")
Targets = Mapping[str, Mapping[str, float]]


@dataclass
class Mixture:
    """rows: a row a document; share: expected share of all tokens; report: axis, value, wanted, attained (expected token shares)."""

    rows: DataFrame
    share: float
    report: DataFrame


def tempered(tokens: np.ndarray, power: float) -> np.ndarray:
    """Shares in proportion to a power of the tokens: below 1, large values lose to small ones."""
    x = np.where(tokens > 0, np.maximum(tokens, 1e-300) ** power, 0.0)
    return x / x.sum() if x.sum() else x


def _margin(x: np.ndarray, axis: int) -> np.ndarray:
    return x.sum(tuple(i for i in range(x.ndim) if i != axis))


def aims(tokens: np.ndarray, targets: list[np.ndarray]) -> list[np.ndarray]:
    """Shares that add up to 1 an axis; a value without tokens gives its share to the others of its axis."""
    out = []
    for axis, want in enumerate(targets):
        there = _margin(tokens, axis) > 0
        aim = np.where(there, want, 0.0)
        out.append(aim / aim.sum() if aim.sum() else there / max(1, there.sum()))
    return out


def _factors(base: np.ndarray, most: np.ndarray, aim: np.ndarray) -> np.ndarray:
    """For each row of base the factor s with sum(min(most, s * base)) = aim, or one that takes all where that is less."""
    at = np.divide(most, base, out=np.full(base.shape, np.inf), where=base > 0)  # where a cell is full
    order = np.argsort(at, axis=1)
    at, base, most = (np.take_along_axis(x, order, 1) for x in (at, base, np.where(base > 0, most, 0.0)))
    full = np.cumsum(most, 1) - most  # of the cells before
    open_ = np.cumsum(base[:, ::-1], 1)[:, ::-1]
    with np.errstate(invalid="ignore"):
        reach = np.where(np.isfinite(at), full + at * open_, full)
    enough = (reach >= aim[:, None]) & np.isfinite(at)
    k = np.where(enough.any(1), enough.argmax(1), 0)
    row = np.arange(len(base))
    s = np.divide(aim - full[row, k], open_[row, k], out=np.zeros(len(base)), where=open_[row, k] > 0)
    last = np.where(np.isfinite(at), at, 0.0).max(1)
    return np.where(enough.any(1), np.maximum(s, 0.0), last)


def rake(tokens: np.ndarray, targets: list[np.ndarray], share: float = 0.0, rounds: int = 400, close: float = 1e-7) -> tuple[np.ndarray, float]:
    """Weights of the table's cells, 1 in all, whose sums along each axis are the targets, and the largest miss of these.

    share: of all tokens; no weight is more than its cell's tokens / share. 0 sets no bound.
    """
    total = tokens.sum()
    if not total:
        return np.zeros(tokens.shape), 0.0
    want, t = aims(tokens, targets), tokens / total
    most = t / share if share else np.where(t > 0, 1e9, 0.0)
    factors = [np.ones(n) for n in tokens.shape]
    wide = lambda axis: factors[axis].reshape([-1 if i == axis else 1 for i in range(tokens.ndim)])
    worst = np.inf
    for _ in range(rounds):
        for axis in range(tokens.ndim):
            base = t.copy()
            for other in range(tokens.ndim):
                base = base * (wide(other) if other != axis else 1.0)
            turn = lambda x: np.moveaxis(x, axis, 0).reshape(x.shape[axis], -1)  # noqa: B023, E731
            factors[axis] = _factors(turn(base), turn(most), want[axis])
        x = t
        for axis in range(tokens.ndim):
            x = x * wide(axis)
        x = np.minimum(most, x)
        before, worst = worst, max(float(np.abs(_margin(x, i) - want[i]).max()) for i in range(tokens.ndim))
        if worst < close or (worst > 0.01 and before - worst < 1e-9):
            break
    return x, worst


def calibrated(tokens: np.ndarray, targets: list[np.ndarray], share: float, miss: float = 0.002) -> tuple[np.ndarray, float, float]:
    """Probabilities of cells for the largest share of tokens, at most the one asked for, that meets the targets; the share; the miss."""
    low, high, best = 0.0, share, None
    x, worst = rake(tokens, targets, share)
    if worst <= miss:
        best, low = x, share
    else:
        for _ in range(14):
            mid = (low + high) / 2
            x, gap = rake(tokens, targets, mid)
            if gap <= miss:
                best, worst, low = x, gap, mid
            else:
                high = mid
    if best is None:
        return np.zeros(tokens.shape), 0.0, worst
    t = tokens / max(tokens.sum(), 1)
    return np.minimum(1.0, np.divide(low * best, t, out=np.zeros(t.shape), where=t > 0)), low, worst


def wanted(axis: str, names: list[str], target: dict[str, float], there: np.ndarray) -> np.ndarray:
    """The target of each name as it was given; what is left of 1 goes to REST where that is not named.

    ValueError where shares are negative, add up to more than 1, or to less with REST given, and where a name that should
    have a share has no tokens.
    """
    given = np.array([target.get(n, 0.0) for n in names])
    left = 1.0 - given.sum()
    if REST not in target and left > 1e-9:
        given[names.index(REST)] = left
        left = 0.0
    if given.min() < 0 or abs(left) > 1e-6:
        raise ValueError(f"targets of {axis} add up to {1 - left:.6g}, not to 1, or are negative")
    lost = [n for n, w, t in zip(names, given, there, strict=True) if w > 1e-9 and not t]
    if lost and there.sum():
        raise ValueError(f"targets out of reach: {axis} {', '.join(lost)}: no tokens")
    return given


def mixture(docs: DataFrame, targets: Targets | None = None, share: float = 0.5, seed: int = 1, power: float = 0.7, least: float = 0.005, n_topics: int = 8) -> Mixture:
    """A row for each row of docs: doc_id, key, source_cell, lang_cell, topic_cell, n_tokens, probability, kept.

    targets: shares of tokens for each axis (source, lang, topic); what an axis does not name is REST, with what share the
    target gives REST, or with what is left of 1; other sums and names without tokens are refused. The sample holds `share` of all tokens, or the largest share with which the targets can be met; if
    they cannot be met at all, ValueError tells what was wanted and what is reached. Without targets, values with `least`
    of the tokens or more are named (so at most 1 / least an axis) and each axis aims at shares tempered by `power`,
    drawn back half by half towards the table's own shares until they can be met with `share`.

    Tokens are words [^\\x20\\x09-\\x0D]+, not those of a tokenizer; a null or empty text has none and is of topic0. Topics
    are clusters (topics.py) over all documents. Null values of an axis count as REST. Rows with equal doc_id and text
    share their fate. An empty table gives an empty result. Other columns are ignored; whole texts are read.
    """
    spark = docs.sparkSession
    key = F.xxhash64("doc_id", F.col("text").cast("string"))
    plain = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), *(F.col(k).cast("string").alias(k) for k in AXES[:2]))
    words = saved(counted(plain), "mix-words")
    rows = saved(named(words, fitted(words, n_topics)), "mix-rows")
    done(words)
    if targets is None:
        low = least * (rows.agg(F.sum("n_tokens")).first()[0] or 0)
        names = {k: sorted(r[0] for r in rows.groupBy(k).agg(F.sum("n_tokens").alias("n")).where(F.col(k).isNotNull() & (F.col("n") > low)).collect()) for k in AXES}
    else:
        names = {k: [n for n in targets[k] if n != REST] for k in AXES}
    axes = {k: [*names[k], REST] for k in AXES}
    cell = lambda k: F.when(F.col(k).isin(names[k]), F.col(k)).otherwise(REST).alias(f"{k}_cell") if names[k] else F.lit(REST).alias(f"{k}_cell")
    celled = rows.select("doc_id", "key", "n_tokens", *map(cell, AXES))
    found = celled.groupBy(*(f"{k}_cell" for k in AXES)).agg(F.sum("n_tokens").alias("n")).collect()  # at most the product of the axes
    tokens = np.zeros([len(axes[k]) for k in AXES])
    at = lambda r: tuple(axes[k].index(r[f"{k}_cell"]) for k in AXES)
    for r in found:
        tokens[at(r)] = r["n"] or 0
    if targets is not None:
        want = [wanted(k, axes[k], targets[k], _margin(tokens, i)) for i, k in enumerate(AXES)]
        p, share, miss = calibrated(tokens, want, share)
        if not share and tokens.sum():
            x = rake(tokens, want)[0]
            raise ValueError("targets out of reach: " + "; ".join(f"{k} {n}: wanted {w:.3f}, reached {g:.3f}" for i, k in enumerate(AXES) for n, w, g in zip(axes[k], aims(tokens, want)[i], _margin(x, i), strict=True) if abs(w - g) > 0.002))
    else:
        own = [_margin(tokens, i) / max(tokens.sum(), 1) for i in range(3)]
        for pull in (1.0, 0.5, 0.25, 0.125, 0.0):
            want = [o + pull * (tempered(o, power) - o) for o in own]
            x, miss = rake(tokens, want, share)
            if miss <= 0.002:
                break
        t = tokens / max(tokens.sum(), 1)
        p = np.minimum(1.0, np.divide(share * x, t, out=np.zeros(t.shape), where=t > 0))
    got = p * tokens
    goal = aims(tokens, want)
    report = [(k, n, float(goal[i][j]), float(_margin(got, i)[j] / got.sum()) if got.sum() else 0.0) for i, k in enumerate(AXES) for j, n in enumerate(axes[k])]
    chance = spark.createDataFrame([(*(r[f"{k}_cell"] for k in AXES), float(p[at(r)])) for r in found], ", ".join(f"{k}_cell string" for k in AXES) + ", probability double")
    # The top 53 bits of a hash as a number in [0, 1).
    lot = F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 11).cast("double") / float(1 << 53)
    out = celled.join(F.broadcast(chance), [f"{k}_cell" for k in AXES]).withColumn("kept", lot < F.col("probability"))
    out = out.select("doc_id", "key", *(f"{k}_cell" for k in AXES), "n_tokens", "probability", "kept")
    return Mixture(out, float(share), spark.createDataFrame(report, "axis string, value string, wanted double, attained double"))


def mix(docs: DataFrame, targets: Targets | None = None, **kinds) -> DataFrame:
    """The rows of mixture(), by its rules."""
    return mixture(docs, targets, **kinds).rows


def mixed(docs: DataFrame, targets: Targets | None = None, **kinds) -> DataFrame:
    """The rows of docs that the mixture keeps, whole, with all their columns, whatever these are called; rules as in mixture()."""
    stay = mix(docs, targets, **kinds).where("kept").select(F.col("key").alias("_stay")).distinct()
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64("doc_id", F.col("text").cast("string")).alias("_key"))
    return packed.join(stay, F.col("_key") == F.col("_stay"), "left_semi").select("_row.*")
