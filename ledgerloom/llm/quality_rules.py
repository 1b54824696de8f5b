"""Weak supervision of document quality: rules vote good or bad or abstain, EM weighs them, a posterior decides.

The rules read counts taken in one pass over whole texts. Votes are counted by pattern, of which there are at most
3 ** rules whatever the input; EM for a two-class model with one accuracy a rule runs on that table, and each pattern's
posterior probability goes back to the rows by an expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import saved
from .textkernel import WHITE, slices, text_bytes, windows, words_of

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_caps", "n_digits"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _lines(raw: np.ndarray, a: int, z: int, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line, byte for byte."""
    if not len(starts):
        return 0, 0
    cuts = np.concatenate([[a], np.flatnonzero(raw[a:z] == 10) + a + 1, [z + 1]])
    holds = np.diff(np.searchsorted(starts, cuts, "left")) > 0
    text = raw[a:z].tobytes()
    lines = [text[cuts[i] - a : cuts[i + 1] - a - 1] for i in np.flatnonzero(holds)]
    return len(lines), len(lines) - len(set(lines))


def _repeated(words: np.ndarray, size: int = 8) -> int:
    """Words that stand in a window of `size` words found twice or more."""
    if len(words) < size:
        return 0
    w = windows(words, size)
    _, inverse, count = np.unique(w, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    if not twice.any():
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _per_text(marks: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    out, full = np.zeros(len(offs) - 1, np.int64), offs[1:] > offs[:-1]
    if full.any():
        out[full] = np.add.reduceat(marks, offs[:-1][full], dtype=np.int64)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (x.slice(a, z - a) for x in batches for a, z in slices(x.column(1))):
        raw, offs = text_bytes(b.column(1))
        hashes, starts, ends, at = words_of(raw, offs)
        runs = {"n_symbols": _SYMBOL[raw], "n_caps": (raw >= 65) & (raw <= 90), "n_digits": (raw >= 48) & (raw <= 57), "word_chars": ((raw & 0xC0) != 0x80) & ~WHITE[raw]}
        out = {k: _per_text(v, offs) for k, v in runs.items()} | {"n_words": np.diff(at)}
        rows = [(*_lines(raw, offs[i], offs[i + 1], starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]]), _repeated(h := hashes[at[i] : at[i + 1]]), len(np.unique(h))) for i in range(len(offs) - 1)]
        n_lines, dup, rep, distinct = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else ([], [], [], [])))
        out |= {"n_lines": n_lines, "n_dup_lines": dup, "n_repeat_words": rep, "n_distinct": distinct}
        yield pa.record_batch({"doc_id": b.column(0)} | {k: pa.array(out[k], pa.int64()) for k in FEATURES})


def features(docs: DataFrame) -> DataFrame:
    """doc_id and counts over the whole text; null counts as a text without words."""
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(_measured, "doc_id long, " + ", ".join(f"{k} long" for k in FEATURES))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Votes of each rule: 1 good, 0 bad, -1 no vote. Each says one thing where it is sure and else abstains."""
    n, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    bad = {
        "symbols_per_word": 10 * F.col("n_symbols") > n,
        "symbols_per_char": 100 * F.col("n_symbols") > 2 * chars,
        "dup_lines": (F.col("n_dup_lines") > 1) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "variety": 100 * F.col("n_distinct") < 25 * n,
        "monotony": 100 * F.col("n_distinct") < 15 * n,
        "word_length": (chars < 2 * n) | (chars > 14 * n),
        "capitals": 100 * F.col("n_caps") > 30 * chars,
        "digits": 100 * F.col("n_digits") > 30 * chars,
    }
    good = {
        "plain": (100 * F.col("n_symbols") <= n) & (F.col("n_dup_lines") == 0),
        "rich": (n >= 50) & (10 * F.col("n_distinct") >= 3 * n) & (100 * F.col("n_repeat_words") <= 5 * n),
    }
    return {k: F.when(c, 0).otherwise(-1) for k, c in bad.items()} | {k: F.when(c, 1).otherwise(-1) for k, c in good.items()}


class LabelModel:
    """Two classes, votes independent given the class; by EM over vote patterns with their counts.

    Each rule has a chance to vote good, bad or not at all in either class. EM starts from `START`, and pseudo-counts of
    `weight` of all rows hold each rule near it, so that the classes keep their meaning.
    """

    #: class bad, class good: chance to abstain, to vote bad, to vote good
    START = np.array([(0.75, 0.2, 0.05), (0.6, 0.02, 0.38)])

    def __init__(self, n_rules: int, rounds: int = 60, weight: float = 0.05, prior_good: float = 0.8):
        self.prior = self.first = prior_good
        self.chance = np.repeat(self.START[:, None, :], n_rules, axis=1)
        self.start, self.rounds, self.weight = self.chance.copy(), rounds, weight

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        i = np.arange(votes.shape[1])
        logs = [np.log(p) + np.log(self.chance[c][i, votes + 1]).sum(1) for c, p in ((0, 1 - self.prior), (1, self.prior))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    def fit(self, votes: np.ndarray, counts: np.ndarray) -> "LabelModel":
        extra = 1 + self.weight * counts.sum()
        for _ in range(self.rounds if len(votes) else 0):
            good = self.posterior(votes)
            for c, share in ((0, 1 - good), (1, good)):
                mass = counts * share
                for v in range(3):
                    self.chance[c, :, v] = ((votes + 1 == v) * mass[:, None]).sum(0) + extra * self.start[c, :, v]
                self.chance[c] /= self.chance[c].sum(1, keepdims=True)
            self.prior = float((counts @ good + extra * self.first) / (counts.sum() + extra))
        return self


def score(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, posterior, kept.

    base_failed: under 20 words, or over 30 % of the words in repeated 8-word windows. kept is false there; elsewhere the
    posterior probability of good quality reaches the threshold. A null or empty text has no words and fails. Repeated
    rows are rows of their own; an empty table gives an empty result; other columns are ignored.
    """
    votes = rules()
    code = reduce(lambda a, v: a * 3 + v + 1, votes.values(), F.lit(0))
    found = saved(features(docs).withColumn("pattern", code), "quality-counts")
    table = found.where(~base_failed()).groupBy("pattern").count().collect()  # 3 ** rules rows at most
    patterns = np.array([r["pattern"] for r in table], np.int64)
    cells = np.stack([patterns // 3**i % 3 - 1 for i in range(len(votes))][::-1], 1) if table else np.zeros((0, len(votes)), np.int64)
    model = LabelModel(len(votes)).fit(cells, np.array([r["count"] for r in table], float))
    rows = [(int(p), float(g)) for p, g in zip(patterns, model.posterior(cells), strict=True)]
    good = F.broadcast(docs.sparkSession.createDataFrame(rows, "pattern int, posterior double"))
    out = found.withColumn("base_failed", base_failed()).join(good, "pattern", "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("posterior") >= threshold, F.lit(False))).drop("pattern")
