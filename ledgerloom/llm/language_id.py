"""Language of a text by Bayesian fusion: text likelihood, declared language, address suffix and host prior.

The text model counts byte trigrams a language on a bounded sample of rows whose language is declared. Host priors come
from all rows: text-only posteriors are summed by suffix and host in one grouped aggregation and smoothed host -> suffix
-> all. The posterior then multiplies prior, declaration and tempered likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import rows_with, saved
from .textkernel import slices, text_bytes

BINS = 1 << 15
OTHER = "und"
_CLASS = np.full(256, 32, np.uint8)  # letters in lower case and bytes of other scripts; all else is a space
_CLASS[97:123] = _CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def _trigrams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the trigram at each byte but the last two, and whether it holds two letters at least."""
    c = _CLASS[raw].astype(np.uint32)
    a, b, d = c[:-2], c[1:-1], c[2:]
    mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (d * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return mixed >> np.uint32(17), ((a != 32).astype(np.uint8) + (b != 32) + (d != 32)) > 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (language, text) to (language, bin, n)."""
    for b in batches:
        names = np.array(b.column(0).to_pylist())
        for name in np.unique(names):
            raw, offs = text_bytes(b.column(1).filter(pa.array(names == name)))
            if len(raw) > 2:
                bins, ok = _trigrams(raw)
                n = np.bincount(bins[ok], minlength=BINS)
                at = np.flatnonzero(n)
                yield pa.record_batch({"language": pa.array([str(name)] * len(at), pa.string()), "bin": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})


def train(docs: DataFrame, languages: Sequence[str], declared: Column, key: Column, sample: int = 3000, smooth: float = 0.05) -> np.ndarray:
    """Log probability of each bin for each language, and for the class of no known language a flat one.

    At most about `sample` texts a language are read, chosen by a hash of their key; counts and not rows reach the
    driver, BINS for each language.
    """
    known = docs.select(declared.alias("language"), "text", key.alias("key")).where(F.col("language").isin(list(languages)) & F.col("text").isNotNull())
    size = {r["language"]: r["count"] for r in known.groupBy("language").count().collect()}
    share = F.coalesce(*(F.when(F.col("language") == k, F.lit(min(1.0, sample / n))) for k, n in size.items()), F.lit(0.0))
    chosen = known.where(F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1_000_003)) < share * 1_000_003)
    counts = np.zeros((len(languages), BINS))
    for r in chosen.select("language", "text").mapInArrow(_counted, "language string, bin int, n long").groupBy("language", "bin").agg(F.sum("n").alias("n")).collect():
        counts[list(languages).index(r["language"]), r["bin"]] = r["n"]
    model = np.log((counts + smooth) / (counts.sum(1, keepdims=True) + smooth * BINS))
    return np.vstack([model, np.full(BINS, -np.log(BINS))]).T.astype(np.float32).copy()


#: bytes looked at in one go, inside one text too
STEP = 1 << 18


def _summed(raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of its trigrams and their log likelihoods summed by class."""
    n, total = np.zeros(len(offs) - 1, np.int64), np.zeros((len(offs) - 1, table.shape[1]))
    across = np.sort(np.concatenate([offs[1:-1] - 1, offs[1:-1] - 2]))  # these trigrams would reach into the next text
    end = max(0, len(raw) - 2)
    for a in range(0, end, STEP):
        z = min(a + STEP, end)
        bins, ok = _trigrams(raw[a : z + 2])
        ok[across[np.searchsorted(across, a) : np.searchsorted(across, z)] - a] = False
        seen, run = np.zeros(z - a + 1, np.int64), np.zeros((z - a + 1, table.shape[1]))
        np.cumsum(ok, out=seen[1:])
        np.cumsum(table[bins] * ok[:, None], axis=0, out=run[1:])
        first, last = np.searchsorted(offs, a, "right") - 1, np.searchsorted(offs, z, "left")
        at = np.clip(offs[first : last + 1], a, z) - a
        n[first:last] += np.diff(seen[at])
        total[first:last] += np.diff(run[at], axis=0)
    return n, total


def likelihoods(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Adds letters, n (trigrams) and ll (mean log likelihood of each class) to rows that begin with text; the text goes."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BINS rows, fixed
    rest = rows.columns[1:]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for a, z in slices(x.column(0)):
                b = x.slice(a, z - a)
                raw, offs = text_bytes(b.column(0))
                n, total = _summed(raw, offs, shared.value)
                solid = np.concatenate([[0], np.cumsum(_CLASS[raw] != 32)])
                mean = total / np.maximum(n, 1)[:, None]
                yield pa.record_batch([*(b.column(i + 1) for i in range(len(rest))), pa.array(np.diff(solid[offs]), pa.int64()), pa.array(n, pa.int64()), pa.FixedSizeListArray.from_arrays(mean.ravel(), mean.shape[1]).cast(pa.list_(pa.float64()))], [*rest, "letters", "n", "ll"])

    return rows.mapInArrow(run, f"{kinds}, letters long, n long, ll array<double>")


def _soft(df: DataFrame, scores: list[Column], name: str) -> DataFrame:
    """Adds <name>0, <name>1, ...: probabilities in proportion to exp of the scores. Column by column, so that none is worked out twice."""
    k = range(len(scores))
    df = df.withColumns({f"_s{i}": s for i, s in enumerate(scores)}).withColumn("_top", F.greatest(*(f"_s{i}" for i in k)))
    df = df.withColumns({f"_e{i}": F.exp(F.col(f"_s{i}") - F.col("_top")) for i in k}).withColumn("_sum", reduce(lambda a, b: a + b, (F.col(f"_e{i}") for i in k)))
    return df.withColumns({f"{name}{i}": F.col(f"_e{i}") / F.col("_sum") for i in k}).drop("_top", "_sum", *(f"_{x}{i}" for x in "se" for i in k))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def declared_in(page: Column) -> Column:
    """The lang attribute of the html element."""
    return F.lower(F.regexp_extract(F.coalesce(page, F.lit("")), r"(?is)<html\b[^<>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))


def identify(
    rows: DataFrame,
    id_col: str = "doc_id",
    text: Column | str = "text",
    declared: Column | str = "lang",
    host: Column | str = "source",
    languages: Sequence[str] = ("en", "de", "fr", "es"),
    sample: int = 3000,
    evidence: int = 60,
    trust: float = 0.9,
    strength: float = 20.0,
    least: float = 0.5,
) -> DataFrame:
    """<id>, language, posterior, kept.

    evidence: a text counts as that many independent trigrams at most; trust: chance that a declared language is right;
    strength: rows that a prior one level up is worth. language is `und` where none of the languages is likely. kept:
    the language is known and its posterior is `least` or more. A null or empty text, or one without letters, is `und`
    and not kept; one with letters but no trigram of them goes by declaration and prior. A null declaration or one of another language is no evidence; a null host is
    a host of its own. Repeated rows count as often as they occur; an empty table gives an empty result.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    classes = [*languages, OTHER]
    plain = rows.select(col(text).cast("string").alias("text"), F.col(id_col).alias("id"), F.lower(F.coalesce(col(declared).cast("string"), F.lit(""))).alias("declared"), F.coalesce(col(host).cast("string"), F.lit("")).alias("host"))
    plain = plain.withColumn("suffix", F.regexp_extract("host", r"\.([^.]+)$", 1))
    model = train(plain, languages, F.col("declared"), F.col("id"), sample)
    found = saved(likelihoods(plain, model), "language-text")
    tempered = [F.col("ll")[i] * F.least(F.col("n"), F.lit(evidence)) for i in range(len(classes))]
    told = _soft(found.where("n > 0"), tempered, "p")
    hosts = saved(told.groupBy("suffix", "host").agg(F.count("*").alias("n"), *(F.sum(f"p{i}").alias(f"p{i}") for i in range(len(classes)))), "language-hosts")
    sums = [F.sum("n").alias("n"), *(F.sum(f"p{i}").alias(f"p{i}") for i in range(len(classes)))]
    total = hosts.agg(*sums).first()
    flat = [((total[f"p{i}"] or 0.0) + 1) / ((total["n"] or 0) + len(classes)) for i in range(len(classes))]
    suffixes = hosts.groupBy("suffix").agg(*sums).select("suffix", *(((F.col(f"p{i}") + strength * flat[i]) / (F.col("n") + strength)).alias(f"s{i}") for i in range(len(classes))))
    prior = hosts.join(suffixes, "suffix").select("host", *(F.log((F.col(f"p{i}") + strength * F.col(f"s{i}")) / (F.col("n") + strength)).alias(f"h{i}") for i in range(len(classes))))
    prior = saved(prior, "language-priors")
    wrong = (1 - trust) / len(languages)
    said = [F.when(F.col("declared").isin(list(languages)), F.when(F.col("declared") == k, F.log(F.lit(trust))).otherwise(F.log(F.lit(wrong)))).otherwise(0.0) for k in languages]
    said.append(F.when(F.col("declared").isin(list(languages)), F.log(F.lit(wrong))).otherwise(0.0))
    joined = found.join(prior, "host", "left")
    joined = _soft(joined, [t + s + F.coalesce(F.col(f"h{i}"), F.lit(float(np.log(flat[i])))) for i, (t, s) in enumerate(zip(tempered, said, strict=True))], "p")
    best = F.array_max(F.array(*(F.struct(F.col(f"p{i}").alias("p"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(classes))))
    out = joined.withColumn("best", best).select(F.col("id").alias(id_col), F.when(F.col("letters") > 0, F.col("best.k")).otherwise(OTHER).alias("language"), F.when(F.col("letters") > 0, F.col("best.p")).otherwise(1.0).alias("posterior"))
    return out.withColumn("kept", (F.col("language") != OTHER) & (F.col("posterior") >= least))


def accepted(docs: DataFrame, **kinds) -> DataFrame:
    """The rows of docs whose language is known, whole, with all their columns, whatever these are called.

    Verdicts are those of identify(), so rows with an empty or null text go. Rows that repeat a doc_id all stay if one
    does, null doc_ids alike; an empty table gives an empty result. Verdicts are written before rows meet them: a filter
    above the fusion would copy its expressions into one method that is too long to be compiled.
    """
    found = saved(identify(docs, **kinds).select(F.col("doc_id").cast("long").alias("doc_id"), "kept"), "language-kept")
    return rows_with(docs, found.where("kept").select("doc_id").distinct())
