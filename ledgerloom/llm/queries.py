"""Registered queries of the corpus operators, one an operator, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, collocations, exact_dedup, html_extract, language_id, line_dedup, merkle_manifest, mixing, near_dedup, quality_rules, sentence_pieces, sharding
from .scratch import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json", variable: str = "CORPUS_VOCABULARY") -> str:
    """Where a tokenizer's file lies: where the variable says, or in the installed package of public tokenizers."""
    if path := os.environ.get(variable):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, f"{sf_dir}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), vocabulary())


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by text, declared language and source; pages by main text, markup, address suffix and host."""
    pages = html_extract.extract(_table(spark, sf_dir, "pages"), language_id.declared_in(F.col("html")).alias("declared"))
    pages = saved(pages.select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), "page_id", "text", "declared", language_id.host_of(F.col("url")).alias("host")), "language-pages")
    docs = _table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    rows = docs.unionByName(pages).select(F.struct("kind", "doc_id", "page_id").alias("row"), "text", "declared", "host")
    return language_id.identify(rows, "row", declared="declared", host="host").select("row.kind", "row.doc_id", "row.page_id", "language", "posterior", "kept")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers of a quarter of the rows are withheld, by a hash, from parsing and from training; their roles are recovered."""
    rows = _table(spark, sf_dir, "conversations")
    shown = rows.withColumn("role", F.when(F.pmod(F.xxhash64("conv_id", "turn", F.lit(13)), F.lit(4)) > 0, F.col("role")))
    out = chat_format.parse(shown)
    return out.select("conv_id", "turn", "role", "told", F.length("text").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("key")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document, by the checksum of its id, is tampered with: the capitals of its text become small."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", capitals, capitals.lower()))
    return merkle_manifest.verified(_table(spark, sf_dir, "documents"), changed)


def _manifest_sql(levels: int = 4) -> str:
    """Trees of up to 16 ** levels leaves, level by level."""
    field = lambda c, v: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v} END"
    head = " || ".join(field(c, c) for c in merkle_manifest.FIELDS[:-1])
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        "crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(0, 8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(0, 256) AS r(i)))",
        "sums AS (SELECT d.*, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(t[1 + (xor(a, b) & 255)], a >> 8), 4294967295::BIGINT), 4294967295) AS crc32 FROM documents d, crc)",
        f"""leaves AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({head} || {field("text", "text")}) AS h,
            CASE WHEN crc32 % 5 = 0 AND text IS NOT NULL THEN sha256({head} || {field("text", low)}) END AS changed FROM sums)""",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
    ]
    level = lambda to, of: f"{to} AS (SELECT tree, i // 16 AS i, (max(n) + 15) // 16 AS n, list(h ORDER BY i) AS kids, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {of} WHERE n > 1 GROUP BY tree, i // 16)"
    out += [level(f"d{k}", f"d{k - 1}") for k in range(1, levels + 1)]
    out.append("subroots AS (" + " UNION ALL ".join(f"SELECT tree, h FROM d{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    out.append("t0 AS (SELECT tree AS source_tree, '' AS tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM subroots)")
    out += [level(f"t{k}", f"t{k - 1}") for k in range(1, levels + 1)]
    out.append("tops AS (" + " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    joins, folds, sides, before = [], [], [], "coalesce(changed, d0.h)"
    for kind in ("d", "t"):
        for k in range(1, levels + 1):
            t, at = f"{kind}{k}", f"({kind}0.i // {16 ** (k - 1)} % 16)"
            joins.append(f"LEFT JOIN {t} ON {t}.tree = {kind}0.tree AND {t}.i = {kind}0.i // {16**k}")
            left, right = f"array_to_string({t}.kids[1:{at}], '')", f"array_to_string({t}.kids[{at} + 2:], '')"
            folds.append(f"CASE WHEN {t}.h IS NULL THEN {before} ELSE sha256({left} || {before} || {right}) END AS f{t}")
            sides.append(f"coalesce({left} || {right}, '')")
            before = f"f{t}"
    own = f"""SELECT d0.doc_id, d0.h AS leaf, t0.h AS subroot, tops.h AS root, sha256({" || ".join(sides)}) AS proof_sha256, {", ".join(folds)}
              FROM d0 JOIN t0 ON t0.source_tree = d0.tree CROSS JOIN tops {" ".join(joins)}"""
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, root, proof_sha256, {before} AS folded_root, {before} = root AS verified FROM ({own})"


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.token_digests(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model", "CORPUS_PIECES"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_chat_format": op7_chat_format,
    "op8_mixing": op8_mixing,
    "op9_kd_shards": op9_kd_shards,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_collocations": op12_collocations,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLES = {
    "op11_merkle_manifest": _manifest_sql(),
    "op12_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
             totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
             f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
                   FROM w CROSS JOIN range(1, 6) AS r(k) WHERE len(ws) >= k) GROUP BY ALL HAVING count(*) >= 100),
             c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
             cuts AS (SELECT lang, phrase, k, f AS a, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
             s AS (SELECT cuts.lang, cuts.phrase, a, cut, h.f AS l, t.f AS r, n, ((1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
                   FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = rest JOIN totals ON totals.lang = cuts.lang),
             best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s),
             inner_ AS (SELECT DISTINCT lang, phrase, f AS longer FROM (SELECT lang, f, k, j, ws, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM c)) AS x, LATERAL (SELECT array_to_string(ws[i:i + j - 1], ' ') AS phrase)),
             kept AS (SELECT * FROM best WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM inner_ WHERE inner_.lang = best.lang AND inner_.phrase = best.phrase AND 100 * longer >= 100 * a)),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
             g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY norm)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256 FROM d JOIN g USING (norm)""",
    "op3_line_dedup": r"""
        WITH l AS (SELECT doc_id, source, pos, raw, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
                   FROM (SELECT doc_id, coalesce(source, '') AS source, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
             bad AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
             f AS (SELECT l.*, line IN (SELECT line FROM bad) AS gone FROM l)
        SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256 FROM f GROUP BY doc_id""",
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                          ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
             l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
             e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
             reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x)
        SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
}
