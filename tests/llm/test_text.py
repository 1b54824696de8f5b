import json
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat_format, language_id, mixing, quality_rules, sharding, textkernel, topics
from ledgerloom.llm.queries import QUERIES, vocabulary

from messy import empty, table, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


# --- words and shingles ---


def test_words_across_pieces(monkeypatch):
    monkeypatch.setattr(textkernel, "CHUNK", 16)
    rows = [t or "" for _, t in texts() if len(t or "") < 9000]
    raw, offs = textkernel.text_bytes(pa.array(rows))
    h, s, e, at = textkernel.words_of(raw, offs)
    seen = {}
    for i, t in enumerate(rows):
        got = [bytes(raw[a:z]).decode() for a, z in zip(s[at[i] : at[i + 1]], e[at[i] : at[i + 1]], strict=True)]
        assert got == WORD.findall(t)
        for w, x in zip(got, h[at[i] : at[i + 1]].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


# --- quality ---


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {i + k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover)


def test_quality_counts(spark, sf):
    got = quality_rules.score(table(spark)).collect()
    key = lambda r: tuple(r)
    assert sorted((key((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)) == sorted(brute_counts(t) for _, t in texts())
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert quality_rules.score(empty(spark)).count() == 0


def test_quality_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_rules.score(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    right = sum(int(r.kept) == r.quality for r in got)
    assert right >= 0.97 * len(got) and sum(not r.kept for r in got if r.quality) <= 0.01 * len(got)


def brute_verdicts(rows, threshold=0.5):
    """doc_id -> kept: rules voted text by text, and EM over single texts instead of vote patterns."""
    votes, ids, failed = [], [], set()
    for d, t in rows:
        w = WORD.findall(t or "")
        n, chars, symbols, dup, rep = brute_counts(t)
        ids.append(d)
        if n < 20 or 100 * rep > 30 * n:
            failed.add(d)
        lines, chars = sum(bool(WORD.search(x)) for x in (t or "").split("\n")), max(chars, 1)
        caps, digits, distinct = (sum(c in s for c in t or "") for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ""))
        distinct = len(set(w))
        bad = [10 * symbols > n, 100 * symbols > 2 * chars, dup > 1 and 10 * dup > 3 * lines, 100 * distinct < 25 * n, 100 * distinct < 15 * n, chars < 2 * n or chars > 14 * n, 100 * caps > 30 * chars, 100 * digits > 30 * chars]
        good = [100 * symbols <= n and dup == 0, n >= 50 and 10 * distinct >= 3 * n and 100 * rep <= 5 * n]
        votes.append([0 if b else -1 for b in bad] + [1 if g else -1 for g in good])
    live = [v for d, v in zip(ids, votes, strict=True) if d not in failed]
    start = {0: {-1: 0.75, 0: 0.2, 1: 0.05}, 1: {-1: 0.6, 0: 0.02, 1: 0.38}}
    chance = {c: [dict(start[c]) for _ in range(10)] for c in (0, 1)}
    prior, extra = 0.8, 1 + 0.05 * len(live)

    def posterior(v):
        like = {c: (prior if c else 1 - prior) * np.prod([chance[c][i][x] for i, x in enumerate(v)]) for c in (0, 1)}
        return like[1] / (like[0] + like[1])

    for _ in range(60):
        good = [posterior(v) for v in live]
        for c in (0, 1):
            share = [g if c else 1 - g for g in good]
            for i in range(10):
                mass = {x: sum(s for s, v in zip(share, live, strict=True) if v[i] == x) + extra * start[c][x] for x in (-1, 0, 1)}
                chance[c][i] = {x: m / sum(mass.values()) for x, m in mass.items()}
        prior = (sum(good) + extra * 0.8) / (len(live) + extra)
    return {d: d not in failed and posterior(v) >= threshold for d, v in zip(ids, votes, strict=True)}


def test_verdicts_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_verdicts(rows)
    got = {r.doc_id: r.kept for r in QUERIES["op2_quality_rules"](spark, sf).collect()}
    assert got == want and 0 < sum(got.values()) < len(got)


def test_label_model_finds_accuracies():
    r = np.random.default_rng(7)
    good = r.random(4000) < 0.8
    acc = [0.95, 0.9, 0.85, 0.8, 0.6]
    votes = np.stack([np.where(r.random(4000) < 0.3, -1, np.where(r.random(4000) < a, good, ~good)) for a in acc], 1)
    cells, n = np.unique(votes, axis=0, return_counts=True)
    m = quality_rules.LabelModel(5, weight=0.001).fit(cells, n.astype(float))
    assert ((m.posterior(votes) >= 0.5) == good).mean() > 0.9 and abs(m.prior - 0.8) < 0.08


# --- tokens ---


def test_bpe_against_the_library_on_odd_strings():
    from tokenizers import Tokenizer

    t, ours, r = Tokenizer.from_file(vocabulary()), bpe.WordBpe(json.load(open(vocabulary(), encoding="utf-8"))), random.Random(1)
    letters = "abcdeiİIßéÉñ.,'’0123 \t\n-_ΣσςſĶ\u0301\u0327\u0307日本\U0001f389<|>ǅ"
    whole = ["<|endoftext|>", "<|startoftext|>", "aİ", "İ.", "A.İ.", "Bİ, ve", "'S", " ", "x" * 70, "é" * 40]
    for _ in range(20):
        rows = ["".join(r.choices(letters, k=r.randrange(1, 14))) if r.random() < 0.9 else "".join(r.choices(whole, k=4)) for _ in range(1000)]
        for x, got in zip(rows, ours.packed(rows), strict=True):
            want = t.encode(x, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == want, x


def test_bpe_against_the_library_on_all_code_points():
    from tokenizers import Tokenizer

    t, ours = Tokenizer.from_file(vocabulary()), bpe.WordBpe(json.load(open(vocabulary(), encoding="utf-8")))
    rows = [f"a{chr(i)}b{chr(i)}" for i in (*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE0200))]
    for at in range(0, len(rows), 5000):
        part = rows[at : at + 5000]
        want = t.encode_batch(part, add_special_tokens=False)
        assert not [x for x, got, w in zip(part, ours.packed(part), want, strict=True) if np.frombuffer(got, "<u4").tolist() != w.ids]


def test_bpe_as_the_library(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    rows = [*texts(), (70, "x <|endoftext|>y<|startoftext|>"), (71, "rrrara rrrr rrrrr nnn 'S it's DON'T"), *duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()]
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode(table(spark, rows), vocabulary()).collect())
    want = Counter()
    for d, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want[(d, tuple(ids), t.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    assert bpe.token_digests(empty(spark), vocabulary()).count() == 0


def test_bpe_with_nothing_new_to_learn():
    ours = bpe.WordBpe(json.load(open(vocabulary(), encoding="utf-8")))
    first = ours.packed(["the same words.", None, ""])
    assert ours.packed(["the same words.", None, ""]) == first and first[1] == first[2] == b"" and ours.packed([]) == [] and ours.packed([""]) == [b""]


def test_automaton_on_small_alphabets():
    """Against merging in order of rank, over all words of a few letters and random merge lists."""
    import itertools
    import random

    def merged(word, ranks):
        parts = list(word)
        while True:
            at = min((i for i in range(len(parts) - 1) if (parts[i], parts[i + 1]) in ranks), key=lambda i: (ranks[parts[i], parts[i + 1]], i), default=None)
            if at is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    r = random.Random(9)
    for _ in range(30):
        vocab, merges = {"a": 0, "b": 1, "c": 2}, []
        for _ in range(14):
            x, y = r.choice(list(vocab)), r.choice(list(vocab))
            if x + y not in vocab and len(merged(x + y, {m: i for i, m in enumerate(merges)})) == 2:
                merges.append((x, y))
                vocab[x + y] = len(vocab)
        dfa, ranks, names = bpe.Automaton(vocab, merges), {m: i for i, m in enumerate(merges)}, {v: k for k, v in vocab.items()}
        for n in range(1, 8):
            for word in map("".join, itertools.product("abc", repeat=n)) if n < 6 else ("".join(r.choices("abc", k=n * 2)) for _ in range(60)):
                assert [names[i] for i in dfa.encode(word)] == merged(word, ranks)


# --- languages ---


def test_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = df.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.xxhash64("doc_id") % 2 == 0, F.col("lang")))
    got = language_id.identify(held).join(held.select("doc_id", "truth", F.col("lang").alias("told")), "doc_id").where("told is null").collect()
    assert sum(r.language == r.truth for r in got) > 0.98 * len(got)


def test_language_query_on_pages_and_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_language_id"](spark, sf)
    docs, pages = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    assert got.where("kind = 'document'").select("doc_id").exceptAll(docs.select("doc_id")).count() == 0 and got.count() == docs.count() + pages.count()
    told = pages.select("page_id", language_id.declared_in(F.col("html")).alias("told"))
    both = got.where("kind = 'page'").join(told, "page_id")
    assert both.where("language = told").count() > 0.97 * both.count() > 0


def test_markup_suffix_and_host_withheld_by_hash(spark):
    """Pages whose declarations are hidden by a hash, and whose texts are cut to two words: suffix and host decide more than chance."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("told", language_id.declared_in(F.col("html")))
    text = F.regexp_replace("html", "<[^>]*>", " ")
    rows = df.select("page_id", "told", text.alias("text"), F.when(F.xxhash64("page_id") % 2 == 0, F.col("told")).alias("lang"), language_id.host_of(F.col("url")).alias("source"))
    got = language_id.identify(rows, "page_id").join(rows.select("page_id", "told", "lang"), "page_id").where("lang is null").collect()
    assert sum(r.language == r.told for r in got) > 0.97 * len(got) > 0


def brute_language(rows, model, languages, evidence=60, trust=0.9, strength=20.0):
    """(language, posterior) of each (text, declared, host), number by number, from the same likelihoods."""
    k = len(languages) + 1
    scores = []
    for text, _, _ in rows:
        raw = (text or "").encode()
        ll, n = np.zeros(k), 0
        for i in range(len(raw) - 2):
            bins, ok = language_id._trigrams(np.frombuffer(raw[i : i + 3], np.uint8))
            if ok[0]:
                ll, n = ll + model[bins[0]], n + 1
        scores.append((ll / max(n, 1) * min(n, evidence), n, sum(language_id._CLASS[b] != 32 for b in raw)))
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    of = lambda rows_: (sum(rows_, np.zeros(k)), len(rows_))
    told = [(soft(s), h or "") for (s, n, _), (_, _, h) in zip(scores, rows, strict=True) if n]
    total, count = of([p for p, _ in told])
    flat = (total + 1) / (count + k)
    suffix = lambda h: h.rsplit(".", 1)[1] if "." in h and not h.endswith(".") else ""
    out = []
    for (s, _, letters), (_, d, h) in zip(scores, rows, strict=True):
        h = h or ""
        mine = [p for p, x in told if x == h]
        prior = np.log(flat)
        if mine:
            ps, ns = of([p for p, x in told if suffix(x) == suffix(h)])
            ph, nh = of(mine)
            prior = np.log((ph + strength * (ps + strength * flat) / (ns + strength)) / (nh + strength))
        said = np.array([np.log(trust if d == x else (1 - trust) / len(languages)) if d in languages else 0.0 for x in [*languages, None]])
        p = soft(s + said + prior)
        out.append(([*languages, "und"][int(p.argmax())], float(p.max())) if letters else ("und", 1.0))
    return out


def test_language_against_brute_force(spark):
    languages = ("en", "de", "fr", "es")
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.substring("text", 1, 80).alias("text"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("lang"), F.concat(F.lit("h"), F.col("doc_id") % 7, F.when(F.col("lang") == "de", ".de").otherwise(".com")).alias("source"))
    rows = sorted(df.collect())
    model = language_id.train(df.select("text", F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("declared")), languages, F.col("declared"), F.col("id"))
    want = brute_language([(r.text, r.lang, r.source) for r in rows], model, languages)
    got = {r.doc_id: (r.language, r.posterior) for r in language_id.identify(df, languages=languages).collect()}
    for r, (language, posterior) in zip(rows, want, strict=True):
        assert got[r.doc_id][0] == language and abs(got[r.doc_id][1] - posterior) < 1e-4


def test_accepted_is_compiled(spark):
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert language_id.accepted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_language_on_messy_rows(spark):
    got = language_id.identify(table(spark)).collect()
    assert len(got) == len(texts()) and all((r.language, r.kept) == ("und", False) for r in got if r.doc_id in (5, 6, 7))
    assert language_id.identify(empty(spark)).count() == 0 and language_id.accepted(table(spark)).columns == table(spark).columns


def test_host_prior_decides_short_texts(spark):
    rows = [(i, "Der die das und ist nicht schlicht einung " * 5, "de", "b.de") for i in range(60)] + [(100 + i, "The and of this with shing ation ever " * 5, "en", "a.com") for i in range(60)]
    rows += [(500, "in", None, "b.de"), (501, "in", None, "a.com")]
    got = {r.doc_id: r.language for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), languages=("de", "en")).collect()}
    assert got[500] == "de" and got[501] == "en"


# --- chat ---


def test_chat_roles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat_format.parse(df.withColumn("role", F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System")), chat_format.train(df))
    both = got.select("conv_id", "turn", "role", "text").join(df.select("conv_id", "turn", F.col("role").alias("truth"), F.col("text").alias("t")), ["conv_id", "turn"], "full").collect()
    assert all(r.role == r.truth and r.text == r.t.strip() for r in both)


def test_chat_without_markers(spark):
    """Where every second marker is missing, the alternation of turns recovers most roles."""
    turns = [(c, i, None if i == 3 else ["user", "assistant"][i % 2], f"{'What is it' if i % 2 == 0 else 'It is so'} {c} {i}{'?' if i % 2 == 0 else '.'}") for c in range(40) for i in range(6)]
    got = chat_format.parse(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), chat_format.estimated()).collect()
    line = [r for r in got if "What is it" in r.text and r.text.count("\n") == 0]
    assert line and all(r.role == "user" for r in line)


def test_labels_inside_rows_open_no_turns(spark):
    rows = [(0, "user", "Please fix:\nA: the first item\nB: the second"), (1, "assistant", "Model: GT40\nAgent: none"), (2, "user", "thanks")]
    df = spark.createDataFrame([(1, t, r, x) for t, r, x in rows], "conv_id long, turn long, role string, text string")
    assert sorted((r.turn, r.role, r.text, r.told) for r in chat_format.parse(df, chat_format.estimated()).collect()) == [(t, r, x, True) for t, r, x in rows]


def test_transcripts_in_one_row(spark):
    one = "User: What is it?\nSay more: please\nAssistant: It is so.\nAnd a second line\nUser: Thanks\nAssistant: Good day"
    two = "Q: what is a?\nA: the first\nQ: and b?\nA: the second"
    df = spark.createDataFrame([(1, 0, None, one), (2, 0, None, two)], "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat_format.parse(df, chat_format.estimated()).collect())
    assert got == [
        (1, 0, "user", "What is it?\nSay more: please"), (1, 1, "assistant", "It is so.\nAnd a second line"), (1, 2, "user", "Thanks"), (1, 3, "assistant", "Good day"),
        (2, 0, "user", "what is a?"), (2, 1, "assistant", "the first"), (2, 2, "user", "and b?"), (2, 3, "assistant", "the second"),
    ]


def test_withheld_markers_are_recovered(spark):
    """The registered query hides a quarter of the roles; scored against the table, and the query's rows against parse() on all of them."""
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_chat_format"](spark, sf).join(spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", F.col("role").alias("truth"), F.col("text").alias("t")), ["conv_id", "turn"], "full").collect()
    hidden = [r for r in got if r.told is False]
    assert 0.15 * len(got) < len(hidden) < 0.35 * len(got) and all(r.role == r.truth for r in got if r.told)
    assert sum(r.role == r.truth for r in hidden) >= 0.96 * len(hidden)
    assert all(r.n_chars == len(r.t.strip()) for r in got)


def test_very_many_rows_of_one_turn(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "RUN", 3)
    rows = [(1, 5, "user", f"text {i}") for i in range(700)] + [(1, 4, "user", "before"), (1, 6, "assistant", "after")] + [(2, i, ["user", "assistant"][i % 2], f"x {i}") for i in range(1500)]
    got = chat_format.parse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat_format.estimated()).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.turn)
    assert [r.turn for r in one] == list(range(702)) and one[0].text == "before" and one[-1].text == "after" and {r.text for r in one[1:-1]} == {f"text {i}" for i in range(700)}
    two = sorted((r.turn, r.role, r.text) for r in got if r.conv_id == 2)
    assert two == [(i, ["user", "assistant"][i % 2], f"x {i}") for i in range(1500)]


def test_long_conversations_in_blocks(spark, monkeypatch):
    turns = [(1, i, ["user", "assistant"][i % 2] if i % 5 else None, f"text {i}\nmore\n?") for i in range(150)] + [(2, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    model = chat_format.estimated()
    model.move += np.random.default_rng(1).normal(scale=1e-3, size=model.move.shape)  # no ties
    whole = None
    for size in (1000, 64, 7):
        monkeypatch.setattr(chat_format, "BLOCK", size)
        got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat_format.parse(df, model).collect())
        whole = whole or got
        assert got == whole


def test_viterbi_against_all_paths():
    import itertools

    r = np.random.default_rng(2)
    m = chat_format.estimated()
    e = r.normal(size=(5, 6))
    best = max(itertools.product(range(6), repeat=5), key=lambda p: m.start[p[0]] + e[0, p[0]] + sum(m.move[a, b] + e[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:], strict=False))))
    assert tuple(chat_format.viterbi(e, m.move, m.start)) == best
    mats = [chat_format._opening(e[:2], m), chat_format.reduced(e[2:4], m.move), chat_format.reduced(e[4:], m.move)]
    assert chat_format.viterbi_chain(mats) == [best[1], best[3], best[4]]


def test_messy_chat(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "a"), (1, None, None, ""), (2, 5, "Robot", "x: y"), (2, 6, None, "b" * 10000), (2, -3, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("clash"))
    got = chat_format.parse(df).collect()
    assert len(got) >= 4 and all(r.role in chat_format.ROLES for r in got) and all(r.text.startswith("first") for r in got if r.conv_id == 2 and r.turn == 0)
    assert sum(len(r.text) for r in got) > 10000
    assert chat_format.parse(df.limit(0)).count() == 0


# --- mixture ---


def test_raking_meets_marginals():
    r = np.random.default_rng(1)
    x = r.integers(1, 1000, (6, 4, 3)).astype(float)
    x[2, :, 0] = 0
    targets = [np.array([1, 2, 3, 4, 5, 6.0]), np.array([4, 3, 2, 1.0]), np.array([1, 1, 1.0])]
    w, miss = mixing.rake(x, targets)
    plain = x / x.sum()  # one factor after the other, without a bound
    for _ in range(2000):
        for axis, a in enumerate(targets):
            now = plain.sum(tuple(i for i in range(3) if i != axis))
            plain = plain * (a / a.sum() / now).reshape([-1 if i == axis else 1 for i in range(3)])
    assert miss < 1e-6 and np.allclose(w, plain, atol=1e-6)
    p, share, miss = mixing.calibrated(x, targets, 0.9)
    got = p * x / (p * x).sum()
    assert 0 < share < 0.9 and p.max() <= 1 and (p[x == 0] == 0).all() and abs((p * x).sum() / x.sum() - share) < 1e-3
    for axis, a in enumerate(targets):
        assert np.abs(got.sum(tuple(i for i in range(3) if i != axis)) - a / a.sum()).max() < 0.005
    assert mixing.rake(np.zeros((2, 2, 2)), [np.ones(2)] * 3)[0].sum() == 0


def test_bounded_factors_against_bisection():
    r = np.random.default_rng(4)
    base, most = r.random((20, 7)), r.random((20, 7)) * 0.5
    base[3, 2] = 0
    for part in (0.2, 0.7, 0.99):
        aim = part * np.where(base > 0, most, 0).sum(1)
        s = mixing._factors(base, most, aim)
        assert np.allclose(np.minimum(most, s[:, None] * base).sum(1), aim)


TARGETS = {"source": {"s0": 0.5, "s1": 0.3, mixing.REST: 0.2}, "lang": {"en": 0.7, "de": 0.3}, "topic": {mixing.REST: 1.0}}


def test_sample_follows_targets(spark):
    rows = [(i, "w " * 50, ["en", "de"][i % 2], f"s{i % 3}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(df, TARGETS, share=0.3)
    assert out.count() == 6000 and abs(out.where("kept").count() - 1800) < 150
    n = {tuple(r)[:2]: r[2] for r in out.where("kept").groupBy("source_cell", "lang_cell").count().collect()}
    assert abs(sum(v for k, v in n.items() if k[0] == "s0") / sum(n.values()) - 0.5) < 0.04 and abs(sum(v for k, v in n.items() if k[1] == "en") / sum(n.values()) - 0.7) < 0.04
    assert mixing.mix(df.repartition(7), TARGETS, share=0.3).where("kept").select("doc_id").exceptAll(out.where("kept").select("doc_id")).count() == 0


def test_targets_are_met_or_refused(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    for targets in (None, {"source": {"src0": 0.1, mixing.REST: 0.9}, "lang": {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}, "topic": {mixing.REST: 1.0}}):
        m = mixing.mixture(df, targets)
        assert m.share > 0.2 and all(abs(r.wanted - r.attained) < 0.01 for r in m.report.collect())
        kept = m.rows.where("kept")
        total = kept.agg(F.sum("n_tokens")).first()[0]
        assert abs(total / m.rows.agg(F.sum("n_tokens")).first()[0] - m.share) < 0.03
        for r in m.report.where("axis = 'lang'").collect():
            assert abs((kept.where(F.col("lang_cell") == r.value).agg(F.sum("n_tokens")).first()[0] or 0) / total - r.attained) < 0.03
    rows = [(i, "w " * 50, ["en", "de"][i % 2], ["s0", "s1"][i % 2]) for i in range(100)]
    apart = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="out of reach"):
        mixing.mix(apart, {"source": {"s0": 0.9, "s1": 0.1}, "lang": {"en": 0.2, "de": 0.8}, "topic": {mixing.REST: 1.0}})


@pytest.mark.parametrize("source,said", [({"s0": 0.9, "s1": 0.3}, "add up"), ({"s0": 0.5, mixing.REST: 0.2}, "add up"), ({"s0": 0.5, "s9": 0.5}, "out of reach"), ({"s0": 0.2}, "out of reach"), ({"s0": -0.1, "s1": 1.1}, "negative")])
def test_targets_that_do_not_fit_are_refused(spark, source, said):
    rows = [(i, "w " * 50, "en", ["s0", "s1"][i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match=said):
        mixing.mixture(df.where("source = 's0'") if source == {"s0": 0.2} else df, {"source": source, "lang": {"en": 1.0}, "topic": {mixing.REST: 1.0}})


def test_what_is_left_of_one_goes_to_the_rest(spark):
    rows = [(i, "w " * 50, "en", ["s0", "s1", "s2", "s3"][i % 4]) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    m = mixing.mixture(df, {"source": {"s0": 0.2}, "lang": {"en": 1.0}, "topic": {mixing.REST: 1.0}}, share=0.5)
    got = {r.value: r.attained for r in m.report.where("axis = 'source'").collect()}
    assert abs(got["s0"] - 0.2) < 0.005 and abs(got[mixing.REST] - 0.8) < 0.005 and m.share > 0.45


def test_topics_part_vocabularies(spark):
    r = np.random.default_rng(8)
    rows = [(i, " ".join(f"{'abc'[i % 3]}{x}" for x in r.integers(0, 40, 120)), f"t{i % 3}") for i in range(300)]
    words = topics.counted(spark.createDataFrame(rows, "key long, text string, truth string").select("text", "key", "truth"))
    got = topics.named(words, topics.fitted(words, 3)).groupBy("truth", "topic").count().collect()
    assert len(got) == 3 and len({x.topic for x in got}) == 3


def test_messy_mixture(spark):
    df = table(spark)
    out = mixing.mix(df)
    assert out.count() == len(texts()) and sorted(r.n_tokens for r in out.collect()) == sorted(len(WORD.findall(t or "")) for _, t in texts())
    kept = out.where("kept").count()
    assert mixing.mixed(df).columns == df.columns and mixing.mixed(df).count() == kept and mixing.mix(empty(spark)).count() == 0


# --- shards ---


def test_shards(spark):
    import zlib

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.shard(df).collect()
    text = {r.doc_id: r.text or "" for r in df.collect()}
    sizes = Counter()
    for r in got:
        b = text[r.doc_id].encode()
        assert r.size == len(b) + 8 and r.text_crc32 == zlib.crc32(b) and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r.size
    assert sorted(sizes) == list(range(24)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_shards_of_a_hot_group(spark):
    rows = [(i, "same text in a third of all rows") for i in range(3000)] + [(10000 + i, f"text {i} " * 3) for i in range(6000)]
    got = sharding.shard(table(spark, rows), 24).groupBy("shard").agg(F.sum("size").alias("w")).collect()
    w = [r.w for r in got]
    assert len(w) == 24 and max(w) < 1.1 * min(w)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_equal_texts_share_a_shard(spark, sf):
    """Held against the table by grouping its texts anew."""
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = sharding.shard(df).join(df.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("t")), "doc_id")
    assert got.groupBy("t").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    w = [r.w for r in got.groupBy("shard").agg(F.sum("size").alias("w")).collect()]
    assert len(w) == 24 and max(w) < 1.1 * min(w)


def test_a_group_of_most_of_a_shard(spark):
    """Groups of 0.8 shard and less stay whole, and the shards even."""
    rows = [(i, "one text that is often there") for i in range(240)] + [(1000 + i, "another one that is often there") for i in range(150)] + [(10000 + i, f"text {i:05d} {'x' * (i % 19)}") for i in range(9000)]
    got = sharding.shard(table(spark, rows), 24).collect()
    assert len({r.shard for r in got if r.doc_id < 240}) == len({r.shard for r in got if 1000 <= r.doc_id < 1150}) == 1
    w = Counter()
    for r in got:
        w[r.shard] += r.size
    assert max(w.values()) < 1.1 * min(w.values())


def test_messy_shards(spark):
    got = sharding.shard(table(spark), 4).collect()
    assert len(got) == len(texts()) and {r.size for r in got if r.doc_id in (5, 6)} == {8}
    assert sharding.shard(empty(spark)).count() == 0 and sharding.shard(table(spark, [(1, "x")])).count() == 1


# --- pipeline ---


def test_pipeline(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols, before = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        n = docs.count()
        assert docs.columns == cols and 0 < n <= before, name
        before = n
    # the stages again, each against another way to its rows
    from test_dedup import brute_exact

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spoken = P.language(spark, docs, sf)
    assert {r.doc_id for r in spoken.collect()} == {r.doc_id for r in language_id.identify(docs).collect() if r.kept}
    single = P.exact(spark, spoken, sf)
    assert sorted(r.doc_id for r in single.collect()) == sorted({k for _, k, _, _ in brute_exact([(r.doc_id, r.text) for r in spoken.collect()])})
    fate = mixing.mix(single)
    assert {r.doc_id for r in P.mixture(spark, single, sf).collect()} == {r.doc_id for r in fate.where("kept").collect()}
    out = P.run(spark, sf)
    assert out.count() == before and json.loads(out.limit(1).toJSON().first())["n_tokens"] > 0
    with_mess = table(spark).select(*cols)
    for _, stage in P.STAGES:
        with_mess = stage(spark, with_mess, sf)
    with_mess.collect()


def test_chat_roles_that_are_not_known(spark):
    rows = [(1, 0, "user", "what is it?"), (1, 1, "Assistant", "I look it up."), (1, 2, "tool", "result 5"), (1, 3, "<|assistant|>", "It is 5."), (1, 4, " ", "thanks"), (1, 5, "user x", "more")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.turn, r.told, r.text) for r in chat_format.parse(df, chat_format.estimated()).collect())
    assert got == [(t, t in (0, 1, 3), x) for _, t, _, x in rows]


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_html_extraction", "op5_bpe", "op8_mixing", "op9_kd_shards"])  # others are run elsewhere
def test_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_near_stage_against_brute_force(spark, sf):
    import random

    import corpus_pipeline as P
    from messy import words

    r, rows = random.Random(12), []
    for g in range(6):
        base = words(800 + g, 100)
        rows.append((100 * g, " ".join(base)))
        for i in range(1, 12):
            t = [*base]
            for at in r.sample(range(5, 95), r.choice([1, 2, 2, 3])):
                t[at] = f"n{g} {i}".replace(" ", "x")
            rows.append((100 * g + i, " ".join(t)))
    rows += [(1000, " ".join(words(900, 100))), (1001, " ".join([*words(900, 100)[:30], "a", *words(900, 100)[31:70], "b", *words(900, 100)[71:]]))]
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in rows)}
    assert 80 <= 100 * len(sets[1000] & sets[1001]) / len(sets[1000] | sets[1001]) < 85
    least = {d: d for d in sets}
    for _ in sets:
        for x in sets:
            for y in sets:
                if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                    least[x] = least[y] = min(least[x], least[y])
    got = {x.doc_id for x in P.near(spark, table(spark, rows), sf).collect()}
    assert got == {d for d in sets if least[d] == d} and 1001 not in got
