"""BPE by automaton: merges compiled to a DFA over tokens, words encoded by its transitions, decoded by arc labels.

The automaton starts as one state that loops on every base symbol. For each merge (a, b) in order the merge gadget is
applied: where b can follow a, the arcs labelled a are redirected to a copy of their state without the arc b, and an arc
labelled ab is added beside every arc a, leading where b leads. All arcs of one label lead to one state, so the copy is
made once a merge. The automaton accepts exactly the token sequences that the merges give, one for each word and each
beginning of a word.

All gadgets are applied when a tokenizer is loaded. States are kept as chains of (removed label, time); whether a state
has an arc follows from them, is worked out at the arc's first use and then read from a transition table of fixed size,
as the full table of some 10^9 arcs would not fit a task. Encoding walks many words at a time: at each position of each
word it finds the one label by which the automaton arrives there, from the labels that end there and the transitions.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .textkernel import U, mix, slices

END = "</w>"
# Letters, numbers and small letters of the library's tables that Python's may not have yet.
LETTERS = """1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5
113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"""
NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
SMALL = "1C89>1C8A A7CB>264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>19B 10D50-10D65>10D70 16EA0-16EB8>16EBB"


def _span(text: str) -> range:
    a, _, z = text.partition("-")
    return range(int(a, 16), int(z or a, 16) + 1)


def small_letters() -> dict[int, int]:
    return {c: int(to, 16) + k for x in SMALL.split() for of, to in [x.split(">")] for k, c in enumerate(_span(of))}


def stand_ins() -> dict[int, str]:
    """For each code point that Python's tables do not have, but the library's or the pattern's do, a character of its class in the library's."""
    open_ = "".join(c for c in map(chr, range(0x40000)) if unicodedata.category(c) == "Cn")
    known = {c: x for spans, x in ((LETTERS, "x"), (NUMBERS, "0")) for s in spans.split() for c in _span(s) if unicodedata.category(chr(c)) == "Cn"}
    return {ord(c): "*" for c in regex.findall(r"[\p{L}\p{N}]", open_)} | known


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class Automaton:
    """DFA over token ids. All arcs of a label lead to one state, so a state is named by that label; START has no label.

    What the gadgets did is kept as facts with times: `cut` has the arcs taken from a state, `left` and `born` say beside
    which arc, and when, a merged label's arcs were added, `right` whose state its own state is a copy of.
    """

    START = (1 << 20) - 1

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        n = 1 + max(vocab.values(), default=0)
        self.left, self.right, self.born = [-1] * n, [-1] * n, [-1] * n
        self.cut: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        # a merge whose halves can never meet makes no arc, and its label no token
        unmade = {vocab[a + b] for a, b in merges}
        for time, (a, b) in enumerate(merges):
            x, y, xy = vocab[a], vocab[b], vocab[a + b]
            if xy in unmade and x not in unmade and y not in unmade and self._has(x, y, time):
                unmade.discard(xy)
                self.cut[x << 20 | y] = time
                self.left[xy], self.right[xy], self.born[xy] = x, y, time
        self.spelt = {(t[: -len(END)] + "\0" if t.endswith(END) and len(t) > len(END) else t): i for t, i in vocab.items() if i not in unmade}
        #: length of the longest token with these first three symbols; without an entry, no token is longer than two
        self.reach: dict[str, int] = {}
        for t in self.spelt:
            if len(t) > 2:
                self.reach[t[:3]] = max(self.reach.get(t[:3], 0), len(t))

    def _has(self, state: int, label: int, time: int) -> bool:
        """Whether the state has an arc with this label at this time."""
        born, cut = self.born, self.cut
        while True:
            s, until = state, time
            while s != self.START:
                if cut.get(s << 20 | label, until + 1) <= until:
                    return False
                if born[s] < 0:
                    break
                until = min(until, born[s] - 1)  # the copy was made before that merge's own cut
                s = self.right[s]
            if born[label] < 0:
                return True
            label, time = self.left[label], born[label]  # ab was added where a was at its time

    def encode(self, word: str) -> list[int]:
        """The one token sequence that the automaton accepts for these symbols, the last marked by a zero character.

        Each prefix has one accepted sequence, so a position that led nowhere is not tried again.
        """
        n, spelt, table, reach = len(word), self.spelt, self.table, self.reach
        if (whole := spelt.get(word)) is not None:
            return [whole]
        dead = bytearray(n + 1)
        path, ends, tried = [], [0], [min(n, reach.get(word[:3], 2))]
        while True:
            i = ends[-1]
            if i == n:
                return path
            state = path[-1] if path else self.START
            for j in range(tried[-1], i, -1):
                t = spelt.get(word[i:j])
                if t is None or dead[j]:
                    continue
                arc = table.get(state << 20 | t)
                if arc is None:
                    arc = table[state << 20 | t] = self._has(state, t, 1 << 60)
                if arc:
                    tried[-1] = j - 1
                    path.append(t)
                    ends.append(j)
                    tried.append(min(n, j + reach.get(word[j : j + 3], 2)))
                    break
            else:
                if not path:
                    raise ValueError(f"no tokens for {word!r}")
                dead[i] = 1
                path.pop()
                ends.pop()
                tried.pop()


class Walk:
    """The automaton's walk over many words at once, as arrays.

    Token spellings and all their ends stand in one hash table, by which the labels that end at a position are found; the
    path found for a word is held against its bytes.
    """

    ARCS = 1 << 20  # places of the transition table; an arc whose place is taken is worked out again
    LONGEST = 64  # bytes of a word that is walked here
    PIECE = 1 << 18  # bytes of words walked at once

    def __init__(self, automaton: Automaton, spelt: dict[bytes, int]):
        self.dfa = automaton
        r = np.random.default_rng(41)
        self.value = r.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
        step = int(r.integers(1, 2**61)) * 8 + 5
        with np.errstate(over="ignore"):
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, U), np.full(self.PIECE + 2 * self.LONGEST, U(x))]), dtype=U) for x in (step, pow(step, -1, 2**64)))
        spelt = {k: v for k, v in spelt.items() if len(k) <= self.LONGEST + 1}
        ends = {k[i:]: -1 for k in spelt for i in range(len(k))} | spelt
        flat = np.frombuffer(b"".join(ends), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(k) for k in ends])])
        keys = np.concatenate([self._hashes(self._sums(flat[a:z]), np.arange(len(k)), np.arange(1, len(k) + 1), whole=k) for k, a, z in self._runs(at)])
        self.bits = int(np.ceil(np.log2(3 * len(ends))))
        self.keys, self.ids = np.zeros(1 << self.bits, U), np.full(1 << self.bits, -1, np.int32)
        for key, t in zip(keys, ends.values(), strict=True):
            at = int(key >> U(64 - self.bits))
            while self.keys[at]:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ids[at] = key, t
        n = 1 + max(spelt.values(), default=0)
        self.length = np.zeros(n, np.int64)
        self.first = np.zeros(n + 1, np.int64)
        for k, t in spelt.items():
            self.length[t] = len(k)
        np.cumsum(self.length, out=self.first[1:])
        by_id = {t: k for k, t in spelt.items()}
        self.bytes = np.frombuffer(b"".join(by_id.get(t, b"") for t in range(n)), np.uint8)
        self.born, self.left, self.right = (np.array(x, np.int64) for x in (automaton.born, automaton.left, automaton.right))
        self.cut_key = np.array(sorted(automaton.cut) or [-1], np.int64)
        self.cut_time = np.array([automaton.cut.get(k, 0) for k in self.cut_key.tolist()], np.int64)
        self.arc_key, self.arc = np.full(self.ARCS, -1, np.int64), np.zeros(self.ARCS, bool)

    def _runs(self, at: np.ndarray):
        """Runs of spellings that fit the powers: (ends within the run, first byte, end byte)."""
        i, n = 0, len(at) - 1
        while i < n:
            z = int(np.searchsorted(at, at[i] + self.PIECE, "right")) - 1
            yield at[i : z + 1] - at[i], int(at[i]), int(at[z])
            i = z

    def _sums(self, data: np.ndarray) -> np.ndarray:
        run = np.zeros(len(data) + 1, U)
        with np.errstate(over="ignore"):
            np.cumsum(self.value[data] * self.up[: len(data)], out=run[1:])
        return run

    def _hashes(self, run: np.ndarray, a: np.ndarray, z: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
        """Hash, never zero, of the bytes from a to z; whole gives all borders of adjoining spans instead."""
        if whole is not None:
            a, z = whole[:-1], whole[1:]
        with np.errstate(over="ignore"):
            return mix((run[z] - run[a]) * self.down[a] + (z - a).astype(U)) | U(1)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a spelling ends so, and the token spelt so (-1: none)."""
        at = (h >> U(64 - self.bits)).astype(np.int64)
        there, ids = np.zeros(len(h), bool), np.full(len(h), -1, np.int32)
        open_ = np.arange(len(h))
        while len(open_):
            key = self.keys[at[open_]]
            hit = key == h[open_]
            there[open_[hit]], ids[open_[hit]] = True, self.ids[at[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
        return there, ids

    def _has(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Transitions of the automaton, read from the table."""
        key = state << 20 | label
        place = (mix(key.astype(U)) >> U(44)).astype(np.int64) & (self.ARCS - 1)
        out, lost = self.arc[place], self.arc_key[place] != key
        if lost.any():
            new, where = np.unique(key[lost], return_inverse=True)
            got = self._worked_out(new >> 20, new & 0xFFFFF)[where]
            out[lost] = got
            self.arc[place[lost]], self.arc_key[place[lost]] = got, key[lost]
        return out

    def _worked_out(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Automaton._has() of many arcs, after all merges: each goes along its state's copies, then to the label beside which its own was added."""
        out = np.zeros(len(state), bool)
        live, at, label, until = np.arange(len(state)), state.copy(), label.copy(), np.full(len(state), 1 << 60)
        while len(live):
            key = at << 20 | label
            place = np.minimum(np.searchsorted(self.cut_key, key), len(self.cut_key) - 1)
            kept = ~((self.cut_key[place] == key) & (self.cut_time[place] <= until))
            live, at, label, until = live[kept], at[kept], label[kept], until[kept]
            whole = self.born[at] < 0
            out[live[whole & (self.born[label] < 0)]] = True
            on = ~(whole & (self.born[label] < 0))
            live, at, label, until, whole = live[on], at[on], label[on], until[on], whole[on]
            until = np.where(whole, self.born[label], np.minimum(until, self.born[at] - 1))
            at, label = np.where(whole, state[live], self.right[at]), np.where(whole, self.left[label], label)
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of at most LONGEST bytes, none of which holds the byte 10, here the mark of a word's end."""
        out: list[bytes] = []
        i = 0
        while i < len(words):
            size, z = 0, i
            while z < len(words) and size <= self.PIECE - self.LONGEST:
                size += len(words[z]) + 1
                z += 1
            out += self._piece(words[i:z])
            i = z
        return out

    def _piece(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"\n".join([*words, b""]), np.uint8)
        n = len(data)
        ends = np.flatnonzero(data == 10) + 1
        starts = np.concatenate([[0], ends[:-1]])
        size = ends - starts
        begin = np.repeat(starts, size)  # of the word at each byte
        run = self._sums(data)
        # labels that end at each position, the longest first
        where, tokens, live = [], [], np.arange(1, n + 1)
        for k in range(1, self.LONGEST + 2):
            live = live[live - k >= begin[live - 1]]
            if not len(live):
                break
            there, ids = self._find(self._hashes(run, live - k, live))
            good = ids >= 0
            where.append(live[good]), tokens.append(ids[good])
            live = live[there]
        where, tokens = np.concatenate(where[::-1]), np.concatenate(tokens[::-1])
        order = np.argsort(where, kind="stable")
        where, tokens = where[order], tokens[order].astype(np.int64)
        first = np.searchsorted(where, np.arange(n + 2))
        last = np.full(n + 1, -1, np.int64)
        words_left = np.argsort(-size, kind="stable")
        counts = size[words_left]
        for j in range(1, int(size.max(initial=0)) + 1):
            here = starts[words_left[: np.searchsorted(-counts, -j, "right")]] + j
            at, stop = first[here], first[here + 1]
            while len(here):
                ok = at < stop
                here, at, stop = here[ok], at[ok], stop[ok]
                if not len(here):
                    break
                t = tokens[at]
                back = here - self.length[t]
                opens = back == begin[here - 1]
                fits = opens | (last[back] >= 0)
                ask = np.flatnonzero(fits & ~opens)
                fits[ask] = self._has(last[back[ask]], t[ask])
                last[here[fits]] = t[fits]
                here, at, stop = here[~fits], at[~fits] + 1, stop[~fits]
        # paths, read from their ends
        n_tokens = np.zeros(len(words), np.int64)
        steps, live, pos = [], np.arange(len(words)), ends.copy()
        while len(live):
            t = last[pos]
            if (t < 0).any():
                raise ValueError("a word has no tokens")
            steps.append((live, t))
            n_tokens[live] += 1
            pos = pos - self.length[t]
            on = pos > starts[live]
            live, pos = live[on], pos[on]
        border = np.concatenate([[0], np.cumsum(n_tokens)])
        flat = np.empty(border[-1], np.int64)
        for k, (which, t) in enumerate(steps):
            flat[border[which + 1] - 1 - k] = t
        spans = self.length[flat]
        inside = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        if not np.array_equal(self.bytes[np.repeat(self.first[flat], spans) + inside], data):
            raise ValueError("two spellings share a hash")
        packed = flat.astype("<u4").tobytes()
        return [packed[4 * a : 4 * z] for a, z in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]


class WordBpe:
    """A tokenizer file with NFC, white space dropped, lower case, byte symbols and word ends; words meet the automaton."""

    #: about how many bytes of chunks and their ids one Python worker remembers; results do not depend on it
    REMEMBER = 128 << 20

    def __init__(self, spec: dict):
        model = spec["model"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]] if spec.get("normalizer") else []
        if kinds != ["NFC", "Replace", "Lowercase"] or model.get("end_of_word_suffix") != END or spec.get("decoder"):
            raise ValueError("this reads word-end BPE files with NFC, white space and lower-case steps, and no decoder")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.automaton = Automaton({k: v for k, v in model["vocab"].items() if k not in self.special}, merges)
        self.byte = byte_symbols()
        of = {c: b for b, c in enumerate(self.byte)} | {"\0": 10}
        self.walk = Walk(self.automaton, {bytes(of[c] for c in k): v for k, v in self.automaton.spelt.items() if all(c in of for c in k) and self.byte[10] not in k})
        self.labels = {v: k for k, v in model["vocab"].items()} | {v: k for k, v in self.special.items()}
        self.small, self.stand_ins = small_letters(), stand_ins()
        self.new = frozenset(map(chr, self.small.keys() | self.stand_ins.keys()))
        self.known: dict[str, bytes] = {}
        self.held = 0

    def plain(self, text: str) -> str:
        """NFC and lower case, which is taken character by character, without the rule for a final sigma."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "\u03a3" in text:
                text = "".join(map(str.lower, text))
            if not self.new.isdisjoint(text):
                text = text.translate(self.small)
        return text.lower()

    def _cut(self, text: str) -> list[str]:
        """Words of a plain text by the pattern, with the library's classes of characters."""
        if text.isascii() or self.new.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def _pieces(self, text: str) -> list[str | int]:
        """Words of a text, and ids of the special tokens in it."""
        out: list[str | int] = []
        at = 0
        for m in [*self.cut.finditer(text), None] if "<|" in text else [None]:
            out += self._cut(self.plain(text[at : m.start() if m else len(text)]))
            if m:
                out.append(self.special[m[0]])
                at = m.end()
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Packed ids of chunks without a space, in which a word is walked once."""
        if not chunks:
            return
        one, several = {}, {}  # chunks that are one word, and the pieces of the others
        # what stands between line breaks is made plain by itself, so all chunks go at once
        for c, low in zip(chunks, self.plain("\n".join(chunks)).split("\n"), strict=True):
            if low.isalpha():
                one[c] = low
            elif low[-1:] in (",", ".") and low[:-1].isalpha() and c.isascii():
                several[c] = (low[:-1], low[-1])
            elif c:
                several[c] = self._pieces(c)
        new = list({*one.values(), *(w for p in several.values() for w in p if not isinstance(w, int))})
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        short = [len(r) <= Walk.LONGEST and 10 not in r for r in raw]
        ids = dict(zip(compress(new, short), self.walk.words(list(compress(raw, short))), strict=True))
        for w, r in zip(new, raw, strict=True) if len(ids) < len(new) else ():
            if w not in ids:
                ids[w] = np.array(self.automaton.encode("".join([self.byte[b] for b in r]) + "\0"), "<u4").tobytes()
        before, known = len(self.known), self.known
        known[""] = b""
        known.update(zip(one, map(ids.__getitem__, one.values()), strict=True))
        for c, p in several.items():
            known[c] = b"".join([struct.pack("<I", w) if isinstance(w, int) else ids[w] for w in p])
        self.held += 250 * (len(known) - before) + 4 * sum(map(len, chunks))

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a chunk between spaces is walked where it is new."""
        if self.held > self.REMEMBER:
            self.known, self.held = {}, 0
        chunks = [(t or "").replace("\n", " ").split(" ") for t in texts]
        found = [list(map(self.known.get, c)) for c in chunks]
        gaps = [i for i, f in enumerate(found) if None in f]
        self._learn(list({c for i in gaps for c, got in zip(chunks[i], found[i], strict=True) if got is None}))
        for i in gaps:
            found[i] = map(self.known.__getitem__, chunks[i])
        return [b"".join(f) for f in found]

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], "<u4").tolist()

    def labels_of(self, ids: Iterable[int]) -> str:
        """Arc labels one after another, with a space between tokens, as a tokenizer file without a decoder joins them."""
        return " ".join(map(self.labels.__getitem__, ids))

    def decoded(self, packed: bytes) -> str:
        return self.labels_of(memoryview(packed).cast("I"))


_LOADED: dict[int, WordBpe] = {}


def _loaded(shared) -> WordBpe:
    """One compiled automaton a Python worker."""
    key = hash(shared.value)
    if key not in _LOADED:
        _LOADED[key] = WordBpe(json.loads(shared.value))
    return _LOADED[key]


def _mapped(docs: DataFrame, vocabulary: str, make, schema: str) -> DataFrame:
    """make(bpe, packed ids of each text) gives the columns after doc_id. The file, of fixed size, goes by broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared)
        for x in batches:
            for a, z in slices(x.column(1)):
                b = x.slice(a, z - a)
                yield pa.record_batch({"doc_id": b.column(0)} | make(bpe, bpe.packed(b.column(1).to_pylist())))

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, f"doc_id long, {schema}")


def _ids(packed: list[bytes]) -> pa.Array:
    flat = np.frombuffer(b"".join(packed), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p) // 4 for p in packed)]), pa.int32()), pa.array(flat))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, decoded for each row.

    vocabulary is the path of a tokenizer file on the driver. A null or empty text has no ids; null doc_ids, repeated
    rows and empty tables pass through; other columns are ignored. Whole texts are encoded, of any length; a task holds
    about a megabyte of texts, or one text, at a time.
    """
    return _mapped(docs, vocabulary, lambda bpe, p: {"ids": _ids(p), "decoded": pa.array([bpe.decoded(x) for x in p], pa.string())}, "ids array<int>, decoded string")


def _hex(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode("utf-8", "surrogatepass")).hexdigest()


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256; rows as encode() has them, with the same rules."""

    def make(bpe: WordBpe, p: list[bytes]) -> dict:
        return {"n_tokens": pa.array([len(x) // 4 for x in p], pa.int64()), "ids": _ids(p), "decoded_sha256": pa.array([_hex(bpe.decoded(x)) for x in p], pa.string())}

    return _mapped(docs, vocabulary, make, "n_tokens long, ids array<int>, decoded_sha256 string")


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encode() gives, by its rules, digested where it is made."""

    def make(bpe: WordBpe, p: list[bytes]) -> dict:
        return {"n_tokens": pa.array([len(x) // 4 for x in p], pa.int64()), "ids_sha256": pa.array(map(_hex, p), pa.string()), "decoded_sha256": pa.array([_hex(bpe.decoded(x)) for x in p], pa.string())}

    return _mapped(docs, vocabulary, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
