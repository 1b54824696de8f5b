"""SentencePiece BPE by a table of distinct chunks, for models whose pieces do not cross white-space markers.

A text becomes markers and what stands between them: one marker before all, and one for each space. No piece has a marker
behind another character, so no merge reaches over such a border and a chunk (markers, then the characters up to the next
marker) is segmented by itself, whatever its text. Each distinct chunk is segmented once and its ids are joined back by
position:

1. Tasks list the chunks of their blocks of texts, frequent ones meet by chunk, and each is segmented once. They are the
   head of the table, of bounded size, which goes to all tasks.
2. A task numbers the chunks of a block, so that each position has the number of its chunk. The block's own table has a row
   a distinct chunk: ids from the head or, where that lacks it, segmented there, once a block. Numbers are replaced by ids.

A chunk that is rare in all blocks is thus segmented once in each block that has it. A table of all chunks is too large
for a task, and to send numbers of all texts to meet it by shuffles moves some three times the input.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import done, saved
from .textkernel import mix, slices, span_hashes, text_bytes

MARK = "▁"
#: bytes of text in a block, one text at least, where texts are encoded and where chunks are counted
BLOCK, COUNTED = 1 << 22, 1 << 24
#: distinct chunks of the head
HEAD = 1 << 20
#: longest chunk of the head, in bytes
SHORT = 64
LOST = "�"


@dataclass
class Model:
    """Pieces of a model: what merges make, what bytes fall back to, and what each id spells."""

    rank: dict[str, float]
    ids: dict[str, int]
    bytes_: list[int]
    begin: int
    end: int
    spelt: list[bytes]
    is_byte: np.ndarray
    is_control: np.ndarray

    def __post_init__(self) -> None:
        self.letters, self.letter_at = np.frombuffer(b"".join(self.spelt), np.uint8), np.cumsum([0, *map(len, self.spelt)])

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk: the adjacent pair whose piece has the highest score is merged, the first of equal ones, again and again."""
        rank, n = self.rank, len(text)
        part, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-rank[p], i, p) for i in range(n - 1) if (p := text[i : i + 2]) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, made = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or part[i] + part[j] != made:
                continue  # one of the two is part of something else by now
            part[i], part[j] = made, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := made + part[k]) in rank:
                    heapq.heappush(heap, (-rank[p], i, p))
            if (h := before[i]) >= 0 and (p := part[h] + made) in rank:
                heapq.heappush(heap, (-rank[p], h, p))
        out: list[int] = []
        for p in part:
            if p is not None:
                own = self.ids.get(p)
                out += [own] if own is not None else [self.bytes_[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    def framed(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([[self.begin], ids, [self.end]])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of ids: begin and end say nothing, the first piece loses its marker, bytes that are no text become U+FFFD."""
        said = np.flatnonzero(~self.is_control[ids])
        if not len(said):
            return b""
        ids = ids[said[0] : said[-1] + 1]
        if len(ids) > len(said):  # an id within parts the bytes around it
            return self._mended(ids).encode()
        raw = _spread(ids, self.letters, self.letter_at).tobytes()
        if not self.is_byte[ids[0]] and raw[:1] == b" ":
            raw = raw[1:]
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return self._mended(ids).encode()

    def _mended(self, ids: np.ndarray) -> str:
        """Each byte that begins no character becomes a U+FFFD of its own."""
        out, run = [], bytearray()

        def spell() -> None:
            at = 0
            while at < len(run):
                for k in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + k].decode())
                        at += k
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append(LOST)
                    at += 1
            run.clear()

        for n, i in enumerate(ids.tolist()):
            if self.is_byte[i]:
                run += self.spelt[i]
            else:
                spell()
                text = self.spelt[i].decode()
                out.append(text[1:] if n == 0 and text[:1] == " " else text)
        spell()
        return "".join(out)


def load(path: str) -> Model:
    """Reads a model file; raises where the method does not hold for it: other kinds than BPE with byte fallback, pieces
    across a marker, texts that are changed otherwise than by markers, or pieces that are given by the user."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    is_byte, control = np.array([sp.is_byte(i) for i in range(n)]), np.array([sp.is_control(i) for i in range(n)])
    plain = [i for i in range(n) if not (is_byte[i] or control[i] or sp.is_unknown(i) or sp.is_unused(i))]
    probe = " a  \tb ﬁ Ⅷ "
    if sp.normalize(probe) != (MARK + probe).replace(" ", MARK) or is_byte.sum() != 256:
        raise ValueError(f"{path}: texts are not kept as they are, or bytes have no pieces")
    if any(MARK in names[i].lstrip(MARK) for i in plain):
        raise ValueError(f"{path}: a piece crosses a white-space marker")
    spelt = [b""] * n
    for i in plain:
        spelt[i] = names[i].replace(MARK, " ").encode()
    of_byte = [0] * 256
    for i in np.flatnonzero(is_byte).tolist():
        of_byte[int(names[i][3:5], 16)] = i
        spelt[i] = bytes([int(names[i][3:5], 16)])
    model = Model({names[i]: sp.get_score(i) for i in plain}, {names[i]: i for i in plain}, of_byte, sp.bos_id(), sp.eos_id(), spelt, is_byte, control)
    for text in ("hello  world 世\U0001f389", "<s> the</s>"):
        if [i for c in chunks(text) for i in model.chunk(c.replace(" ", MARK))] != sp.encode(text):
            raise ValueError(f"{path}: not a BPE model")
    return model


def chunks(text: str) -> list[str]:
    """Markers (as spaces) and what follows them, in order; an empty text has none."""
    if not text:
        return []
    raw = np.frombuffer(_plain(text).encode("utf-8", "surrogatepass"), np.uint8)
    at = _borders(raw, np.zeros(0, np.int64))
    return [bytes(raw[a:z]).decode("utf-8", "surrogatepass") for a, z in zip(at, np.append(at[1:], len(raw)), strict=True)]


def _plain(text: str) -> str:
    return " " + text.replace(MARK, " ")


def _borders(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where chunks begin: at a space behind something else, and where a text begins."""
    space = raw == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[texts] = True
    return np.flatnonzero(first)


# --- the head of the table ---


@dataclass
class Head:
    """Frequent chunks with their ids, found by hash and held against their bytes; chunk number c has ids[at[c]:at[c + 1]]."""

    text: pa.Array
    ids: np.ndarray
    at: np.ndarray
    order: np.ndarray
    hashes: np.ndarray

    @staticmethod
    def of(text: pa.ChunkedArray, ids: pa.ChunkedArray) -> Head:
        """From distinct chunks, numbered as they come, and their packed ids."""
        text = text.cast(pa.large_string()).combine_chunks()
        packed = ids.to_pylist()
        hashes = _hashes(text)
        order = np.argsort(hashes, kind="stable")
        return Head(text, np.frombuffer(b"".join(packed), "<u4"), np.cumsum([0, *(len(p) // 4 for p in packed)]), order, hashes[order])

    def __len__(self) -> int:
        return len(self.text)

    def find(self, words: pa.Array) -> np.ndarray:
        """Number of each chunk, -1 where the head lacks it."""
        if not len(self) or not len(words):
            return np.full(len(words), -1, np.int64)
        h = _hashes(words)
        i = np.minimum(np.searchsorted(self.hashes, h), len(self) - 1)
        like, number = self.hashes[i] == h, self.order[i]
        like[like] = pc.equal(words.filter(pa.array(like)), self.text.take(pa.array(number[like]))).to_numpy(zero_copy_only=False)
        return np.where(like, number, -1)


def _hashes(text: pa.Array) -> np.ndarray:
    raw, offs = text_bytes(text)
    return mix(span_hashes(raw, offs[:-1], offs[1:]))


# --- texts as numbers ---


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For the texts of a column: codes of their chunks one after another, the distinct chunks, and where texts begin (n + 1)."""
    texts = [_plain(t) if t else "" for t in column.to_pylist()]
    raw, offs = text_bytes(pa.array(texts, pa.large_string()))
    begin = _borders(raw, offs[:-1][np.diff(offs) > 0])
    ends = np.append(begin, len(raw)).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(raw))
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), data).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, np.searchsorted(begin, offs, "left")


def _spread(codes: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of each code one after another; code c has ids[at[c]:at[c + 1]]."""
    size = at[codes + 1] - at[codes]
    end = np.cumsum(size)
    return ids[np.repeat(at[codes] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


Finish = Callable[[Model, list[np.ndarray]], dict]


def head_of(docs: DataFrame, model, size: int) -> Head:
    """The most frequent chunks, `size` at most and no long ones, segmented once each.

    Tasks count the chunks of a block and hand on those that occur in it more than once; the head only says which chunks
    are looked up at once, so it need not be exact. What comes to the driver is bounded by size and SHORT.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, 0, COUNTED):
            codes, words, _ = _coded(b.column(0))
            n = np.bincount(codes, minlength=len(words))
            often = (n > 1) & (pc.binary_length(words).to_numpy(zero_copy_only=False) <= SHORT)
            yield pa.record_batch({"chunk": words.filter(pa.array(often)).cast(pa.string()), "n": pa.array(n[often].astype(np.int64))})

    found = saved(docs.select("text").mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n")), "pieces-counts")
    by_size = found.groupBy(F.floor(F.log2("n") * 8).alias("k")).agg(F.count("*").alias("n"), F.min("n").alias("least")).orderBy(F.desc("k")).collect()  # 64 x 8 rows at most
    cutoff, room = None, size
    for r in by_size:
        room -= r["n"]
        if room < 0:
            break
        cutoff = r["least"]
    if cutoff is None:
        return Head.of(pa.chunked_array([], pa.string()), pa.chunked_array([], pa.binary()))
    rows = _segmented(found.where(F.col("n") >= cutoff), model).toArrow()
    done(found)
    return Head.of(rows["chunk"], rows["ids"])


def _blocks(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches made anew with about so many bytes of text, one text at least."""
    held, size = [], 0
    for b in batches:
        for a, z in slices(b.column(text), most):
            part = b.slice(a, z - a)
            more = int(pc.sum(pc.binary_length(part.column(text))).as_py() or 0)
            if held and size + more > most:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _segmented(rows: DataFrame, model) -> DataFrame:
    """Adds ids (packed) to rows (chunk, n) of distinct chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            packed = [np.array(m.chunk(t.replace(" ", MARK)), "<u4").tobytes() for t in b.column(0).to_pylist()]
            yield pa.record_batch({"chunk": b.column(0), "n": b.column(1), "ids": pa.array(packed, pa.binary())})

    return rows.mapInArrow(run, "chunk string, n long, ids binary")


def _mapped(docs: DataFrame, path: str, finish: Finish, schema: str, head: int) -> DataFrame:
    """finish(model, ids of each text) gives the columns after doc_id."""
    share = docs.sparkSession.sparkContext.broadcast
    model = share(load(path))
    top = share(head_of(docs, model, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, h = model.value, top.value
        for b in _blocks(batches, 1, BLOCK):
            codes, words, at = _coded(b.column(1))
            number = h.find(words)
            known, other = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
            packed = [m.chunk(t.replace(" ", MARK)) for t in words.take(pa.array(other)).to_pylist()]
            # the block's own table, the head's chunks first
            ids = np.concatenate([_spread(number[known], h.ids, h.at), np.fromiter((i for p in packed for i in p), "<u4")])
            ends = np.cumsum(np.concatenate([[0], (h.at[1:] - h.at[:-1])[number[known]], np.array([len(p) for p in packed], np.int64)]).astype(np.int64))
            place = np.empty(len(words), np.int64)
            place[np.concatenate([known, other])] = np.arange(len(words))
            codes = place[codes]
            yield pa.record_batch({"doc_id": b.column(0)} | finish(m, [m.framed(_spread(codes[i:j], ids, ends)) for i, j in zip(at[:-1], at[1:], strict=True)]))

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, f"doc_id long, {schema}")


def encode(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """doc_id, ids, decoded for each row.

    path is that of a model file on the driver. Ids have the begin and the end id around them, so a null or empty text has
    these two; null doc_ids, repeated rows and empty tables pass through, other columns are ignored. Whole texts are
    encoded, of any length: a task holds a block of about 4 MB of texts, or one text, at a time.
    """

    def finish(m: Model, ids: list[np.ndarray]) -> dict:
        at = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(at, pa.array(flat)), "decoded": pa.array([m.decode(i).decode() for i in ids], pa.string())}

    return _mapped(docs, path, finish, "ids array<int>, decoded string", head)


def token_digests(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encode() gives, by its rules, digested where it is made."""

    def finish(m: Model, ids: list[np.ndarray]) -> dict:
        digest = lambda data: hashlib.sha256(data).hexdigest()
        return {"n_tokens": pa.array([len(i) for i in ids], pa.int64()), "ids_sha256": pa.array([digest(i.astype("<u4").tobytes()) for i in ids], pa.string()), "decoded_sha256": pa.array([digest(m.decode(i)) for i in ids], pa.string())}

    return _mapped(docs, path, finish, "n_tokens long, ids_sha256 string, decoded_sha256 string", head)
