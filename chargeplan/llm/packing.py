"""Shortest-pack-first packing over the length histogram.

Documents are tokenised once; one longer than a sequence is cut into full sequences and a rest. The histogram of piece lengths
has at most ``size`` bins, so packing works on counts alone: lengths are placed longest first, each onto the packs with the
smallest fill that it fits, and packs of equal fill and past are one entry with a count and a run of sequence numbers. What
comes out is intervals (length, ranks lo..hi) -> (first sequence, offset). Pieces are ranked within their length and find
their place by rank; nothing but the histogram reaches the driver.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import ByteHash, as_bytes, cut, gapless_rank, map_arrow, span_hashes, word_spans

_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def chunk_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands between spaces; one full stop or comma between a letter (ASCII, or of U+00C0-00FF) and a space stands alone."""
    start, end = word_spans(buf)
    cut = np.flatnonzero((end - start > 1) & ((buf[end - 1] == 0x2E) | (buf[end - 1] == 0x2C)))
    last = buf[end[cut] - 2]
    wide = (end[cut] - start[cut] > 2) & (buf[end[cut] - 3] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    cut = cut[_ASCII_LETTER[last] | wide]
    at = end[cut] - 1
    end = end.copy()
    end[cut] -= 1
    return np.insert(start, cut + 1, at), np.insert(end, cut + 1, at + 1)


class ChunkTokens:
    """Ids of texts by a tokenizer whose pre-tokens never hold white space: what stands between spaces is tokenised once.

    The table is three arrays: sorted 64-bit hashes of the chunks (A-Z as a-z), and where their ids start and end. It is
    looked up for a whole batch of texts at once; only new chunks become Python strings.
    """

    def __init__(self, path: str, keep: int = 3_000_000):
        from tokenizers import Tokenizer

        self.t, self.keep, self.h = Tokenizer.from_file(path), keep, ByteHash(lower=True)
        self.t.encode_special_tokens = True
        self.letters, self.model = _byte_letters(), self.t.model
        self._empty()

    def forget(self) -> None:
        """What a partition has learnt goes with it, so that an idle worker holds the vocabulary only."""
        self._empty()

    def _empty(self) -> None:
        self.known, self.first, self.last = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.n = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        of, letters, got, hard = self.model.tokenize, self.letters, [], []
        for i, c in enumerate(chunks):
            x = c.decode("utf-8", "replace").lower()
            if _PLAIN.fullmatch(x):
                got.append([y.id for y in of(x if x.isascii() else "".join([letters[b] for b in x.encode()]))])
            else:
                got.append(None)
                hard.append(i)
        if hard:
            for i, e in zip(hard, self.t.encode_batch_fast([chunks[i].decode("utf-8", "replace") for i in hard], add_special_tokens=False), strict=True):
                got[i] = e.ids
        count = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.uint32, int(count.sum()))
        while self.n + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.n : self.n + len(ids)] = ids
        last = self.n + np.cumsum(count)
        self.n += len(ids)
        at = np.searchsorted(self.known, hashes)
        self.known, self.first, self.last = np.insert(self.known, at, hashes), np.insert(self.first, at, last - count), np.insert(self.last, at, last)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        edge = np.cumsum([0] + [len(x) + 1 for x in texts])
        buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        start, end = chunk_spans(buf)
        hashes = span_hashes(self.h, buf, start, end)
        some, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(some) > self.keep:
            self._empty()
        at = np.searchsorted(self.known, some)
        new = np.ones(len(some), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != some
        if new.any():
            raw, where = buf.tobytes(), first[new]
            self._learn(some[new], [raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)])
            at = np.searchsorted(self.known, some)
        lo, n = self.first[at][back], (self.last[at] - self.first[at])[back]
        upto = np.concatenate(([0], np.cumsum(n)))
        ids = self.ids[np.arange(upto[-1]) + np.repeat(lo - upto[:-1], n)]
        cuts = upto[np.searchsorted(start, edge)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_of_process: dict[str, ChunkTokens] = {}


def chunk_tokens(path: str) -> ChunkTokens:
    """One tokenizer for each worker process, kept from task to task."""
    if path not in _of_process:
        _of_process[path] = ChunkTokens(path)
    return _of_process[path]


def _by_bytes(docs: Iterator[tuple[int | None, bytes]], most: int = 1 << 20) -> Iterator[list[tuple[int | None, bytes]]]:
    some, size = [], 0
    for doc in docs:
        some.append(doc)
        size += len(doc[1])
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_tokens(path)
        for b in batches:
            for some in _by_bytes(zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")), strict=True)):
                out = [[], [], [], [], []]
                for (doc, _), ids in zip(some, table.encode([x for _, x in some]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        for col, v in zip(out, (doc, start, len(piece), zlib.crc32(piece), len(ids)), strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        table.forget()

    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """([(length, lo, hi, first sequence, offset)], sequences): pieces of rank lo..hi-1 of a length go to consecutive sequences."""
    packs: list[tuple[int, int, int]] = []  # (fill, first sequence, count): a heap, least filled first
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= size:
                fill, first, count = heapq.heappop(packs)
                take = min(left, count)
                if take < count:
                    heapq.heappush(packs, (fill, first + take, count - take))
            else:
                fill, first, take = 0, sequences, left
                sequences += take
            out.append((length, rank, rank + take, first, fill))
            if fill + length < size:
                heapq.heappush(packs, (fill + length, first, take))
            rank, left = rank + take, left - take
    return out, sequences


def _placed(plan: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(plan), np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table[:, 0] * (1 << 48) + table[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, length * (1 << 48) + rank, "right") - 1
            seq = table[at, 3] + rank - table[at, 1]
            cols = [b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(table[at, 4])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    A null or empty text has the end id alone. Repeated rows are packed each. An empty table packs nothing; null ids pass
    through. Other columns are not read. tokenizer: path of the vocabulary, on every machine.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = cut(map_arrow(docs, _pieces(tokenizer, size, end_id), _PIECES), "pieces")
    histogram = {r["length"]: r["c"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}
    plan, _ = shortest_pack_first(histogram, size)
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "start"], "rank", "doc_id", sum(histogram.values()))
    return map_arrow(ranked, _placed(plan), _PIECES + ", sequence_id long, offset long")
