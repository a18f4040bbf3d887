"""Benchmark decontamination by latent semantic retrieval, longest common subsequences and answer words.

One pass over all documents counts document frequencies of hashed words and sketches the term matrix of passages: every
passage of 32 words (the widest window) is added with a random sign to one of 32 rows (a count sketch, fixed size, summed over partitions).
Scaling columns by IDF afterwards and taking the singular value decomposition of the sketch with the benchmark items beneath
it gives the latent basis: a randomised SVD of the TF-IDF passages. A second pass projects windows of every document by running
sums, and windows whose latent cosine with an item reaches ``cosine`` are candidates. In the same task candidates are checked
word by word: the longest common subsequence must cover ``share`` of the item, and at least half of the item's answer words
(the rarer half of its words, or those of an answer column) must stand in the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import SLICES, U64, ByteHash, array_slices, as_bytes, map_arrow, mix, once, release, sum_arrays, word_hashes

BITS, ROWS, ITEM_ROWS = 16, 32, 64
SIZE = 1 << BITS


def words_of(h: ByteHash, text: bytes) -> np.ndarray:
    return word_hashes(h, np.frombuffer(text, np.uint8))[2]


def _features(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - BITS)).astype(np.int64)


def _counts(window: int):
    """The sketch, then the document frequencies and the number of documents, in slices of one row of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, total, last = ByteHash(lower=True), np.zeros((ROWS + 2) * SIZE, np.float32), np.zeros(SIZE, np.int64)
        sketch, df = total[: ROWS * SIZE], total[ROWS * SIZE : -SIZE]
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")), strict=True):
                f = _features(words_of(h, text))
                total[-1] += 1
                if not len(f):
                    continue
                df[once(last, f)] += 1
                code = mix(np.arange(-(-len(f) // window), dtype=np.uint64) + U64((doc or 0) % 2**64))
                row, sign = ((code >> U64(8)) % U64(ROWS)).astype(np.int64) * SIZE, np.where(code & U64(1), np.float32(1), np.float32(-1))
                np.add.at(sketch, np.repeat(row, window)[: len(f)] + f, np.repeat(sign, window)[: len(f)])
        yield from array_slices(total, ROWS + 2)

    return run


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    place: dict = {}
    for i, x in enumerate(a):
        place[x] = place.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & place.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _norm(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


class Items:
    """The benchmark in word hashes, with its latent vectors. Its matrices have a fixed size, however many items there are."""

    def __init__(self, ids: list[int], texts: list[str], answers: list[str | None], idf: np.ndarray, sketch: np.ndarray, rank: int):
        h = ByteHash(lower=True)
        keep = [(i, w, a) for i, t, a in zip(ids, texts, answers, strict=True) if len(w := words_of(h, (t or "").encode()))]
        self.ids, self.words = [i for i, _, _ in keep], [w for _, w, _ in keep]
        # beneath the sketch of the passages a sketch of the items: rows of random sign, each of length 1 before they are added
        idf, rng = idf.astype(np.float32), np.random.default_rng(3)
        matrix = np.zeros((ROWS + ITEM_ROWS, SIZE), np.float32)
        np.multiply(sketch, idf, out=matrix[:ROWS])
        for r, sign, w in zip(rng.permutation(np.arange(len(keep)) % ITEM_ROWS), rng.choice([-1, 1], len(keep)), self.words, strict=True):
            f, n = np.unique(_features(w), return_counts=True)
            x = n * idf[f]
            matrix[ROWS + r, f] += sign * x / np.linalg.norm(x)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
        # right singular vectors through the small Gram matrix
        values, left = np.linalg.eigh((matrix @ matrix.T).astype(np.float64))
        top = [k for k in np.argsort(-values, kind="stable")[:rank] if values[k] > 1e-6]
        self.basis = matrix.T @ (left[:, top] / np.sqrt(values[top])).astype(np.float32)
        del matrix
        self.basis *= idf[:, None]
        self.latent = _norm(np.stack([self.basis[_features(w)].sum(0) for w in self.words])) if keep else np.zeros((0, len(top)), np.float32)
        self.answers = []
        for _, w, a in keep:
            own = np.unique(words_of(h, a.encode())).tolist() if a else []
            rare = sorted(set(w.tolist()), key=lambda x: (-idf[x >> (64 - BITS)], x))[: max(2, len(w) // 2)]
            self.answers.append(frozenset(own or rare))
        pairs = sorted((x, i) for i, a in enumerate(self.answers) for x in a)
        self.answer_word, self.answer_item = np.array([x for x, _ in pairs], np.uint64), np.array([i for _, i in pairs], np.int64)
        self.answer_need = np.array([-(-len(a) // 2) for a in self.answers], np.int64)
        self.answer_here = np.zeros(SIZE, bool)
        self.answer_here[_features(self.answer_word)] = True

    def possible(self, words: np.ndarray) -> np.ndarray:
        """Items at least half of whose answer words are in a document at all."""
        words = np.unique(words[self.answer_here[_features(words)]])
        low = np.searchsorted(self.answer_word, words, "left")
        n = np.searchsorted(self.answer_word, words, "right") - low
        have = self.answer_item[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return np.flatnonzero(np.bincount(have, minlength=len(self.ids)) >= self.answer_need)

    def check(self, i: int, seen: list[int], share: float) -> int:
        """Words of item i in order in a stretch of words, or 0 if too few words or answer words are there at all."""
        own, here = self.words[i].tolist(), set(seen)
        if len(self.answers[i] & here) * 2 < len(self.answers[i]) or sum(x in here for x in own) < share * len(own):
            return 0
        return lcs(own, seen)


def _hits(items: Items, windows: tuple[int, ...], stride: int, cosine: float, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = ByteHash(lower=True)
        basis, latent = items.basis, items.latent
        for b in batches:
            out = [[], [], [], [], [], []]
            for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")), strict=True):
                words = words_of(h, text)
                n = len(words)
                can = items.possible(words) if n else ()
                if not len(can):
                    continue  # the last check would fail
                best: dict = {}
                for base in range(0, n, 20_000):  # a long text in stretches that overlap by a window
                    part = words[base : base + 20_000 + max(windows)]
                    run_sum = np.zeros((len(part) + 1, basis.shape[1]), np.float32)
                    np.cumsum(basis[_features(part)], axis=0, out=run_sum[1:])
                    for size in windows:
                        first = np.arange(0, max(1, len(part) - size + stride), stride)
                        last = np.minimum(first + size, len(part))
                        z = run_sum[last] - run_sum[first]
                        near = z @ latent[can].T >= cosine * np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
                        for w, i in zip(*np.nonzero(near), strict=True):
                            i = int(can[i])
                            own = items.words[i]
                            a, e = max(0, base + int(first[w]) - len(own)), base + int(last[w]) + len(own)
                            if (i, a, e) not in best:
                                best[i, a, e] = items.check(i, words[a:e].tolist(), share)
                found: dict = {}
                for (i, a, _), m in best.items():
                    if m >= share * len(items.words[i]):
                        found[i] = max(found.get(i, (0, 0)), (m, -a))
                for i, (m, a) in sorted(found.items()):
                    for col, v in zip(out, (doc, items.ids[i], m, len(items.words[i]), m / len(items.words[i]), -a), strict=True):
                        col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "item_id", "common", "item_words", "coverage", "near_word"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", answer_col: str | None = None, windows: tuple[int, ...] = (16, 32), stride: int = 8, rank: int = 96, cosine: float = 0.55, share: float = 0.6, most_items: int = 100_000) -> DataFrame:
    """(doc_id, item_id, common, item_words, coverage, near_word): the items that a document holds, one row for each pair.

    A benchmark is small and fixed; more than most_items rows are refused. Null and wordless texts hold nothing and wordless items
    are nowhere. An item row repeated in the benchmark is reported each time; a repeated document likewise. A null doc_id is
    reported as null. near_word: where the stretch that holds the item begins, in words. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer")).limit(most_items + 1).collect()
    if len(rows) > most_items:
        raise ValueError(f"more than {most_items} benchmark items")
    total = sum_arrays(map_arrow(docs, _counts(max(windows)), SLICES), (ROWS + 2) * SIZE, ROWS + 2, np.float32)
    seen = total[-2 * SIZE : -SIZE].astype(np.float64)
    idf = np.maximum(np.log((1 + total[-1]) / (1 + seen)), 0) ** 1.5 + 1e-3  # sharpened, so that rare words lead
    rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"] or ""))
    items = Items([r["item_id"] for r in rows], [r["text"] for r in rows], [r["answer"] for r in rows], idf, total[: ROWS * SIZE].reshape(ROWS, SIZE), rank)
    del total
    release()
    return map_arrow(docs, _hits(items, windows, stride, cosine, share), "doc_id long, item_id long, common int, item_words int, coverage double, near_word long")
