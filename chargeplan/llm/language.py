"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, what is not a letter becomes a space, and n-grams of 1 to 3 characters are hashed into 2**15 counters.
Document frequencies come from all rows that may be learnt from (a language, not held out), a fixed-size array summed by partition. The model is fitted by
follow-the-regularised-leader (per-coordinate, elastic net) on a bounded sample, about ``sample`` documents a language chosen
by a hash of the id, and a temperature is fitted on a fifth of that sample that training did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import SLICES, array_slices, cut, held_out, keep_ids, map_arrow, sum_arrays

BITS = 15
SIZE = 1 << BITS


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams, or None without a letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return None
    c = np.where(letter, c, np.uint32(32))
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    c = np.concatenate(([np.uint32(32)], c, [np.uint32(32)])).astype(np.uint32)
    out, key = [], c * np.uint32(0x9E3779B1)
    for n in range(1, 4):
        if n > 1:
            if len(c) < n:
                break
            key = (key[:-1] ^ (key[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[n - 1 :] * np.uint32(0xC2B2AE35)
        out.append(((key ^ (key >> np.uint32(13))) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS))
    return np.bincount(np.concatenate(out), minlength=SIZE)


def _frequencies():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1)
        for b in batches:
            for text in b.column("text"):
                c = ngram_counts(text.as_py())
                if c is not None:
                    total[np.flatnonzero(c)] += 1
                    total[SIZE] += 1
        yield from array_slices(total, 16)

    return run


def _sampled():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n, lang = [], [], []
            for text, name in zip(b.column("text"), b.column("lang").to_pylist(), strict=True):
                c = ngram_counts(text.as_py())
                if c is not None:
                    i = np.flatnonzero(c)
                    at.append(i.astype(np.uint16).tobytes())
                    n.append(c[i].astype(np.uint32).tobytes())
                    lang.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["lang", "at", "n"])

    return run


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader for a softmax over classes, with L1 and L2 penalties, per-coordinate rates."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def step(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the margins with the least log loss, by golden section on its logarithm."""
    loss = lambda t: -np.log(np.maximum(softmax(margins / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    lo, hi, r = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _unit(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[at]
    return x / (np.sqrt((x * x).sum()) or 1.0)


def fit_language(docs: DataFrame, sample: int = 800, epochs: int = 3) -> tuple[list[str], np.ndarray, np.ndarray, float] | None:
    """(languages, idf, weights, temperature) from rows (doc_id, text, lang); None without a usable row."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    total = sum_arrays(map_arrow(learn.select("text"), _frequencies(), SLICES), SIZE + 1)
    idf = np.log((1 + total[SIZE]) / (1 + total[:SIZE])) + 1
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, sample / n)).otherwise(share)
    ids = cut(learn.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < share * (1 << 20)).select("doc_id").distinct(), "sample")
    rows = map_arrow(keep_ids(learn, ids).select("text", "lang"), _sampled(), "lang string, at binary, n binary").collect()
    names = sorted({r["lang"] for r in rows})
    if not names:
        return None
    data = []
    for r in sorted(rows, key=lambda r: (r["at"], r["n"], r["lang"])):
        at = np.frombuffer(r["at"], np.uint16).astype(np.int64)
        data.append((at, _unit(at, np.frombuffer(r["n"], np.uint32), idf), names.index(r["lang"])))
    order = np.random.default_rng(1).permutation(len(data))
    kept, seen = (order[: len(data) // 5], order[len(data) // 5 :]) if len(data) >= 50 else (order, order)
    model = Ftrl(SIZE, len(names))
    for _ in range(epochs):
        for i in seen:
            model.step(*data[i])
    w = model.weights()
    t = temperature(np.stack([data[i][1] @ w[data[i][0]] for i in kept]), np.array([data[i][2] for i in kept])) if len(names) > 1 else 1.0
    return names, idf, w, t


def _predicted(names, idf, w, t, carry=()):
    w = (w / t).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = [], []
            for text in b.column("text"):
                c = ngram_counts(text.as_py())
                if c is None or not names:
                    lang.append("und")
                    score.append(0.0)
                    continue
                at = np.flatnonzero(c)
                p = softmax((_unit(at, c[at], idf).astype(np.float32) @ w[at]).astype(np.float64))
                lang.append(names[int(p.argmax())])
                score.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), *[b.column(c) for c in carry]], ["doc_id", "held_out", "lang_pred", "score", *carry])

    return run


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 800, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score[, carried columns]), one row per row of docs; rows with crc32(id) % 5 = 0 are held out of the fit.

    ``und`` with score 0 where the text is null or has no letter, or where no labelled row could be learnt from. A null id is
    never held out nor learnt from. Repeated rows are predicted each. Ties go to the first language by name.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), *carry)
    docs = docs.withColumn("held_out", held_out("doc_id", 5, 0))
    model = fit_language(docs.withColumn("lang", F.when(~F.col("held_out"), F.col("lang"))), sample)
    names, idf, w, t = model or ([], np.ones(SIZE), np.zeros((SIZE, 0)), 1.0)
    kinds = "doc_id long, held_out boolean, lang_pred string, score double" + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return map_arrow(docs.select("doc_id", "held_out", "text", *carry), _predicted(names, idf, w, t, carry), kinds)
