"""Toxicity by non-negative positive-unlabelled learning.

Features are hashed grams of 4 and 5 bytes inside words, beginnings of words and whole words (A-Z as a-z). Their document frequencies are counted over all documents and over
the confirmed toxic ones of the training fold; the grams that stand out most among the toxic ones are kept, at most ``features``.
Linear numpy classifiers, one a seed, are trained on a bounded sample of positives and of unlabelled texts with the
non-negative risk pi R_p(+) + max(0, R_u(-) - pi R_p(-)); where the second term turns negative its gradient is reversed. The
class prior pi is the share of toxic labels in the training fold, or less where the frequencies of a kept gram bound it: its share of
all texts over its share of the toxic ones, times 1 + 1 / sqrt(its count among the toxic ones). The score is the mean of the classifiers' sigmoids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import SLICES, U64, ByteHash, array_slices, as_bytes, cut, held_out, keep_ids, map_arrow, mix, once, sum_arrays

BITS, GRAMS, STRETCH = 19, (4, 5), 1 << 20
SIZE = 1 << BITS
_STOP = np.zeros(256, bool)
_STOP[:65], _STOP[91:97], _STOP[123:128] = True, True, True
_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += U64(32)


def grams(text: bytes) -> np.ndarray:
    """Hashes below 2**19 of what a text's words hold: grams of 4 and 5 bytes, beginnings of 5 to 8 bytes, whole words. They may repeat."""
    out, at = [], 0
    while at < len(text):  # a very long text in stretches that end at a space
        end = len(text) if len(text) - at <= STRETCH else max(text.rfind(b" ", at, at + STRETCH), at) + 1
        end = end if end > at + 1 else min(len(text), at + STRETCH)
        out += _grams(np.frombuffer(text[at:end], np.uint8))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _place(key: np.ndarray, salt: int) -> np.ndarray:
    return ((mix(key + U64(salt * 0x9E3779B97F4A7C15 % 2**64))) >> U64(64 - BITS)).astype(np.int64)


def _grams(buf: np.ndarray) -> list[np.ndarray]:
    inside, c, out = ~_STOP[buf], _LOW[buf], []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    first, last = edge[0::2], edge[1::2]
    size, stop = last - first, np.concatenate(([0], np.cumsum(~inside)))
    key, whole = np.zeros(len(buf), np.uint64), np.zeros(len(first), np.uint64)
    for n in range(1, 9):
        m = len(buf) - n + 1
        if m < 1:
            break
        key = (key[:m] << U64(8)) | c[n - 1 :]
        if n in GRAMS:
            out.append(_place(key[stop[n:] == stop[:-n]], n))
        if n >= 5:
            out.append(_place(key[first[size >= n]], 16 + n))
        exact = size == n
        whole[exact] = key[first[exact]]
        if n == 8:  # longer words by their first and last eight bytes and their length
            more = size > 8
            whole[more] = mix(key[first[more]]) ^ key[last[more] - 8] ^ (size[more].astype(np.uint64) << U64(56))
    out.append(_place(whole[size >= 3], 32))
    return out


def _frequencies():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, last = np.zeros(SIZE + 1), np.zeros(SIZE, np.int64)
        for b in batches:
            for text in as_bytes(b.column("text")):
                total[once(last, grams(text))] += 1
                total[SIZE] += 1
        yield from array_slices(total, 16)

    return run


def _rows(place: np.ndarray, count: int):
    """Which of the kept grams a text holds, as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = []
            for text in as_bytes(b.column("text")):
                at = place[grams(text)]
                x.append(np.unique(at[at >= 0]).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary())], ["x"])

    return run


def _dense(rows: list[bytes], m: int) -> np.ndarray:
    out = np.zeros((len(rows), m + 2), np.float32)
    out[:, m] = 1
    for i, r in enumerate(rows):
        at = np.frombuffer(r, np.uint16)
        out[i, at] = 1
        out[i, m + 1] = np.log1p(len(at))
    return out


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, seed: int, rounds: int = 1500, batch: int = 1024, rate: float = 0.03, l2: float = 1e-4, gamma: float = 1.0) -> np.ndarray:
    """Weights of a linear classifier under the non-negative PU risk with the logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    w = np.zeros(pos.shape[1])
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    steps = max(1, -(-len(unl) // batch))
    for _ in range(-(-rounds // steps)):
        pu, pp = rng.permutation(len(unl)), rng.permutation(len(pos))
        for i in range(steps):
            u, p = unl[pu[i::steps]], pos[pp[i::steps] if len(pos) >= steps else pp]
            su, sp = sigmoid(u @ w), sigmoid(p @ w)
            minus = np.log1p(np.exp(np.clip(u @ w, -40, 40))).mean() - prior * np.log1p(np.exp(np.clip(p @ w, -40, 40))).mean()
            g_minus = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
            g = -gamma * g_minus if minus < 0 else prior * (p.T @ (sp - 1)) / len(p) + g_minus
            g = g + l2 * w
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", features: int = 1024, most: int = 8000, seeds: int = 3) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of docs; rows with crc32(id) % 5 = 0 are held out of the fit.

    A label counts once an id (the largest); null labels and ids are left out. ``most`` bounds the sampled positives and the
    sampled unlabelled texts, each (whole texts, chosen by a hash of the id). Without a toxic example the score is 0. Null and
    empty texts hold no gram and get the classifier's floor. Repeated rows are scored each. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    y = cut(y.where(~held_out("doc_id", 5, 0)), "toxic")
    n, toxic = y.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    place, weights = np.full(SIZE, -1, np.int64), np.zeros((0, 2))
    if toxic:
        ids = cut(y.where("y = 1").select("doc_id"), "positives")
        every = sum_arrays(map_arrow(docs.select("text"), _frequencies(), SLICES), SIZE + 1)
        among = sum_arrays(map_arrow(keep_ids(docs, ids).select("text"), _frequencies(), SLICES), SIZE + 1)
        # signed deviance of the count among toxic texts from what all texts let expect; of 2**19 grams a seventh of one reaches 30 by chance
        expected = (every[:SIZE] + 1) / (every[SIZE] + 1) * max(1, among[SIZE])
        k = among[:SIZE]
        deviance = np.where(k > expected, 2 * (k * np.log(np.maximum(k, 1) / expected) - (k - expected)), 0)
        kept = np.argsort(-deviance, kind="stable")[:features]
        kept = kept[deviance[kept] > 30]
        place[kept] = np.arange(len(kept))
        # whatever a gram is, all texts hold it at least pi times as often as toxic ones do: an upper bound of the class prior, with one
        # standard deviation of the gram's count as slack, one rule for every count
        bounds = every[kept] / max(1, every[SIZE]) / (k[kept] / max(1, among[SIZE])) * (1 + 1 / np.sqrt(k[kept]))
        prior = min([toxic / n, 0.95, *bounds])
        chosen = lambda d, share, salt: d.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20)))
        take = lambda d: [r["x"] for r in map_arrow(d.select("text"), _rows(place, len(kept)), "x binary").collect()]
        pos = take(keep_ids(docs, cut(chosen(ids, most / toxic, "p"), "sample")))
        unl = take(chosen(docs.where("doc_id IS NOT NULL").where(~held_out("doc_id", 5, 0)), most / max(1, every[SIZE]), "u"))
        if pos and unl:
            pos, unl = _dense(sorted(pos), len(kept)), _dense(sorted(unl), len(kept))
            weights = np.stack([fit_nnpu(pos, unl, prior, s) for s in range(seeds)])
    m = int((place >= 0).sum())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r.as_py() for x in _rows(place, m)(iter([b])) for r in x.column("x")]
            s = np.zeros(len(rows))
            if len(weights):
                for k in range(0, len(rows), 512):
                    s[k : k + 512] = sigmoid(_dense(rows[k : k + 512], m) @ weights.T).mean(1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(docs.withColumn("held_out", held_out("doc_id", 5, 0)).select("doc_id", "held_out", "text"), scored, "doc_id long, held_out boolean, score double, predicted int")
