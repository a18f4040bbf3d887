"""Quality classifier: random Fourier features of document statistics, ridge by partition-summed normal equations, isotonic calibration.

Statistics of every whole text go to a small table. Their means and deviations are taken over all documents. Cosines of random
projections approximate a Gaussian kernel; each partition sums x x' and x y over its labelled rows, the sums are added by
slices, and one solve on the driver (``features`` squared numbers, whatever the input) gives the scores. A quarter of the
labelled rows, left out of the fit, gives the isotonic calibration over 1024 score bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import SLICES, ByteHash, array_slices, as_bytes, cut, held_out, map_arrow, span_hashes, sum_arrays, word_spans

BINS = 1024
_CLASS = np.full(256, 7)
for _i, _chars in enumerate((b" ", b"\n\r", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"!?")):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 8
_SYMBOL = np.isin(np.arange(256), list(b"#$%&*+@^~<>=|{}[]_/\\"))


def statistics(h: ByteHash, text: bytes) -> np.ndarray:
    """26 numbers of a text; all zero for an empty one."""
    out = np.zeros(26)
    if not text:
        return out
    buf = np.frombuffer(text, np.uint8)
    n, hist = len(buf), np.bincount(buf, minlength=256)
    out[:9] = np.bincount(_CLASS, hist, 9) / n
    out[9], out[10] = hist[_SYMBOL].sum() / n, np.log1p(n)
    p = hist[hist > 0] / n
    out[11] = -(p * np.log2(p)).sum()
    start, end = word_spans(buf)
    if len(start):
        size = end - start
        words = np.sort(span_hashes(h, buf, start, end))
        runs = np.diff(np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1], [True]))))
        upper, odd = np.concatenate(([0], np.cumsum(_CLASS[buf] == 3))), np.concatenate(([0], np.cumsum(_SYMBOL[buf])))
        shout = (upper[end] - upper[start]) * 2 > size
        marked = odd[end] > odd[start]
        out[12:20] = np.log1p(len(size)), size.mean(), size.std(), len(runs) / len(size), runs.max() / len(size), shout.mean(), marked.mean(), (size <= 3).mean()
    edge = np.concatenate(([-1], np.flatnonzero(buf == 10), [n]))
    a, b = edge[:-1] + 1, edge[1:]
    some = b > a
    a, b = a[some], b[some]
    if len(a):
        lines = np.sort(span_hashes(h, buf, a, b))
        runs = np.diff(np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1], [True]))))
        out[20:25] = np.log1p(len(a)), np.log1p((b - a).mean()), 1 - len(runs) / len(a), runs.max() / len(a), np.log1p((b - a).max())
    out[25] = 1
    return out


def _stats():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = ByteHash(lower=True)
        for b in batches:
            x = [statistics(h, t).astype(np.float32).tobytes() for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(x, pa.binary())], ["doc_id", "held_out", "x"])

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), np.float32).reshape(len(column), -1).astype(np.float64)


def _moments():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * 26 + 1)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"))
                total += np.concatenate((x.sum(0), (x * x).sum(0), [len(x)]))
        yield from array_slices(total, 1)

    return run


class Fourier:
    """cos(w x + b) of standardised statistics, and the constant."""

    def __init__(self, mean, std, features: int, width: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(size=(len(mean), features)) / (width * np.sqrt(len(mean)))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        return np.hstack((np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))))


def _normal_equations(fourier: Fourier):
    m = len(fourier.b) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m * m + m + 1)
        for b in batches:
            if b.num_rows:
                f, y = fourier(_matrix(b.column("x"))), b.column("y").to_numpy()
                total += np.concatenate(((f.T @ f).ravel(), f.T @ y, [len(y)]))
        yield from array_slices(total, 1)

    return run


def _raw(fourier: Fourier, beta: np.ndarray, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = fourier(_matrix(b.column("x"))) @ beta if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(r)], [*keep, "raw"])

    return run


def isotonic(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (score, positives, count): knots of a non-decreasing line."""
    blocks: list[list[float]] = []  # sum of score, positives, count
    for s, p, n in sorted(bins):
        blocks.append([s * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", features: int = 256, width: float = 0.6, ridge: float = 1e-4) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of docs; rows with crc32(id) % 3 = 1 are held out of the fit.

    A label counts once an id: the mean of its labels, rounded up from a half; null labels and ids are left out. Null and empty
    texts have statistics of zero and are scored like any other. With no label, or one kind only, the score is that kind's
    share (0.5 with none). Repeated rows are scored each. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stats = cut(map_arrow(docs.withColumn("held_out", held_out("doc_id", 3, 1)), _stats(), "doc_id long, held_out boolean, x binary"), "stats")
    total = sum_arrays(map_arrow(stats.select("x"), _moments(), SLICES), 53, 1)
    mean = total[:26] / max(1, total[52])
    fourier = Fourier(mean, np.sqrt(np.maximum(0, total[26:52] / max(1, total[52]) - mean**2)), features, width)
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    part = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit("c"))) % 4 == 0
    learn = cut(stats.where(~F.col("held_out")).join(y, "doc_id").select("x", "y", part.alias("calibrate")), "learn")
    m = features + 1
    sums = sum_arrays(map_arrow(learn.where("NOT calibrate").select("x", "y"), _normal_equations(fourier), SLICES), m * m + m + 1, 1)
    penalty = np.eye(m) * ridge * max(1.0, sums[-1])
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(sums[: m * m].reshape(m, m) + penalty, sums[m * m : -1])
    raw = map_arrow(learn.where("calibrate").select("x", "y"), _raw(fourier, beta, ["y"]), "y double, raw double")
    at = F.floor(F.least(F.greatest((F.col("raw") + 0.5) / 2, F.lit(0.0)), F.lit(0.999999)) * BINS)
    found = raw.groupBy(at.alias("bin")).agg(F.avg("raw").alias("s"), F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    if found:
        knots, values = isotonic([(r["s"], r["p"], float(r["n"])) for r in found])
    else:
        share = sums[m * m + m - 1] / sums[-1] if sums[-1] else 0.5
        knots, values = np.zeros(1), np.full(1, share)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _raw(fourier, beta, ["doc_id", "held_out"])(batches):
            r = b.column("raw").to_numpy()
            # a thousandth of the raw score keeps the order within the flats of the isotonic line
            s = np.clip(0.999 * np.interp(r, knots, values) + 0.001 * np.clip(r, 0, 1), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(stats, scored, "doc_id long, held_out boolean, score double, predicted int")
