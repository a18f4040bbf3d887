"""Approximate nearest neighbours: low-dimensional stable projections, kd-trees, chi-square stopping.

The largest inner product becomes the smallest distance by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0
for queries), after vectors are divided by M and queries by their norm. Vectors are projected to ``dims`` Gaussian (2-stable)
coordinates: the squared projected distance over the true one is chi-square with ``dims`` degrees. Vectors are dealt into blocks
of at most about ``block``, each packed once with the kd-tree over its projections, and queries into groups of about ``group``. Each group
passes over all blocks of a task and keeps its k nearest; a query verifies the leaves it reaches, nearest ones first, and passes
by a leaf so far that a vector as near as its k-th found would have been met with probability ``certainty``. Every vector is
indexed, no block or group grows with the input, and blocks meet groups without a shuffle.

Inner products are taken for leaves and queries at once, in single precision where that loses nothing but a bounded rounding; all
that this rounding leaves open is decided by the exact measure, added up in the order of SQL.

Equal vectors form a class, searched once; of its ids the k + 1 smallest can stand among the k nearest of any query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargeplan.llm.common import cut, free, map_arrow


def chi_square_quantile(p: float, n: int) -> float:
    """x with P(chi2_n <= x) = p, by bisection; the distribution by its series."""

    def cdf(x):
        term = total = 1.0 / (n / 2)
        k = 1
        while term > 1e-15 * total:
            term *= (x / 2) / (n / 2 + k)
            total += term
            k += 1
        from math import exp, lgamma, log

        return total * exp(-x / 2 + n / 2 * log(x / 2) - lgamma(n / 2))

    lo, hi = 1e-9, 40.0 * n
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


class KdTree:
    """Leaves of at most ``leaf`` points, split at medians of the widest coordinate: order, bounds and boxes."""

    def __init__(self, points: np.ndarray, leaf: int = 32):
        self.order, bounds, stack = np.arange(len(points)), [], [(0, len(points))]
        while stack:
            a, b = stack.pop()
            own = self.order[a:b]
            if b - a <= leaf:
                bounds.append((a, b))
                continue
            x = points[own]
            d = int(np.argmax(x.max(0) - x.min(0)))
            m = (b - a) // 2
            self.order[a:b] = own[np.argpartition(x[:, d], m)]
            stack += [(a, a + m), (a + m, b)]
        self.first, self.last = np.array(sorted(bounds)).T
        boxes = [points[self.order[a:b]] for a, b in zip(self.first, self.last, strict=True)]
        self.low, self.high = np.stack([x.min(0) for x in boxes]), np.stack([x.max(0) for x in boxes])


def _projection(d: int, dims: int) -> np.ndarray:
    return np.random.default_rng(11).normal(size=(d + 1, dims))


def _far(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of queries from boxes."""
    out = np.zeros((len(queries), len(low)), queries.dtype)
    for d in range(queries.shape[1]):
        q = queries[:, d, None]
        gap = np.maximum(low[:, d] - q, q - high[:, d])
        np.maximum(gap, 0, out=gap)
        gap *= gap
        out += gap
    return out


class Block:
    """Vectors in the order of the leaves of their kd-tree, with the bounds and boxes of these."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.ids, self.x, self.first, self.low, self.high = ids, x, first, low, high

    @classmethod
    def of(cls, ids: np.ndarray, x: np.ndarray, top: float, dims: int) -> Block:
        s = x / top
        lift = np.sqrt(np.maximum(1 - (s * s).sum(1), 0))
        tree = KdTree(np.hstack((s, lift[:, None])) @ _projection(x.shape[1], dims))
        return cls(ids[tree.order], x[tree.order], tree.first, tree.low.astype(np.float32), tree.high.astype(np.float32))


class Search:
    """The k nearest vectors of each query of a group, over one block after the other."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, top: float, k: int, dims: int, certainty: float):
        self.ids, self.q, self.top, self.k = ids, q, top, k
        unit = q / np.abs(q).max(1)[:, None]
        self.unit = unit / np.sqrt((unit * unit).sum(1))[:, None]
        self.limit, self.at = chi_square_quantile(certainty, dims), (self.unit @ _projection(q.shape[1], dims)[:-1]).astype(np.float32)
        self.edge, self.slack = np.full(len(q), -np.inf), 0.0  # the k-th score found, as computed; what rounding may have changed in it
        # what may be among the k nearest: query, row of the present block or -1, class, computed and exact score
        self.pool = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]

    def visit(self, block: Block, step: int = 4) -> None:
        """Verify the leaves that the queries reach, ``step`` neighbouring ones at once."""
        s = block.x / self.top
        kind = np.float32 if (s * s).sum(1).min() > 1e-6 else np.float64  # beside much longer vectors, short ones need more digits
        s, unit = s.astype(kind), self.unit.astype(kind)
        self.slack = max(self.slack, 2 * (s.shape[1] + 8) * float(np.finfo(kind).eps))
        first = block.first[::step]
        last = np.append(first[1:], len(s))
        far = np.minimum.reduceat(_far(block.low, block.high, self.at), np.arange(0, len(block.first), step), axis=1)
        near = np.zeros(far.shape, bool)
        near[np.arange(len(far)), far.argmin(1)] = True
        new, waiting = [], 0
        for wave in (near, ~near):
            for j in np.argsort(far.mean(0)):
                # with a true distance of the k-th found, the projection would lie this near with the wanted probability
                act = np.flatnonzero(wave[:, j] & (far[:, j] <= self.limit * np.maximum(2 - 2 * (self.edge - self.slack), 1e-12)))
                if not len(act):
                    continue
                a, b = first[j], last[j]
                score = (unit if len(act) == len(unit) else unit[act]) @ s[a:b].T
                hit = np.flatnonzero(score >= (self.edge[act] - self.slack).astype(kind)[:, None])
                new.append((act[hit // (b - a)], a + hit % (b - a), score.ravel()[hit]))
                waiting += len(hit)
                if waiting > 2 * self.k * len(unit):
                    self._add(block, new)
                    new, waiting = [], 0
            self._add(block, new)
            new, waiting = [], 0
        self._measure(block)

    def _add(self, block: Block, new: list) -> None:
        if not new:
            return
        query, row, score = (np.concatenate(x) for x in zip(*new, strict=True))
        more = [query, row, block.ids[row], score.astype(np.float64), np.full(len(row), np.nan)]
        self.pool = [np.concatenate(x) for x in zip(self.pool, more, strict=True)]
        order, place = self._places(-self.pool[3])
        kth = order[place == self.k - 1]
        self.edge[self.pool[0][kth]] = self.pool[3][kth]
        keep = self.pool[3] >= self.edge[self.pool[0]] - self.slack
        self.pool = [x[keep] for x in self.pool]
        if len(self.pool[0]) > 2 * self.k * len(self.q):  # very many near ties: the exact measure decides now
            self._measure(block)
            self._settle()

    def _places(self, *by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pool's order by query and keys, the last key first, and the place of each in its query."""
        order = np.lexsort((*by, self.pool[0]))
        q = self.pool[0][order]
        start = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
        return order, np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))

    def _measure(self, block: Block, most: int = 1 << 16) -> None:
        """Exact scores of what came from the present block: in double precision, added up from the first coordinate to the last."""
        query, row, _, _, exact = self.pool
        at = np.flatnonzero(row >= 0)
        for a in range(0, len(at), most):
            i = at[a : a + most]
            total = np.zeros(len(i))
            for y in np.ascontiguousarray((block.x[row[i]] * self.q[query[i]]).T):
                total += y
            exact[i] = total
        row[at] = -1

    def _settle(self) -> None:
        """Keep the k nearest of each query by the exact measure, of ties the smaller class."""
        order, place = self._places(self.pool[2], -self.pool[4])
        self.pool = [x[order[place < self.k]] for x in self.pool]
        low = np.full(len(self.q), np.inf)
        np.minimum.at(low, self.pool[0], self.pool[3])
        self.edge = np.where(np.bincount(self.pool[0], minlength=len(self.q)) == self.k, low, self.edge)

    def found(self) -> pa.RecordBatch:
        self._settle()
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.pool[0]], pa.int64()), pa.array(self.pool[2], pa.int64()), pa.array(self.pool[4], pa.float64())], names=["query_id", "class", "near"])


def _packed(t: pa.Table, d: int, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    return t.column(id_col).to_numpy(), t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _bytes(x: np.ndarray) -> bytes:
    """In single precision where that is the same numbers."""
    with np.errstate(over="ignore"):
        y = x.astype(np.float32)
    return (y if (y == x).all() else x).tobytes()


def _array(batch: pa.RecordBatch, col: str, r: int, kind: type, rows: int = -1) -> np.ndarray:
    return np.frombuffer(batch.column(col)[r].as_buffer(), kind).reshape(*((rows, -1) if rows >= 0 else (-1,)))


def _vectors(batch: pa.RecordBatch, col: str, r: int, d: int, rows: int) -> np.ndarray:
    data = batch.column(col)[r].as_buffer()
    return np.frombuffer(data, np.float32 if data.size == 4 * d * rows else np.float64).reshape(rows, d).astype(np.float64)


BLOCK, GROUP = "d int, ids binary, x binary, first binary, low binary, high binary", "d int, j int, queries binary, q binary"


def _block(top: float, dims: int):
    def run(key, t):
        d = key[0].as_py()
        b = Block.of(*_packed(t, d, "class"), top, dims)
        return pa.table({"d": pa.array([d], pa.int32())} | {c: pa.array([x], pa.binary()) for c, x in zip(("ids", "x", "first", "low", "high"), (b.ids.tobytes(), _bytes(b.x), b.first.astype(np.int64).tobytes(), b.low.tobytes(), b.high.tobytes()), strict=True)})

    return run


def _group(key, t):
    ids, q = _packed(t, key[0].as_py(), "query_id")
    return pa.table({"d": pa.array([key[0].as_py()], pa.int32()), "j": pa.array([key[1].as_py()], pa.int32()), "queries": pa.array([ids.tobytes()], pa.binary()), "q": pa.array([_bytes(q)], pa.binary())})


def _search(k: int, dims: int, certainty: float, top: float):
    def run(batches):
        search = last = None
        for batch in batches:
            for r in range(batch.num_rows):
                d, j = batch.column("d")[r].as_py(), batch.column("j")[r].as_py()
                if (d, j) != last:
                    if search:
                        yield search.found()
                    ids = _array(batch, "queries", r, np.int64)
                    search, last = Search(ids, _vectors(batch, "q", r, d, len(ids)), top, k, dims, certainty), (d, j)
                ids, first = _array(batch, "ids", r, np.int64), _array(batch, "first", r, np.int64)
                low, high = (_array(batch, c, r, np.float32, len(first)) for c in ("low", "high"))
                search.visit(Block(ids, _vectors(batch, "x", r, d, len(ids)), first, low, high))
        if search:
            yield search.found()

    return run


def nearest_neighbours(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 8, certainty: float = 0.97, block: int = 8192, group: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query, ids divisible by ``every``, with other rows.

    Null, zero and non-finite vectors, vectors that hold nulls and null ids take no part; vectors of different length never meet.
    Fewer candidates than k give fewer rows. Ties go to the smaller id. A repeated id counts once, with one of its vectors.
    Other columns are not read.
    """
    v = F.col("v")
    kind = "float" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "double"  # floats are stored as they are
    fine = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    fine = fine.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0))
    fine = fine.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    # equal by value: -0.0 is 0.0
    fine = fine.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(kind))).dropDuplicates(["vec_id"])
    fine = cut(fine.withColumn("h", F.xxhash64("v")).withColumn("h2", F.hash("v")), "vectors")
    classes = fine.groupBy("h", "h2").agg(F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("members"))
    salted = Window.partitionBy("h", "h2", "salt").orderBy("vec_id")
    few = fine.select("h", "h2", "vec_id").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h", "h2").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    members = cut(few.join(classes, ["h", "h2"]).select("class", "vec_id"), "members")
    copies = cut(fine.select("h", "h2", "vec_id").join(classes.where("members > 1"), ["h", "h2"]).where("vec_id <> class").select("vec_id"), "copies")
    more = copies.count()
    reps = fine.join(F.broadcast(copies) if more <= 500_000 else copies, "vec_id", "left_anti").select(F.col("vec_id").alias("class"), "v", F.size("v").alias("d"))
    square, largest = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")), F.array_max(F.transform("v", F.abs)).cast("double")
    n, top, most, d = fine.agg(F.count(F.lit(1)) - more, F.max(square), F.max(largest), F.max(F.size("v"))).first()
    # M, or a bound of it where squares leave the range of doubles
    top = 1.0 if not n else top**0.5 if 1e-200 < top < 1e300 else most * d**0.5
    queries = fine.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("d"))
    m = queries.count()
    # a block or group of long vectors takes fewer of them: 4 million components at most, about
    spread = lambda c, rows, most: F.pmod(F.xxhash64(c), F.ceil(F.lit(rows) / F.least(F.lit(most), F.greatest(F.lit(1), F.lit(1 << 22) / F.col("d"))))).cast("int")
    left = queries.withColumn("j", spread("query_id", m, group)).groupBy("d", "j").applyInArrow(_group, GROUP)
    right = reps.withColumn("i", spread("class", n, block)).groupBy("d", "i").applyInArrow(_block(top, dims), BLOCK)
    # every group passes over all blocks of a task; neither is shuffled for that
    right, left = cut(right, "blocks"), cut(left, "groups")
    free(fine, copies)
    right = right.withColumnRenamed("d", "e")
    met = left.join(right.hint("shuffle_replicate_nl"), F.col("d") == F.col("e")).drop("e")
    found = map_arrow(met, _search(k + 1, dims, certainty, top), "query_id long, class long, near double")
    # the nearest classes over all blocks, by the exact measure, then their members
    best = Window.partitionBy("query_id").orderBy(F.desc("near"), "class")
    found = cut(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "found")
    pairs = found.join(members, "class").where("vec_id <> query_id").withColumnRenamed("near", "score")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
