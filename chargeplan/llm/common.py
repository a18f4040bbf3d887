"""Helpers shared by the training-data operators: shared-folder cuts, gapless ranks, components, byte hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes that part words: space and \t \n \v \f \r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; only a local session may do without it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.conf.get("chargeplan.scratch.dir", None)
        if not where:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            where = tempfile.mkdtemp(prefix="chargeplan-")
            spark.conf.set("chargeplan.scratch.dir", where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write df to the shared folder, in folders of the columns ``by``, and read it back: lineage ends there, so a lost executor repeats nothing before it."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path, partitionBy=list(by) or None)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored = path
    _STORED.append(path)
    return out


#: What cut() has stored since the outermost, or the innermost open, settled() began.
_STORED: list[str] = []


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """cut() of what make() returns; all that making it has stored is deleted."""
    global _STORED
    before, _STORED = _STORED, []
    try:
        out = cut(make(), label)
        _free(spark, [p for p in _STORED if p != out.stored])
    finally:
        _STORED = before
    _STORED.append(out.stored)
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables of cut() that nothing will read again, and what shuffles of finished jobs left."""
    _free(tables[0].sparkSession, [t.stored for t in tables])


def free_part(stored: DataFrame, part: str) -> None:
    """Delete one folder, such as "part=3", of a table that cut() parted."""
    _free(stored.sparkSession, [f"{stored.stored}/{part}"])


def _free(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(conf).delete(where, True)
    jvm.System.gc()  # Spark deletes shuffle files once the driver's garbage is collected, which happens by chance otherwise


def release() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage, and several share an executor's limit."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def shrink(spark: SparkSession) -> None:
    """Have the executors collect their garbage: a heap grows to its limit over the stages, and only a full collection gives it back to the system, where Python workers need it."""
    slots = spark.sparkContext.defaultParallelism
    collect = F.expr("java_method('java.lang.System', 'gc')")
    spark.range(0, slots, 1, slots).select(collect.alias("done")).write.format("noop").mode("overwrite").save()


BATCH = "2m"


def map_arrow(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """mapInArrow in batches of a bounded size: rows are whole texts, and ten thousand of them, the default, are no bound.

    Sets spark.sql.execution.arrow.maxBytesPerBatch of the session.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)

    def run(batches):
        yield from fn(batches)
        release()

    return df.mapInArrow(run, schema)


def array_slices(total: np.ndarray, slices: int) -> Iterator:
    """An array as rows (k, p, x): slice k in bytes, made by partition p; one slice at a time, so that no second copy of the whole is held."""
    import pyarrow as pa
    from pyspark import TaskContext

    step, p = -(-len(total) // slices), TaskContext.get().partitionId()
    for k in range(slices):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([p], pa.int32()), pa.array([total[k * step : (k + 1) * step].tobytes()], pa.binary())], ["k", "p", "x"])


SLICES = "k int, p int, x binary"


def sum_arrays(parts: DataFrame, size: int, slices: int = 16, kind: type = np.float64, fan: int = 128, levels: int = 3) -> np.ndarray:
    """Sum of the arrays that the partitions of parts gave by array_slices. A task adds at most ``fan`` slices, level by level;
    fan ** levels partitions (two million) come here as one row a slice, and more of them as one row for each so many."""
    import pyarrow as pa

    def added(t):
        total = np.float64(0)
        for x in t.column("x"):
            total = total + np.frombuffer(x.as_buffer(), kind)
        return pa.table([t.column("k")[:1], pa.array([t.column("p")[0].as_py() // fan], pa.int32()), pa.array([total.astype(kind).tobytes()], pa.binary())], names=["k", "p", "x"])

    for _ in range(levels):
        parts = parts.groupBy("k", F.expr(f"p div {fan}").alias("to")).applyInArrow(added, SLICES)
    step, out = -(-size // slices), np.zeros(size, kind)
    for r in parts.collect():
        own = np.frombuffer(r["x"], kind)
        out[r["k"] * step : r["k"] * step + len(own)] += own
    return out


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", bound: int = 500_000) -> DataFrame:
    """Rows of docs whose id is in the stored table ids: broadcast while it has at most ``bound`` rows (8 MB), else shuffled."""
    return docs.join(F.broadcast(ids) if ids.count() <= bound else ids, id_col, "left_semi")


def drop_rows(docs: DataFrame, keys: DataFrame, by: tuple[str, ...], bound: int = 500_000) -> DataFrame:
    """Rows of docs the hash of whose columns ``by``, never null, is not in column key of keys. The keys are stored first, and broadcast only up to ``bound`` rows."""
    keys = cut(keys.select(F.col("key").alias("_key")).distinct(), "drop")
    return docs.withColumn("_key", F.xxhash64(*by)).join(F.broadcast(keys) if keys.count() <= bound else keys, "_key", "left_anti").select(docs.columns)


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], out: str, spread: str, rows: int, per_bucket: int = 50_000) -> DataFrame:
    """Number the rows of each key from 0 without gaps, without one task per key.

    Rows are dealt by (keys, hash bucket of ``spread``); the bucket counts, a bounded table, give each bucket's first number.
    """
    n = max(1, -(-rows // per_bucket))
    df = df.withColumn("_b", F.pmod(F.xxhash64(F.col(spread)), F.lit(n)).cast("int"))
    counts = df.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*keys, "_b").orderBy(*order)
    return (
        df.withColumn("_r", F.row_number().over(within) - 1)
        .join(first, [*keys, "_b"])
        .withColumn(out, (F.col("_r") + F.col("_first")).cast("long"))
        .drop("_b", "_r", "_first")
    )


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable. Alternating large-star and small-star rounds.

    Every round is two shuffles over the links and ends in the shared folder; nothing is collected but a count and a checksum.
    Nodes without links do not appear; null ends are ignored.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = cut(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    last = mark(e)
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        old, e = e, cut(small.select("x.u", "x.v").where("u <> v").distinct(), "cc")
        free(old)
        now = mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def base32(hex40: Column) -> Column:
    """Upper-case base32 of a 40-digit hex string (SHA-1), with SQL functions: 5 hex digits give 4 letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for k in range(8):
        x = F.conv(F.substring(hex40, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(letters, F.shiftright(x, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def once(last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each number of at once; last is scratch space as long as the numbers' range, so the cost is that of at alone."""
    place = np.arange(len(at), dtype=last.dtype)
    last[at] = place
    return at[last[at] == place]


def held_out(doc_id: str | Column, mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == rest, F.lit(False))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of products spread over all bits."""
    h = h ^ (h >> U64(31))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(29))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(32))


class ByteHash:
    """Polynomial hashes of substrings of a byte buffer, modulo 2**64 over random byte codes, by prefix sums."""

    def __init__(self, lower: bool, seed: int = 7):
        code = np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)
        if lower:
            code[65:91] = code[97:123]
        self.code, self.base = code, U64(0x9E3779B97F4A7C15)
        self.unbase = U64(pow(int(self.base), -1, 2**64))
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self.pow = np.cumprod(np.full(n, self.base, np.uint64))
        self.unpow = np.cumprod(np.full(n, self.unbase, np.uint64))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        if len(buf) + 1 > len(self.pow):
            self._grow(2 * len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.code[buf] * self.pow[: len(buf)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal bytes of [start, end), wherever they stand."""
        return mix((prefix[end] - prefix[start]) * self.unpow[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a UTF-8 buffer."""
    s = np.ones(len(buf) + 2, bool)
    s[1:-1] = _SPACE[buf]
    e = np.flatnonzero(s[1:] != s[:-1])
    return e[0::2], e[1::2]


def span_hashes(h: ByteHash, buf: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """Hashes of spans in order of place; a long buffer is taken in stretches that end between spans."""
    if not len(start):
        return np.zeros(0, np.uint64)
    if len(buf) <= most:
        return h.spans(h.prefix(buf), start, end)
    out, i = [], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + most, "right")))
        at = start[i]
        out.append(h.spans(h.prefix(buf[at : end[j - 1]]), start[i:j] - at, end[i:j] - at))
        i = j
    return np.concatenate(out)


def word_hashes(h: ByteHash, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of all words."""
    start, end = word_spans(buf)
    return start, end, span_hashes(h, buf, start, end)


_STEP = [U64(x) for x in (3, 0x9E3779B97F4A7C17, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def shingle_set(h: ByteHash, text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; the whole sequence where words are fewer; empty without words."""
    _, _, w = word_hashes(h, np.frombuffer(text, np.uint8))
    if not len(w):
        return w
    size = min(k, len(w))
    out = np.full(len(w) - size + 1, U64(size * 0xD6E8FEB86659FD93 % 2**64))
    for j in range(size):
        out += mix(w[j : len(w) - size + 1 + j] * _STEP[j % 5] + U64(j + 1))
    out = np.sort(mix(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def as_bytes(column) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow string column, null as empty, without making Python strings."""
    import pyarrow as pa

    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    for x in column:
        yield x.as_py() or b""
