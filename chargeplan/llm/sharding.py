"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension until leaves reach the target bytes.

The order along a dimension is total: the value on a 24-bit grid over its range, then the text's hash, then the chunk of a
group of equal texts. A weighted median is found exactly in that order by four rounds of 16-bit digit histograms for all nodes
of a level at once; a round returns one row a node. Equal texts share one point, so a cut parts a group only where the median
falls into it; a group above 1/128 of a leaf is dealt into chunks that follow each other, so a group that holds a third of all
bytes fills neighbouring shards instead of overfilling one. Nodes are rows of a small table, so plans don't grow with the shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargeplan.llm.common import cut, gapless_rank

GRID, CHUNK_BITS, DIGITS = 16, 22, (47, 31, 15, 0)
#: A group of equal texts with a larger share of all bytes or rows is joined by broadcast; there are at most twice so many.
HOT = 4096


@dataclass
class Node:
    number: int
    parts: int
    first: int  # its first shard


@dataclass
class Split:
    dim: int
    key: int  # rows at or below go left


def _point(dims: list[str], lows: list[float], spans: list[float]) -> Column:
    """One long for each dimension: grid value, hash of the text, chunk."""
    tail = F.shiftleft(F.shiftrightunsigned("thash", 64 - (63 - GRID - CHUNK_BITS)), CHUNK_BITS) + F.pmod("chunk", F.lit(1 << CHUNK_BITS))
    cells = [F.least(F.floor((F.col(d) - F.lit(lo)) / F.lit(span) * ((1 << GRID) - 1)), F.lit((1 << GRID) - 1)) for d, lo, span in zip(dims, lows, spans, strict=True)]
    return F.array(*[F.shiftleft(c.cast("long"), 63 - GRID) + tail for c in cells])


def _table(rows: DataFrame, values: list[tuple], columns: str) -> DataFrame:
    """rows with the columns of their node, from one small row a node; rows of other nodes get nulls."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(values, f"node int, {columns}")), "node", "left")


def kd_tree_shards(docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per row of docs.

    Give the number of shards, or target_bytes (shards = ceil(all bytes / target)). size: UTF-8 bytes + 1, 1 for a null text.
    dims: columns of docs; strings count by their CRC, nulls as 0. Shards' bytes differ by little more than one document or
    1/128 of a shard. An empty table gives no rows; repeated rows and ids are each placed; a null id is placed like any other.
    Other columns are not read.
    """
    kinds = dict(docs.dtypes)
    number = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")).cast("double") if kinds[c] in ("string", "binary") else F.col(c).cast("double"), F.lit(0.0))
    text = F.col(text_col)
    names = [f"d{i}" for i in range(len(dims))]
    meta = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("thash"),
        *[F.when(F.isnan(number(c)), 0.0).otherwise(number(c)).alias(n) for c, n in zip(dims, names, strict=True)],
    )
    meta = cut(meta, "meta")
    rows, total = meta.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = shards or max(1, -(-total // target_bytes))
    cap = max(1, total // parts >> 7, total >> CHUNK_BITS)
    same = ["thash", "text_crc32", "size"]
    groups = cut(meta.groupBy(*same).agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("c"), F.min(F.struct(F.col("doc_id").alias("i"), *names)).alias("p")).where("c > 1"), "groups")
    big = (F.col("w") > F.lit(total / HOT)) | (F.col("c") > F.lit(rows / HOT))
    hot = F.broadcast(groups.where(big))
    copies = meta.join(hot, same).unionByName(meta.join(hot.select(same), same, "left_anti").join(groups.where(~big), same, "left"))
    chunks = F.greatest(F.lit(1), F.ceil(F.coalesce("w", F.lit(0)) / cap))
    meta = copies.select("doc_id", *same, *[F.coalesce(F.col(f"p.{n}"), F.col(n)).alias(n) for n in names], F.pmod(F.xxhash64("doc_id"), chunks).alias("chunk"))
    meta = cut(meta, "points")
    r = meta.agg(*[f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]).first()
    lows, spans = [r[2 * i] or 0.0 for i in range(len(names))], [((r[2 * i + 1] or 0.0) - (r[2 * i] or 0.0)) or 1.0 for i in range(len(names))]
    meta = meta.withColumn("at", _point(names, lows, spans)).select("doc_id", "size", "text_crc32", "at", *names)

    meta, open_nodes, leaves, number_of = meta.withColumn("node", F.lit(0)), [Node(0, parts, 0)], [], 1
    while open_nodes:
        leaves += [(n.number, n.first) for n in open_nodes if n.parts == 1]
        open_nodes = [n for n in open_nodes if n.parts > 1]
        if not open_nodes:
            break
        splits, fresh, table = _split(meta, open_nodes, names, spans), [], []
        for n in open_nodes:
            half, s = n.parts // 2, splits[n.number]
            low, high = Node(number_of, half, n.first), Node(number_of + 1, n.parts - half, n.first + half)
            number_of += 2
            fresh += [low, high]
            table.append((n.number, s.dim, s.key, low.number, high.number))
        side = F.when(F.col("dim").isNull(), F.col("node")).when(F.element_at("at", F.col("dim") + 1) <= F.col("cut"), F.col("low")).otherwise(F.col("high"))
        meta = cut(_table(meta, table, "dim int, cut long, low int, high int").withColumn("node", side).drop("dim", "cut", "low", "high"), "nodes")
        open_nodes = fresh
    placed = _table(meta, leaves, "shard int").select("doc_id", "size", "text_crc32", "shard")
    return gapless_rank(placed, ["shard"], ["doc_id", "text_crc32"], "slot", "doc_id", rows)


def _split(rows: DataFrame, nodes: list[Node], names: list[str], spans: list[float]) -> dict[int, Split]:
    """For each node the widest dimension, and the key at which its left parts' share of the bytes is reached."""
    rows = _table(rows, [(n.number, True) for n in nodes], "open boolean").where("open")
    wide = rows.groupBy("node").agg(F.sum("size").alias("w"), *[((F.max(n) - F.min(n)) / F.lit(s)).alias(n) for n, s in zip(names, spans, strict=True)]).collect()
    dims = {r["node"]: max(range(len(names)), key=lambda i: (r[names[i]], -i)) for r in wide}
    weight = {r["node"]: r["w"] for r in wide}
    want = {n.number: weight.get(n.number, 0) * (n.parts // 2) / n.parts for n in nodes}
    keys, below = {n.number: 0 for n in nodes}, {n.number: 0 for n in nodes}
    rows = _table(rows, [(n.number, dims.get(n.number, 0)) for n in nodes], "dim int").select("node", "size", F.element_at("at", F.col("dim") + 1).alias("key"))
    for i, shift in enumerate(DIGITS):
        base = DIGITS[i - 1] if i else 63
        bins = _table(rows, [(k, v >> base, float(want[k] - below[k])) for k, v in keys.items()], "prefix long, need double").where(F.shiftright("key", base) == F.col("prefix"))
        bins = bins.groupBy("node", "need", F.shiftright("key", shift).bitwiseAND(F.lit((1 << (base - shift)) - 1)).alias("bin")).agg(F.sum("size").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        last = F.max("bin").over(Window.partitionBy("node"))
        found = bins.withColumn("upto", upto).withColumn("last", last).where((F.col("upto") >= F.col("need")) | (F.col("bin") == F.col("last")))
        for r in found.groupBy("node").agg(F.min(F.struct("bin", "upto", "w")).alias("x")).collect():
            keys[r["node"]] |= r["x"]["bin"] << shift
            below[r["node"]] += r["x"]["upto"] - r["x"]["w"]
    return {n.number: Split(dims.get(n.number, 0), keys[n.number]) for n in nodes}


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Whole rows of docs (ids unique, one may be null) as Parquet, a folder for each shard; a column shard of docs is replaced."""
    at = placed.select(F.col("doc_id").alias("_id"), "shard")
    docs.drop("shard").join(at, F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id").repartition("shard").write.partitionBy("shard").parquet(path)
