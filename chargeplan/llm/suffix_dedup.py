"""Suffix-array dedup: remove every byte covered by a string of ``span`` bytes that also starts anywhere else.

A window is a string of ``span`` bytes. Its key is the smallest hash of its k-grams, so equal windows have equal keys wherever
they stand. Consecutive windows whose key comes from one place are a run; the bytes of a run are its context. A run's windows
differ in where they have that place, so none repeats within the run, and contexts of a document overlap by ``span`` - 1 bytes
at most, so they share no window.

1. Runs are grouped by (key, hash of the context). A context found twice is a repeat as a whole: copies, however many, are
   settled by counting.
2. Keys with several different contexts, at most ``most``, meet in a shard of bounded size, each context once. The shard's
   suffix array is built by induced sorting (suffixes classified, leftmost-smaller substrings sorted and named, the reduced
   string sorted by ranks of doubling prefixes, all others induced from them, bucket by bucket), and a window repeats where the permuted longest common
   prefix with a neighbour reaches ``span``.
3. Keys with more contexts (a passage in very many documents) are parted: windows are grouped by their place relative to the
   key's k-gram, in blocks, and by the bytes that all windows of a block share; blocks shrink from level to level, and at one
   window a block the key is the window itself. No list is cut and no group grows with the input.

Shorter strings can be counted beside (``also``). They come first, by the same steps: a longer string can only stand elsewhere
if its bytes are covered by shorter ones that do, so the longer windows are looked for in those bytes only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeplan.llm.common import U64, ByteHash, cut, free, keep_ids, map_arrow, mix, release

#: Bytes of a k-gram: as many as leave every window of the largest blocks its key, within these bounds. Longer ones meet less by chance.
GRAM, MOST_GRAM = 40, 100
LEVELS = (128, 32, 8, 1)
SEPARATOR = 255

# ---- the kernel: suffix array by induced sorting, permuted common prefixes ----


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (type S); s ends with a unique smallest sentinel."""
    d = np.diff(s.astype(np.int64))
    at = np.where(d != 0, np.arange(len(d)), len(d))
    after = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(len(s), bool)
    out[:-1] = np.append(d, 1)[after] > 0
    return out


def _groups(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by char; and for each group its char, first place and size."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    return order, c[first], first, np.diff(np.append(first, len(c)))


def induce(s: np.ndarray, kind: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix order induced from an order of the leftmost-S suffixes: L types from the left, then S types from the right."""
    n, k = len(s), len(sizes)
    end = np.cumsum(sizes)
    start = end - sizes
    seed_order, chars, first, count = _groups(s[seeds])
    seeds = seeds[seed_order]
    seeds_of = {int(c): seeds[f : f + m] for c, f, m in zip(chars, first, count, strict=True)}
    sa = np.full(n, -1, np.int64)

    head, done = start.copy(), start.copy()
    for c in range(k):
        while True:
            batch = sa[done[c] : head[c]]
            done[c] = head[c]
            if not len(batch):
                break
            _push_l(sa, s, kind, batch, head)
        if c in seeds_of:
            _push_l(sa, s, kind, seeds_of[c], head)
    tail, done = end.copy(), end.copy()
    for c in range(k - 1, -1, -1):
        while True:
            batch = sa[tail[c] : done[c]][::-1]
            done[c] = tail[c]
            if not len(batch):
                break
            _push_s(sa, s, kind, batch, tail)
        _push_s(sa, s, kind, sa[start[c] : head[c]][::-1], tail)
    sa[0] = n - 1
    return sa


def _push_l(sa, s, kind, batch, head) -> None:
    p = batch[batch > 0] - 1
    p = p[~kind[p]]
    if len(p):
        order, chars, first, count = _groups(s[p])
        sa[np.repeat(head[chars] - first, count) + np.arange(len(p))] = p[order]
        head[chars] += count


def _push_s(sa, s, kind, batch, tail) -> None:
    p = batch[batch > 0] - 1
    p = p[kind[p]]
    if len(p):
        order, chars, first, count = _groups(s[p])
        sa[np.repeat(tail[chars] + first, count) - 1 - np.arange(len(p))] = p[order]
        tail[chars] -= count


def _radix(order: np.ndarray, value: np.ndarray) -> np.ndarray:
    """order, stably sorted by value[order], 16 bits a pass."""
    for shift in range(0, max(1, int(value.max()).bit_length()), 16):
        order = order[np.argsort((value[order] >> shift).astype(np.uint16), kind="stable")]
    return order


def _sort_reduced(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced string: ranks of prefixes of 1, 2, 4, ... names until all differ."""
    rank, n, step = names.astype(np.int32), len(names), 1
    order = _radix(np.arange(n, dtype=np.int32), rank)
    while True:
        after = np.zeros(n, np.int32)
        after[:-step or None] = rank[step:] + 1 if step < n else 0
        # sorted by rank already: only those that share theirs move, and they stay in their ranks' places
        r = rank[order]
        edge = np.concatenate(([True], r[1:] != r[:-1], [True]))
        tied = np.flatnonzero(~(edge[:-1] & edge[1:]))
        mine = _radix(_radix(order[tied], after), rank)
        order[tied] = mine
        r, a = rank[order], after[order]
        new = np.concatenate(([0], np.cumsum((r[1:] != r[:-1]) | (a[1:] != a[:-1])))).astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[order] = new
        if new[-1] == n - 1:
            return order.astype(np.int64)
        step *= 2


def suffix_array(text: np.ndarray, h: ByteHash) -> np.ndarray:
    """Suffix array of text (uint8 without 0, a sentinel 0 is added and comes first)."""
    s = np.append(text, 0).astype(np.uint8)
    kind = classify(s)
    sizes = np.bincount(s, minlength=256)
    lms = np.flatnonzero(kind[1:] & ~kind[:-1]) + 1
    if len(lms) > 1:
        first = induce(s, kind, lms, sizes)
        place = np.full(len(s), -1, np.int64)
        place[lms] = np.arange(len(lms))
        by_substring = place[first]
        by_substring = by_substring[by_substring >= 0]
        stop = np.append(lms[1:] + 1, len(s))
        length, code = stop - lms, h.spans(h.prefix(s), lms, stop)
        a, b = by_substring[:-1], by_substring[1:]
        names = np.empty(len(lms), np.int64)
        names[by_substring] = np.concatenate(([0], np.cumsum((length[a] != length[b]) | (code[a] != code[b]))))
        lms = lms[by_substring if names[by_substring[-1]] == len(lms) - 1 else _sort_reduced(names)]
    return induce(s, kind, lms, sizes)


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp) in text order: the suffix before each in the array, and their common prefix. Only irreducible prefixes are compared."""
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.flatnonzero(phi >= 0)
    j = phi[i]
    fresh = (i == 0) | (j == 0) | (s[i - 1] != s[j - 1])
    a, b = i[fresh], j[fresh]
    wide = np.zeros(n + 8, np.uint64)
    padded = np.concatenate((s, np.zeros(16, np.uint8))).astype(np.uint64)
    for k in range(8):
        wide |= padded[k : n + 8 + k] << U64(8 * k)
    got, todo = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(todo):
        x, y = a[todo] + got[todo], b[todo] + got[todo]
        differ = wide[np.minimum(x, n)] ^ wide[np.minimum(y, n)]
        low = differ & (~differ + U64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, U64(1)).astype(np.float64)).astype(np.int64) >> 3)
        got[todo] += same
        todo = todo[same == 8]
    # the common prefix shrinks by one from a position to the next until an irreducible one
    value = np.full(n, -(1 << 40), np.int64)
    value[a] = got + a
    value[phi < 0] = np.flatnonzero(phi < 0)
    return phi, np.maximum(np.maximum.accumulate(value) - np.arange(n), 0)


def repeated_windows(contexts: list[bytes], span: int, h: ByteHash) -> list[np.ndarray]:
    """For each context, which of its windows also start at another place in these contexts."""
    joined = bytearray()
    starts = []
    for c in contexts:
        starts.append(len(joined))
        joined += c + b"\xff"
    buf = np.frombuffer(bytes(joined), np.uint8)
    edge = np.zeros(len(buf), bool)
    edge[[a + len(c) for a, c in zip(starts, contexts, strict=True)]] = True
    text = np.where(edge, np.uint8(SEPARATOR), np.minimum(buf, 253) + np.uint8(1)).astype(np.uint8)
    sa = suffix_array(text, h)
    s = np.append(text, 0).astype(np.uint8)
    phi, plcp = permuted_lcp(s, sa)
    hit = plcp >= span
    both = hit.copy()
    both[phi[hit]] = True
    return [both[a : a + len(c) - span + 1] for a, c in zip(starts, contexts, strict=True)]


# ---- windows, keys and contexts of a document ----


def _sliding_min(x: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of every w neighbours and its leftmost place, by prefix and suffix minima of blocks."""
    m, n = -(-len(x) // w) * w, len(x) - w + 1
    y = np.full(m, np.uint64(2**64 - 1))
    y[: len(x)] = x
    y, at = y.reshape(-1, w), np.arange(m, dtype=np.int32).reshape(-1, w)
    left = np.minimum.accumulate(y, axis=1)
    fresh = np.ones(y.shape, bool)
    np.less(y[:, 1:], left[:, :-1], out=fresh[:, 1:])
    left_at = np.maximum.accumulate(np.where(fresh, at, 0), axis=1).ravel()[w - 1 : w - 1 + n]
    left = left.ravel()[w - 1 : w - 1 + n]
    y, at = y[:, ::-1], at[:, ::-1]
    right = np.minimum.accumulate(y, axis=1)
    np.less_equal(y[:, 1:], right[:, :-1], out=fresh[:, 1:])
    right_at = np.minimum.accumulate(np.where(fresh, at, m), axis=1)[:, ::-1].ravel()[:n]
    right = right[:, ::-1].ravel()[:n]
    first = right <= left
    return np.where(first, right, left), np.where(first, right_at, left_at)


def _stretches(n: int, span: int, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    for a in range(0, n - span + 1, most):
        yield a, min(n, a + most + span - 1)


def _gram(span: int) -> int:
    return min(MOST_GRAM, (span - LEVELS[0]) // 2)


def _grams(h: ByteHash, buf: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    p = h.prefix(buf)
    at = np.arange(len(buf) - gram + 1)
    return p, h.spans(p, at, at + gram)


def runs(h: ByteHash, buf: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, hash of the context, first window, windows) of all runs."""
    gram = _gram(span)
    w = span - gram + 1
    for a, b in _stretches(len(buf), span):
        p, g = _grams(h, buf[a:b], gram)
        key, at = _sliding_min(g, w)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        count = np.diff(np.append(first, len(key)))
        yield key[first], h.spans(p, first, first + count + span - 1), first + a, count


def blocks(h: ByteHash, buf: np.ndarray, start: int, count: int, span: int, size: int) -> tuple[np.ndarray, ...]:
    """(key, hash of the context, first window, windows) of one run parted by place relative to its key's k-gram."""
    part = buf[start : start + count + span - 1]
    gram = _gram(span)
    p, g = _grams(h, part, gram)
    _, mine = _sliding_min(g, span - gram + 1)
    window = np.arange(count)
    block = (mine - window) // size
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    n = np.diff(np.append(first, count))
    # what all windows of a whole block share, so that a block cut short at a run's end still meets its like
    lo, hi = mine[first] - block[first] * size, mine[first] - block[first] * size - size + 1 + span
    hi = np.maximum(hi, lo + gram)
    lo, hi = np.clip(lo, 0, len(part)), np.clip(hi, 0, len(part))
    same = mix(h.spans(p, lo, hi) + (block[first] + 1).astype(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(size))
    return same, h.spans(p, first, first + n + span - 1), first + start, n


_ROW = "key long, ctx long, doc_id long, th long, start int, n int"
_NAMES = ["key", "ctx", "doc_id", "th", "start", "n"]


def _rows(parts: list[tuple], docs: list[tuple]) -> pa.RecordBatch:
    key, ctx, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    size = [len(p[0]) for p in parts]
    doc = pa.array(np.repeat(np.array([d for d, _ in docs], dtype=np.int64), size))
    th = np.repeat(np.array([t for _, t in docs], np.int64), size)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), doc, pa.array(th), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], _NAMES)


def _merged(spans: pa.ListArray) -> list[list[tuple[int, int]]]:
    """For each list of (a, b) its maximal runs in order; touching ones are one. A null list has none."""
    size = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    out = [[] for _ in size]
    flat = spans.flatten()
    if len(flat):
        row = np.repeat(np.arange(len(size), dtype=np.int64), size)
        lo, hi = ((row << 32) + pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b"))
        order = np.argsort(lo, kind="stable")
        lo, top = lo[order], np.maximum.accumulate(hi[order])
        first = np.flatnonzero(np.concatenate(([True], lo[1:] > top[:-1])))
        lo, top = lo[first], top[np.append(first[1:], len(top)) - 1]
        for i, a, b in zip((lo >> 32).tolist(), (lo & 0xFFFFFFFF).tolist(), (top & 0xFFFFFFFF).tolist(), strict=True):
            out[i].append((a, b))
    return out


def _all_runs(span: int):
    """Runs of whole texts, or of the merged spans that stand beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = ByteHash(lower=False)
        for b in batches:
            parts, docs, size = [], [], 0
            within = _merged(b.column("spans")) if "spans" in b.schema.names else [None] * len(b)
            for doc, th, text, bounds in zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), b.column("text"), within, strict=True):
                raw = text.as_py()
                if raw is None or len(raw) < span:
                    continue
                buf = np.frombuffer(raw, np.uint8)
                for lo, hi in [(0, len(raw))] if bounds is None else bounds:
                    for key, ctx, start, n in runs(h, buf[lo:hi], span) if hi - lo >= span else ():
                        parts.append((key, ctx, start + lo, n))
                        docs.append((doc, th))
                        size += len(key)
                if size > 200_000:
                    yield _rows(parts, docs)
                    parts, docs, size = [], [], 0
            if parts:
                yield _rows(parts, docs)

    return run


def _smaller_blocks(span: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = ByteHash(lower=False)
        for b in batches:
            parts, docs = [], []
            for doc, th, text, want in zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), b.column("text"), b.column("want").to_pylist(), strict=True):
                buf = np.frombuffer(text.as_py(), np.uint8)
                for x in want:
                    parts.append(blocks(h, buf, x["start"], x["n"], span, size))
                    docs.append((doc, th))
            if parts:
                yield _rows(parts, docs)

    return run


def _contexts(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], []]
            for text, want in zip(b.column("text"), b.column("want").to_pylist(), strict=True):
                raw = text.as_py()
                for x in want:
                    for col, v in zip(out, (x["key"], x["ctx"], raw[x["start"] : x["start"] + x["n"] + span - 1]), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["key", "ctx", "bytes"])

    return run


def may_repeat(key: np.ndarray, contexts: list[bytes], span: int, h: ByteHash) -> np.ndarray:
    """Which contexts may share a window with another of the same key (long, for each context).

    Of a window's bytes around the key's k-gram at least half are on one side, so contexts that share a window have that half in
    common at least. A context's k-gram is the first one with that hash; those without one (blocks have keys of their own) may repeat.
    """
    gram, half = _gram(span), (span - _gram(span) + 1) // 2
    size = np.array([len(c) for c in contexts], np.int64)
    end = np.cumsum(size)
    start = end - size
    p, g = _grams(h, np.frombuffer(b"".join(contexts), np.uint8), gram)
    at = np.flatnonzero(g == np.repeat(key.view(np.uint64), size)[: len(g)])
    row = np.searchsorted(end, at, side="right")
    inside = at + gram <= end[row]
    row, first = np.unique(row[inside], return_index=True)
    place = at[inside][first]
    out = np.ones(len(contexts), bool)
    out[row] = False
    for lo, hi in ((place - half, place + gram), (place, place + gram + half)):
        whole = np.flatnonzero((lo >= start[row]) & (hi <= end[row]))
        mine = row[whole]
        same = mix(h.spans(p, lo[whole], hi[whole]) + mix(key[mine].view(np.uint64)))
        _, which, count = np.unique(same, return_inverse=True, return_counts=True)
        out[mine[count[which] > 1]] = True
    return out


def _shard(span: int):
    def run(t: pa.Table) -> pa.Table:
        h = ByteHash(lower=False)
        t = t.filter(pa.array(may_repeat(t.column("key").to_numpy(), [x.as_py() for x in t.column("bytes")], span, h)))
        key, ctx, contexts = t.column("key").to_pylist(), t.column("ctx").to_pylist(), [x.as_py() for x in t.column("bytes")]
        out = [[], [], [], []]
        if not key:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32())], names=["key", "ctx", "at", "windows"])
        for k, c, hit in zip(key, ctx, repeated_windows(contexts, span, h), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
            for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
                for col, v in zip(out, (k, c, a, b - a), strict=True):
                    col.append(v)
        release()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names=["key", "ctx", "at", "windows"])

    return run


def _removed(text: bool, carried: list[str], also: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[], [], [], [], []]
            for raw, spans in zip(b.column("text"), _merged(b.column("spans")), strict=True):
                raw = raw.as_py() or b""
                kept, at = [], 0
                for lo, hi in spans:
                    kept.append(raw[at:lo])
                    at = hi
                kept.append(raw[at:])
                whole = b"".join(kept)
                for col, v in zip(out, (len(raw), len(raw) - len(whole), len(spans), hashlib.sha256(whole).hexdigest(), whole.decode("utf-8", "ignore") if text else None), strict=True):
                    col.append(v)
            cols = [b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if also:
                cols, names = [*cols, pa.array([sum(hi - lo for lo, hi in x) for x in _merged(b.column("short"))], pa.int64())], [*names, "n_repeated"]
            if text:
                cols, names = [*cols, pa.array(out[4], pa.string())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays([*cols, *[b.column(c) for c in carried]], [*names, *carried])

    return run


def suffix_array_dedup(docs: DataFrame, span: int = 400, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, carry: tuple[str, ...] = (), most: int = 256, shard_bytes: int = 1 << 19, also: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, n_repeated][, kept, carried columns]), one row per row of docs.

    Texts are UTF-8 bytes, null is empty; texts under ``span`` bytes hold no window. Repeated rows repeat each other: all their
    windows go. Null ids are handled like any other value, but null ids with one text share a result (it is the same for both).
    kept drops bytes that a cut leaves as broken characters. Other columns are not read. Exact up to 64-bit hash collisions.
    With ``also``, a smaller span, n_repeated counts the bytes covered by strings of so many bytes that also start anywhere else;
    of these only what strings of ``span`` bytes cover is removed.
    """
    no_id = -(1 << 62)
    if min(span, span if also is None else also) < 2 * GRAM + LEVELS[0]:
        raise ValueError(f"span must be at least {2 * GRAM + LEVELS[0]}")
    if also is not None and also > span:
        raise ValueError("also must be at most span")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry]).withColumn("th", F.coalesce(F.xxhash64("text"), F.lit(0)))
    carried = [f"carry_{c}" for c in carry]
    named = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(no_id)))
    source = named.select("doc_id", "th", "text").where(F.octet_length("text") >= span)
    if also is not None:
        short = cut(_repeats(named.select("doc_id", "th", "text").where(F.octet_length("text") >= also), also, most, shard_bytes), "short")
        source = _with_rows(source, short.where(F.col("covered") >= span), "spans")
    spans = _repeats(named.where(F.octet_length("text") >= span), span, most, shard_bytes, source)
    wide = named.join(spans, ["doc_id", "th"], "left")
    if also is not None:
        wide = wide.join(short.select("doc_id", "th", F.col("spans").alias("short")), ["doc_id", "th"], "left")
    wide = wide.select(F.when(F.col("doc_id") != no_id, F.col("doc_id")).alias("doc_id"), "text", "spans", *["short"] * (also is not None), *carried)
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", n_repeated long" * (also is not None) + ", kept string" * keep_text
    kinds += "".join(f", `{c}` {wide.schema[c].dataType.simpleString()}" for c in carried)
    return map_arrow(wide, _removed(keep_text, carried, also is not None), kinds).withColumnsRenamed(dict(zip(carried, carry, strict=True)))


def _repeats(long: DataFrame, span: int, most: int, shard_bytes: int, source: DataFrame | None = None) -> DataFrame:
    """(doc_id, th, spans, covered): spans of bytes covered by windows that stand elsewhere too, and an upper bound of their bytes.

    long: doc_id, th and text of at least span bytes; source: the same, with the spans that windows lie in.
    """
    rows = cut(map_arrow(long.select("doc_id", "th", "text") if source is None else source, _all_runs(span), _ROW), "runs")
    found = []
    for size in (*LEVELS, 0):
        groups = cut(rows.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "th", "start", "n")).alias("one")), "groups")
        several = groups.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        meet = groups.join(several, "key")
        few = cut(meet.where(F.col("k") <= most).select("key", "ctx", "one.*"), "few")
        whole = groups.where("c > 1").select("key", "ctx", F.lit(0).alias("at"), F.col("one.n").alias("windows"))
        total = few.agg(F.coalesce(F.sum(F.col("n") + span), F.lit(0))).first()[0]
        if total:
            shards = max(1, -(-total // shard_bytes))
            text = _with_rows(long, few.select("doc_id", "th", "key", "ctx", "start", "n"))
            bytes_of = map_arrow(text, _contexts(span), "key long, ctx long, bytes binary")
            part = bytes_of.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
            matched = part.groupBy("shard").applyInArrow(_shard(span), "key long, ctx long, at int, windows int")
            whole = whole.unionAll(matched)
        hits = rows.join(whole, ["key", "ctx"]).select("doc_id", "th", (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + F.col("windows") + span - 1).alias("b"))
        found.append(cut(hits, "hits"))
        free(few)
        if not size:
            free(rows, groups)
            break
        hot = several.where(F.col("k") > most).select("key")
        # one place of each context is enough: where a context stands twice, all its places are settled above
        todo = cut(groups.join(hot, "key", "left_semi").select("key", "ctx", "one.*"), "hot")
        free(rows, groups)
        if todo.isEmpty():
            free(todo)
            break
        rows = cut(map_arrow(_with_rows(long, todo), _smaller_blocks(span, size), _ROW), "blocks")
        free(todo)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionAll(more)
    return spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"), F.sum(F.col("b") - F.col("a")).alias("covered"))


def _with_rows(docs: DataFrame, rows: DataFrame, lists: str = "want") -> DataFrame:
    """(doc_id, th, text, lists): texts with what is wanted of them, gathered here if rows have no such lists yet."""
    want = rows.select("doc_id", "th", lists) if lists in rows.columns else rows.groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "ctx", "start", "n")).alias(lists))
    ids = cut(rows.select("doc_id").distinct(), "ids")
    return keep_ids(docs, ids).join(want, ["doc_id", "th"]).select("doc_id", "th", "text", lists)
