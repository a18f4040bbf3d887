"""Findings of round 3."""

import hashlib
import random

import numpy as np
import pytest

from chargeplan.llm import ngram_join
from chargeplan.llm.suffix_dedup import suffix_array_dedup
from tests.llm import brute


def test_copies_are_stored_once_and_ranges_join_to_the_same_groups(spark, monkeypatch):
    """Postings meet by ranges of shingles, and copies of a text are one posting: no range stores more for copies (op1 and pipeline by disk)."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(r.choices(words, k=60)) for _ in range(12)]
    near = [t + " tail" for t in texts[:4]]
    rows = [(100 * c + i, t) for c in range(10) for i, t in enumerate(texts + near)] + [(5000, None), (None, texts[5])]
    cut, stored = ngram_join.cut, {}

    def counted(df, label, *rest):
        out = cut(df, label, *rest)
        stored.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "cut", counted)
    monkeypatch.setattr(ngram_join, "RANGE", 200, raising=False)
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=85).collect()
    assert {(x["doc_id"], x["component_id"]) for x in got if x["doc_id"] is not None} == {(d, 5000 if d == 5000 else d % 100 if d % 100 < 12 else d % 100 - 12) for d, _ in rows if d is not None}
    assert len(stored["shared"]) == ngram_join.RANGES
    # lists that near copies share: two sets of 57 and 58 shingles, of which each posts 57 - 49 + 4 and 58 - 50 + 4
    assert sum(stored["shared"]) <= 4 * 24


def test_executors_give_their_heap_back(spark):
    """shrink() has the JVM that runs tasks collect its garbage (pipeline by an executor's memory)."""
    from chargeplan.llm.common import shrink

    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    runs = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = runs()
    shrink(spark)
    assert runs() > before


@pytest.mark.parametrize("most", [256, 1])
def test_shorter_strings_are_counted_beside_those_removed(spark, most):
    """A passage of 60 words under 400 bytes repeats across documents: it stays, but its bytes are counted; all columns equal brute force."""
    rng = np.random.default_rng(9)
    text = lambda n: "".join(rng.choice(list("abcdefgé \n"), n))
    words = lambda n: " ".join(text(4) for _ in range(n))
    passage, middle, long, tail = words(60), text(250), text(900), text(150)
    texts = [text(90) + passage + text(200), passage + text(400), text(700), None, "", middle, text(30) + middle, long, long, text(20) + long[100:700] + text(9), "x" * 700, text(60) + middle[:-1]]
    # both halves repeat, in different documents and as one nowhere: 400 bytes of it are covered by shorter strings only
    halves = text(300), text(300)
    texts += ["".join(halves), halves[0] + tail, tail + halves[1], long[:500] + passage, passage[:-1] + long[400:]]
    raw = [(t or "").encode() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r) for r in suffix_array_dedup(docs, 400, also=256, most=most, shard_bytes=3000).collect()}
    want = {}
    for i, (t, flags, short) in enumerate(zip(raw, brute.repeated_bytes(raw, 400), brute.repeated_bytes(raw, 256), strict=True)):
        kept = bytes(b for b, f in zip(t, flags, strict=True) if not f)
        want[i] = (i, len(t), sum(flags), sum(f and not g for f, g in zip(flags, [False, *flags])), hashlib.sha256(kept).hexdigest(), sum(short))
    assert got == want and want[0][2] == 0 and 256 <= want[0][5] < 400
