import hashlib

import numpy as np
import pytest

from chargeplan.llm.queries import QUERIES
from chargeplan.llm.suffix_dedup import suffix_array_dedup
from tests.llm import brute

SPAN = 220


def check(spark, docs, **how):
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in docs], "doc_id long, text string, th string, start int")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_array_dedup(df, SPAN, **how).collect()}
    raw = [(t or "").encode() for _, t in docs]
    want = {}
    for (i, _), t, flags in zip(docs, raw, brute.repeated_bytes(raw, SPAN)):
        kept = bytes(b for b, f in zip(t, flags) if not f)
        want[i] = (len(t), sum(flags), sum(f and not g for f, g in zip(flags, [False, *flags])), hashlib.sha256(kept).hexdigest())
    assert got == want


def corpus(seed):
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    passage, long = text(300), text(900)
    docs = [(1, None), (2, ""), (3, "ab" * 700), (4, "x" * 500), (5, text(100)), (6, long), (7, long), (8, text(50) + long[:400] + text(60))]
    docs += [(10 + i, text(int(rng.integers(0, 300))) + passage + text(int(rng.integers(0, 300)))) for i in range(12)]
    docs += [(40 + i, passage[i : i + 230] + text(90)) for i in range(10)]
    return docs


@pytest.mark.parametrize("most", [256, 1])
def test_equals_brute_force(spark, most):
    """With at most one context a key, everything goes through the smaller blocks."""
    check(spark, corpus(most), most=most, shard_bytes=3000)


def test_empty_table_and_short_span(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_array_dedup(empty, SPAN).count() == 0
    with pytest.raises(ValueError):
        suffix_array_dedup(empty, 50)


def test_kept_text_and_carried_columns(spark):
    df = spark.createDataFrame([(1, "é" * 300 + "tail", "de"), (2, "é" * 300, "fr")], "doc_id long, text string, lang string")
    rows = {r["doc_id"]: r for r in suffix_array_dedup(df, SPAN, keep_text=True, carry=("lang",)).collect()}
    assert rows[1]["kept"] == "tail" and rows[2]["kept"] == "" and rows[1]["lang"] == "de"


def test_query_takes_strings_of_400_bytes_and_no_shorter_ones(spark, tmp_path):
    """The contract's law: 51 shared words of 399 bytes stay and of 400 go; the operator takes both where a caller asks for 208."""
    rng = np.random.default_rng(3)
    short, long = (" ".join("".join(rng.choice(list("abcdefgh"), n)) for n in [7] * sevens + [6] * (51 - sevens)) for sevens in (43, 44))
    own = ["".join(rng.choice(list("ijklmnop "), 500)) for _ in range(4)]
    marks = ["1{}2", "3{}4", "5{}6", "7{}8"]
    texts = [o + m.format(p) + o[::-1] for o, m, p in zip(own, marks, (short, short, long, long), strict=True)]
    assert len(short.split()) == len(long.split()) == 51 and len(short) == 399 and len(long) == 400
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op8_suffix_array_dedup"](spark, str(tmp_path)).collect()}
    assert [(got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) for i in range(4)] == [(1401, 0, 0), (1401, 0, 0), (1402, 400, 1), (1402, 400, 1)]
    assert [got[i]["kept_sha256"] for i in range(4)] == [hashlib.sha256((t if i < 2 else t.replace(long, "")).encode()).hexdigest() for i, t in enumerate(texts)]
    assert sorted((r["doc_id"], r["n_removed"]) for r in suffix_array_dedup(docs, span=208).collect()) == [(0, 399), (1, 399), (2, 400), (3, 400)]
