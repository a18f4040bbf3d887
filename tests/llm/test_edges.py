"""Each operator on null, empty, repeated and long rows, empty tables and clashing columns; results against brute force."""

import base64
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

LONG = "w0rd, " * 20_000
ROWS = [(1, "Hello there, World.", "en", "s"), (2, None, "en", None), (3, "", None, "s"), (4, "12 %% 34", "de", "s"), (5, LONG, "de", "s"), (6, "Grüße aus Köln", "de", "s"), (6, "Grüße aus Köln", "de", "s"), (None, "no id", "en", "s")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.length("text").cast("long")).withColumn("size", F.lit("x")).withColumn("score", F.lit(1)).withColumn("shard", F.lit(1)).withColumn("spans", F.lit(1))


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def test_sharding(spark, docs, none):
    from chargeplan.llm.sharding import kd_tree_shards

    many = docs.unionByName(spark.range(100, 1100).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit(3).cast("long").alias("n_chars"), *[F.lit(1).alias(c) for c in ("score", "shard", "spans")], F.lit("y").alias("size")))
    rows = kd_tree_shards(many.where("doc_id IS NULL OR doc_id <> 5"), ["n_chars", "source", "lang"], shards=8).collect()
    assert len(rows) == len(ROWS) - 1 + 1000
    for s in range(8):
        own = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total = sum(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in rows if r["shard"] == s) - total / 8) < 0.03 * total / 8 + 200 for s in range(8))
    one = {r["doc_id"]: r for r in rows}
    assert one[6]["text_crc32"] == zlib.crc32("Grüße aus Köln".encode()) and one[2]["size"] == 1 and one[2]["text_crc32"] == 0
    assert kd_tree_shards(none, ["n_chars"], shards=8).count() == 0
    sized = kd_tree_shards(docs, ["n_chars"], target_bytes=40_000)
    assert sized.select("shard").distinct().count() >= 1


def test_many_shards_and_a_third_in_one_text(spark):
    """300 shards, a third of all bytes in copies of one text and a third of all rows without text: bytes stay near equal."""
    from chargeplan.llm.sharding import kd_tree_shards

    i = F.col("id")
    df = spark.range(12_000).select(i.alias("doc_id"), F.when(i % 3 == 0, F.repeat(F.lit("h"), 40)).when(i % 3 == 1, F.repeat(F.md5(i.cast("string")), 2)).alias("text"), (i % 5).cast("string").alias("source"))
    rows = kd_tree_shards(df, ["source", "doc_id"], shards=300).collect()
    size, count = np.zeros(300), np.zeros(300, int)
    for r in rows:
        size[r["shard"]] += r["size"]
        count[r["shard"]] += 1
    assert len(rows) == 12_000 and abs(size - size.sum() / 300).max() < 130 and sorted({(r["shard"], r["slot"]) for r in rows}) == [(s, k) for s in range(300) for k in range(count[s])]


def test_write_shards_keeps_every_row(spark, docs, tmp_path):
    from chargeplan.llm.sharding import kd_tree_shards, write_shards

    own = docs.dropDuplicates(["doc_id"])
    placed = kd_tree_shards(own, ["n_chars"], shards=3).cache()
    write_shards(own, placed, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, own.select("doc_id", "text").collect())) and {(r["doc_id"], r["shard"]) for r in back.collect()} == {(r["doc_id"], r["shard"]) for r in placed.collect()}


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    from chargeplan.llm.packing import pack, shortest_pack_first

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = pack(docs, path).collect()
    for doc, text, *_ in ROWS:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted({(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == doc})
        assert own == [(a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048]), len(ids)) for a in range(0, len(ids), 2048)]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(none, path).count() == 0
    plan, n = shortest_pack_first({2048: 2, 1500: 3, 500: 4, 40: 10}, 2048)
    assert sum(hi - lo for _, lo, hi, _, _ in plan) == 19 and n >= 5


@pytest.mark.parametrize("text", ["don't I'LL it's", "ΣΑΣ İx ﬁ 日本語", "a.b c., d,. e.)  x\x85y", "x" * 3000, "É é Ö, ö. 1,2 ×, ÷."])
def test_chunks_tokenise_like_whole_texts(text):
    import public_tokenizers

    from chargeplan.llm.packing import ChunkTokens

    table = ChunkTokens(public_tokenizers.path("word_bpe_49k.json"))
    assert table.encode([text.encode(), b""])[0].tolist() == table.t.encode(text, add_special_tokens=False).ids


def words(rng, letters, n):
    return " ".join("".join(rng.choice(list(letters), int(rng.integers(2, 8)))) for _ in range(n))


def test_language(spark, docs, none):
    from chargeplan.llm.language import identify_language

    rng = np.random.default_rng(1)
    made = [(100 + i, words(rng, "abcdef" if i % 2 else "uvwxyz", 30), "aa" if i % 2 else "zz", "s") for i in range(300)]
    got = {r["doc_id"]: r for r in identify_language(spark.createDataFrame(made + ROWS, SCHEMA)).collect()}
    held = [r for r in made if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]]["held_out"] and got[r[0]]["lang_pred"] == r[2] for r in held) and len(held) > 20
    assert [got[i]["lang_pred"] for i in (2, 3)] == ["und", "und"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert identify_language(none).count() == 0
    assert {r["lang_pred"] for r in identify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_learns_nothing_from_held_out_rows(spark):
    """Other held-out texts, and rows without a language, change no prediction of the rest."""
    from chargeplan.llm.language import identify_language

    rng = np.random.default_rng(8)
    made = [(i, words(rng, "abcdefg" if i % 2 else "efghijk", 12), "aa" if i % 2 else "zz", "s") for i in range(400)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    other = [(i, words(rng, "qrstxyz", 30), "zz", "s") if held(i) else r for i, r in enumerate(made)] + [(10_000 + i, words(rng, "mnopq", 50), None, "s") for i in range(100)]
    run = lambda rows: {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_language(spark.createDataFrame(rows, SCHEMA)).collect()}
    a, b = run(made), run(other)
    assert all(a[i] == b[i] for i in range(400) if not held(i)) and sum(a[i] != b[i] for i in range(400)) > 20


def test_sums_of_arrays_over_many_partitions(spark):
    from chargeplan.llm.common import SLICES, array_slices, once, sum_arrays

    def run(batches):
        for _ in batches:
            pass
        yield from array_slices(np.arange(1000, dtype=np.float32), 7)

    got = sum_arrays(spark.range(0, 50, 1, 50).mapInArrow(run, SLICES), 1000, 7, np.float32, fan=4)
    assert (got == 50 * np.arange(1000)).all()
    assert sorted(once(np.zeros(9, np.int64), np.array([3, 1, 3, 8, 1, 3])).tolist()) == [1, 3, 8]


def test_quality(spark, docs, none):
    from chargeplan.llm.quality import score_quality

    rng = np.random.default_rng(2)
    made = [(100 + i, words(rng, "abcdef", 40) if i % 3 else words(rng, "AB$#", 40) + "!!!", "aa", "s") for i in range(600)]
    labels = spark.createDataFrame([(100 + i, int(i % 3 > 0)) for i in range(600)] + [(None, 1), (101, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in score_quality(spark.createDataFrame(made + ROWS, SCHEMA), labels).collect()}
    held = [i for i in range(600) if zlib.crc32(str(100 + i).encode()) % 3 == 1]
    assert all(got[100 + i]["held_out"] for i in held)
    assert np.mean([got[100 + i]["predicted"] == int(i % 3 > 0) for i in held]) > 0.97
    assert score_quality(none, labels).count() == 0
    assert {r["score"] for r in score_quality(docs, labels.where("doc_id < 0")).select(F.round("score", 2).alias("score")).collect()} == {0.5}


def test_toxicity(spark, docs, none):
    from chargeplan.llm.toxicity import score_toxicity

    rng = np.random.default_rng(3)
    made = [(100 + i, words(rng, "abcdefgh", 40) + (" wretchedly vile" if i % 8 == 0 else ""), "aa", "s") for i in range(1200)]
    labels = spark.createDataFrame([(100 + i, int(i % 8 == 0)) for i in range(0, 1200, 2)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(made + ROWS, SCHEMA), labels).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(100 + i).encode()) % 5 == 0]
    assert np.mean([got[100 + i]["predicted"] == int(i % 8 == 0) for i in held]) > 0.97
    assert score_toxicity(none, labels).count() == 0
    assert {r["score"] for r in score_toxicity(docs, labels.where("doc_id < 0")).collect()} == {0.0}


def test_decontamination(spark, docs, none):
    from chargeplan.llm.decontaminate import contaminated, lcs

    rng = np.random.default_rng(4)
    items = [(i, words(rng, "abcdefghijklm", 15 + 4 * i)) for i in range(10)]
    bench = spark.createDataFrame(items + [(77, None), (78, "")], "item_id long, text string")
    clean = [(1000 + i, words(rng, "abcdefghijklm", 200), "aa", "s") for i in range(80)]
    leaks = []
    for i, t in items:
        w = t.split()
        w[2], w[7] = "changed", "words"
        leaks += [(2000 + i, f"{words(rng, 'abcdefghijklm', 90)} {t.upper()} {words(rng, 'abcdefghijklm', 60)}", "aa", "s"), (3000 + i, f"{words(rng, 'abcdefghijklm', 50)} {' '.join(w)}", "aa", "s")]
    rows = contaminated(spark.createDataFrame(clean + leaks + ROWS, SCHEMA), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(b + i, i) for i in range(10) for b in (2000, 3000)}
    assert contaminated(none, bench).count() == 0 and contaminated(docs, bench.where("item_id < 0")).count() == 0
    assert lcs(list("abcbdab"), list("bdcaba")) == 4


def test_warc(spark, tmp_path):
    from chargeplan.llm.warc import read_warc, round_trip

    made = [(1, "http://a b/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n\r\n"), (6, "u", "z" * 300_000), (9, "u", "same")]
    pages = spark.createDataFrame(made, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    path = str(tmp_path / "w")
    got = {r["page_id"]: r for r in round_trip(spark, pages, path).collect()}
    newest = {}
    for i, _, h in made:
        newest[h or ""] = max(i, newest.get(h or "", i))
    for i, _, h in made:
        raw, r = (h or "").encode(), got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        first = newest[h or ""]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
    assert len(got) == len(made)
    some = read_warc(spark, path, payload=False).where("warc_type = 'revisit' AND page_id IN (1, 2, 6)")
    assert sorted(r["page_id"] for r in some.collect()) == [1, 2] and some.first()["payload"] is None
    assert round_trip(spark, pages.where("page_id < 0"), str(tmp_path / "e")).count() == 0


def test_neighbours(spark):
    from chargeplan.llm.ann import nearest_neighbours

    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    x = base[rng.integers(0, 30, 900)] + rng.normal(size=(900, 16)) * 0.4
    x[100:400] = x[100]
    made = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (None, made[0][1]), (1020, [1.0, 2.0])]
    df = spark.createDataFrame(made + odd, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    got = {}
    for r in nearest_neighbours(df, block=256, group=16).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(range(0, 900, 20))
    hit = 0
    for q, found in got.items():
        want = sorted((-float(x[q] @ x[i]), i) for i in range(900) if i != q)[:20]
        assert sorted(found) == list(range(1, 21))
        assert all(abs(s - float(x[q] @ x[i])) < 1e-9 for i, s in found.values())
        hit += len({round(-s, 9) for s, _ in want} & {round(s, 9) for _, s in found.values()}) / len({round(-s, 9) for s, _ in want})
        if 100 <= q < 400:
            assert {i for i, _ in found.values()} <= set(range(100, 122)) or want[0][0] != want[19][0]
    assert hit / len(got) >= 0.9
    assert nearest_neighbours(df.where("vec_id < 0")).count() == 0


def test_components(spark):
    from chargeplan.llm.common import connected_components

    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (200, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 100}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(6)
    item = words(rng, "qrstuv", 30)
    text = lambda n: words(rng, "abcdefghij", n)
    shared, copy = text(120), text(60)
    rows = [(i, text(40), "aa", "s", 1) for i in range(60)]
    rows += [(100, copy, "aa", "s", 1), (101, copy + " end", "aa", "s", 1), (102, None, "aa", "s", 1), (103, "1 2 3", "aa", "s", 1)]
    rows += [(110, f"{text(20)} {shared} {text(20)}", "aa", "s", 1), (111, f"{text(30)} {shared} {text(10)}", "aa", "s", 1), (120, f"{text(20)} {item} {text(20)}", "aa", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    every = {r[0] for r in rows}
    assert set(kept["language"]) == every - {102, 103}
    assert set(kept["near_copies"]) == every - {102, 103, 101}
    assert set(kept["repeated_passages"]) == set(kept["near_copies"]) and shared not in kept["repeated_passages"][110] and kept["repeated_passages"][5] == rows[5][1]
    assert set(kept["leaks"]) == set(kept["repeated_passages"]) - {120}
    packed = corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(kept["leaks"])
