"""URL verdicts, mixing, search, sharding and the pipeline on small frames."""

import math
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.mixing import mix_sources, mixed_documents
from tidemark.llm.sharding import assign_shards, jump_shards
from tidemark.llm.topk import top_products
from tidemark.llm.urls import judge_pages

SF = "/root/testdata/sf0.001"


def test_urls(spark, no_labels):
    urls = [
        None, "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "x://net", "x://net/",
        "x://example.com/de/1.html", "x://example.com/DE/1", "a://b://c/d", "x://org.uk/fr/", "x://é.org/fr/2/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.withColumns({"bad": F.lit(1), "number": F.lit(2), "n": F.lit(3), "mean": F.lit(0.5)})
    rows = {r["page_id"]: tuple(r)[1:5] for r in judge_pages(pages, no_labels).collect()}
    assert rows[0] == rows[1] == rows[2] == ("", "", None, "allow")
    assert rows[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert rows[4][1:] == ("", None, "allow") and rows[5][2:] == ("net/", "block")
    assert rows[6][2:] == ("example.com/de/", "block") and rows[7][2] is None
    assert rows[8][:2] == ("b:", "//c/d") and rows[9][2] is None
    assert rows[10][2:] == ("org/fr/", "allow")
    assert judge_pages(pages.limit(0), no_labels).count() == 0


def test_bad_hosts_are_blocked(spark):
    rows = [(i, f"http://{'bad' if i % 2 else 'good'}.site.com/{i}") for i in range(80)]
    rows += [(100, "http://new.site.com/999"), (101, "http://bad.site.com/888")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = [(i, 0 if i % 2 else 1, 0) for i in range(80)] + [(None, 0, 1), (3, 1, 0), (999, None, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in judge_pages(pages, labels).collect()}
    assert got[101] == got[1] == "block" and got[100] == got[2] == "allow"


def test_mix(spark, odd_docs, no_docs):
    rng = random.Random(6)
    docs = [
        (i, " ".join(["w"] * rng.randrange(1, 60)), ("a", "b", None)[min(i % 7, 2)]) for i in range(700)
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mix_sources(df).collect()
    assert len(rows) == 700
    sizes = {s: sum(len(t.split()) for _, t, x in docs if x == s) for s in ("a", "b", None)}
    total = sum(sizes.values())
    # By hand: shares by weight 1, 2, 3, cut at three times the size, the excess reshared.
    weights, targets, left = {"a": 1, "b": 2, None: 3}, {}, total
    while True:
        level = left / sum(w for s, w in weights.items() if s not in targets)
        full = [s for s, w in weights.items() if s not in targets and level * w > 3 * sizes[s]]
        if not full:
            break
        for s in full:
            targets[s] = 3 * sizes[s]
            left -= targets[s]
    targets |= {s: level * w for s, w in weights.items() if s not in targets}
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sizes[s]
        assert own[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in own) - targets[s]) <= 60
        assert max(r["copies"] for r in own) - min(r["copies"] for r in own) <= 1
    assert max(r["copies"] for r in rows) <= 3
    again = mix_sources(df.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert mix_sources(odd_docs).count() == odd_docs.count()
    assert mix_sources(no_docs).count() == 0
    repeated = mixed_documents(df)
    assert repeated.columns == df.columns
    assert repeated.count() == sum(r["copies"] for r in rows)
    assert mixed_documents(odd_docs).columns == odd_docs.columns


def test_repeated_rows_come_as_often_as_the_mix_takes_them(spark):
    rows = [(i, "one two three four", s) for i in (1, 1, 1, 2) for s in ("a", "b", "c", None) for _ in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for settings in ({}, {"weights": (1, 5, 9, 2)}):
        mixed = mix_sources(df, **settings)
        expected = {(r["doc_id"], r["source"]): r["n"] for r in
                    mixed.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
        got = mixed_documents(df, **settings)
        assert got.columns == df.columns
        assert {(r["doc_id"], r["source"]): r["count"] for r in got.groupBy("doc_id", "source").count().collect()} == expected
    ten = spark.createDataFrame([(7, "a b c d", s) for s in "xyz" for _ in range(10)], "doc_id long, text string, source string")
    taken = mixed_documents(ten).groupBy("source").count().collect()
    assert {r["source"]: 4 * r["count"] for r in taken} == {"x": 20, "y": 40, "z": 60}


def test_heavier_documents_come_first(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.lit("one two three").alias("text"),
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
    )
    good = F.col("doc_id") % 2 == 0
    mixed = mix_sources(docs, weights=(1, 3), quality=F.when(good, 9.0).otherwise(1.0))
    drawn = mixed.where("source = 'a' and copies > 0")
    assert drawn.where(good).count() > 2 * drawn.where(~good).count()


def jump(key, shards):
    def draw(i):
        text = (key if key is not None else "").encode()
        seed = xxhash.xxh64(text, 42).intdigest()
        return ((xxhash.xxh64(struct.pack("<i", i), seed).intdigest() >> 11) + 0.5) / 2.0**53

    now, following, i = 0, 0, 1
    while following < shards:
        now = following
        following = math.floor((following + 1) / draw(i))
        i += 1
    return now


@pytest.mark.parametrize("shards", [1, 40, 90])
def test_jumps_by_hand(spark, shards):
    keys = spark.range(300).select(F.col("id").cast("string").alias("k"))
    for r in keys.select("k", jump_shards(F.col("k"), shards).alias("s")).collect():
        assert r["s"]["now"] == jump(r["k"], shards)
        assert r["s"]["grown"] == jump(r["k"], shards + 1)


def test_shards(spark, monkeypatch, odd_docs, no_docs):
    monkeypatch.setattr("tidemark.llm.sharding.BUCKET_ROWS", 20)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("é").alias("text"))
    rows = assign_shards(docs, 7).collect()
    assert {r["size"] for r in rows} == {18}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert min(map(len, slots.values())) > 600
    odd = assign_shards(odd_docs, 3, ["text", "n"]).collect()
    assert len(odd) == odd_docs.count()
    assert len({(r["shard"], r["slot"]) for r in odd}) == len(odd)
    assert {r["size"] for r in odd if r["doc_id"] == 3} == {16}
    assert assign_shards(no_docs).count() == 0


def test_search(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, [1.0] * 6) for i in range(300, 330)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")]), (None, [1.0])]
    rows += [(404, []), (405, [2.0]), (40, [9.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in top_products(df, F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    whole = {}
    stored = df.where("vec_id is not null").collect()
    good = [
        (r["vec_id"], [math.floor(64 * x) for x in r["embedding"]])
        for r in stored
        if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])
    ]
    for i, v in good:
        whole.setdefault(i, []).append(v)
    for q, vectors in whole.items():
        if q % 20:
            continue
        answers = []
        for query in vectors:
            scored = [(-sum(a * b for a, b in zip(query, v)), i) for i, v in good if i != q]
            answers.append([(n, -s, i) for n, (s, i) in enumerate(sorted(scored)[:5], 1)])
        assert sorted(got[q]) in answers
    assert set(got) == {q for q in whole if q % 20 == 0}
    assert top_products(df.limit(0), F.lit(True)).count() == 0
    few = top_products(df.where("vec_id in (1, 20)"), F.col("vec_id") == 20, k=5).collect()
    assert [(r["rank"], r["vec_id"]) for r in few] == [(1, 1)]


def test_pipeline(spark, odd_docs, no_docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names[0].startswith("quality") and names[-1] == "sharding" and len(names) == 5
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= 3 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) > 100
