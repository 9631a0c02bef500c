"""Scores and languages: small frames with odd rows, and held-out rows of the test tables."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, workload
from tidemark.llm.language import fit_languages, identify_languages
from tidemark.llm.quality import fit_quality, good_documents, score_quality
from tidemark.llm.tokens import CLASSES, words
from tidemark.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.1"


def test_words_are_those_of_the_pattern(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aBé \n\t.1ß\x0b") for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += ["", None]
    for piece in (1 << 20, 16):
        monkeypatch.setattr("tidemark.llm.tokens.PIECE", piece)
        hashes, at = words(pa.array(texts))
        known = {}
        for text, begin, end in zip(texts, at[:-1], at[1:]):
            found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            assert end - begin == len(found)
            for word, h in zip(found, hashes[begin:end]):
                lowered = re.sub("[A-Z]", lambda m: m[0].lower(), word)
                assert known.setdefault(lowered, h) == h
        assert len(set(known.values())) == len(known)
    assert len(words(pa.array(["ab!!12 |x"]), CLASSES)[0]) == 5


def count_by_hand(text):
    folded = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    found = Counter()
    for word in folded.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    found[padded[i : i + n]] += 1
    return found


@pytest.mark.parametrize("block", [1 << 19, 7])
def test_ngrams_by_hand(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    texts = ["The cat, sat été! x", None, "", "a", "漢字 and ß..", "123 !"]
    got = [Counter() for _ in texts]
    for text, gram, count in language.ngrams(pa.array(texts)):
        for t, g, n in zip(text.tolist(), gram.tolist(), count.tolist()):
            letters = []
            while g:
                letters.append(" " if g & 0x1FFFFF == language.BLANK else chr(g & 0x1FFFFF))
                g >>= 21
            got[t]["".join(reversed(letters))] += n
    assert got == [count_by_hand(t) for t in texts]


def test_odd_rows(spark, odd_docs, no_docs, no_labels):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, 0, 0), (6, None, None), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for scored in (score_quality, score_toxicity):
        for marks in (labels, no_labels):
            rows = scored(odd_docs, marks).collect()
            assert len(rows) == odd_docs.count()
            assert all(0 <= r["score"] <= 1 for r in rows)
        assert scored(no_docs, labels).count() == 0
        assert {r["score"] for r in scored(odd_docs, no_labels).collect()} == {0.5}
    assert good_documents(odd_docs, labels, least=0.0).columns == odd_docs.columns
    assert good_documents(odd_docs, labels, least=0.0).count() == odd_docs.count()
    assert fit_quality(no_docs, labels) is None


def test_odd_languages(odd_docs, no_docs):
    rows = identify_languages(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == "en"
    assert {by_id[i] for i in (3, 4, 5, 8)} == {"und"}
    assert identify_languages(no_docs).count() == 0
    assert fit_languages(no_docs) is None
    assert {r["lang_pred"] for r in identify_languages(odd_docs, F.lit(False)).collect()} == {"und"}


def test_profiles_tell_languages_apart(spark):
    rows = [(1, "the then there", "a"), (2, "und unter uns", "b"), (3, "their", None), (4, "unds", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in identify_languages(docs).collect()}
    assert got == {1: "a", 2: "b", 3: "a", 4: "b"}


@pytest.mark.parametrize(
    ("query", "mark", "least"),
    [("op1_quality_classifier", "quality", 0.97), ("op6_toxicity", "toxic", 0.95)],
)
def test_held_out_scores(spark, query, mark, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"])
    rows = workload.QUERIES[query](spark, SF).where("held_out").join(labels, "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col(mark)).cast("int"))).first()[0]
    assert right >= least


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) >= 100")
    rows = workload.QUERIES["op10_language_id"](spark, SF).where("held_out")
    rows = rows.join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    assert rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.99
