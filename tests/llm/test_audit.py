"""The audit of filters against filters applied one after another."""

import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.audit import audit_filters, subset_states


def by_hand(docs, labels):
    """Apply every order to (id, text, lang) rows, one filter at a time."""
    firsts = {}
    for i, text, _ in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}

    def fails(i, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": i is not None and firsts[text] < i,
        }

    rows = {}
    for part in {lang or "" for _, _, lang in docs}:
        own = [(i, fails(i, text)) for i, text, lang in docs if (lang or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(x[f] for _, x in own) - len(gone),
                    sum(x[f] and sum(x.values()) == 1 for _, x in own),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def audited(docs, labels):
    rows = audit_filters(docs, labels).collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_steps_are_those_of_applied_filters(spark):
    rng = random.Random(9)
    docs = []
    for i in range(160):
        pool = [f"w{k}" for k in range(rng.choice((60, 5000)))] + ["Ab", "ABC", "é"]
        words = [rng.choice(pool) for _ in range(rng.choice((40, 99, 100, 101, 300)))]
        if rng.random() < 0.3:
            words += ["SHOUT"] * rng.randrange(30)
        if rng.random() < 0.3:
            words.append(rng.choice("#$%&*|"))
        text = rng.choice((" ", "\n", "\t \x0b")).join(words)
        docs.append((i, text, rng.choice(("en", "de", None, ""))))
    for i in range(160, 230):
        docs.append((i, rng.choice(docs)[1], rng.choice(("en", "fr"))))
    # Repeated rows, one id with two texts, no id, no text, white space, a long text.
    docs += [docs[3], docs[200], (5, docs[9][1], "en"), (None, docs[9][1], "en"), (None, None, None)]
    docs += [(300, None, "en"), (301, "", "es"), (302, " \n", "es"), (303, "x " * 50_000, "es"), (-4, "", None)]
    rng.shuffle(docs)
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 310, 2)]
    labels += [(2, 1, 1), (2, 0, 0), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    names = ("part", "mask", "n", "good", "toxic", "h1", "h2", "copy", "least")
    df = df.withColumns({c: F.lit("x") for c in names})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = by_hand(docs, labels)
    assert audited(df, marks) == want and len(want) == 5 * 600
    assert audited(df.repartition(5), marks) == want


def test_odd_and_empty_tables(spark, odd_docs, no_docs, no_labels):
    rows = audit_filters(odd_docs, no_labels).collect()
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rows} == by_hand(docs, [])
    assert audit_filters(no_docs, no_labels).count() == 0


def test_no_table_goes_through_the_driver(spark, tmp_path):
    """A stored table is small by its files, however many rows they hold."""
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id div 2) as text", "'en' as lang")
    labels = spark.range(2000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    for name, table in (("docs", docs), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/{name}")
    audit = audit_filters(spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/labels"))
    found = {(r["filter_order"], r["step"]): r for r in audit.collect()}
    assert (found["EABCD", 1]["removed"], found["ABCDE", 1]["good_lost"]) == (1000, 2000)
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_own_filters(spark, no_labels):
    docs = spark.createDataFrame(
        [(1, "a", 5), (2, "a", 50), (3, "b", 50)], "doc_id long, text string, size int"
    )
    rows = audit_filters(docs, no_labels, {"S": F.col("size") > 10}, F.lit("all")).collect()
    found = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in rows}
    assert found == {("SE", 1): (1, 2, 0, 3), ("SE", 2): (1, 0, 1, 1), ("ES", 1): (2, 1, 0, 1), ("ES", 2): (1, 1, 1, 3)}


def test_survivors_of_every_subset():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 9, (3, 2, 32))
    states = subset_states(cells)
    masks = np.arange(32)
    for subset in range(32):
        assert (states[..., subset] == cells[..., masks & subset == 0].sum(-1)).all()
