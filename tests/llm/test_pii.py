"""Personal data: patterns and messages against brute force, and labels that agree."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii, workload
from tidemark.llm.crf import fit_potentials, marginals
from tidemark.llm.pii import base_spans, find_personal_data


def luhn(digits):
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def by_hand(text):
    """The patterns as they are stated, with the tests of their matches."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((2, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((3, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((4, *m.span()))
    return out


def test_spans_are_those_of_the_patterns():
    rng = random.Random(13)
    pieces = [
        "a.b@c.de", "@", "x@y", "x@y.z.", "é@a.b", "%+_@-.-", "1.2.3.4", "01.002.255.256", "1.2.3.4.5.6.7.8.9",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "4111  1111", "0" * 13, "+", "+1 (377) 555-0271",
        "+49.30.12345678", "+1", "++1 23456789", "123456789012345678901", ".", "-", "é", "٣", "\n", "+1 2 3 4 5 6 7 8 9 )",
    ]
    texts = ["".join(rng.choice(pieces) + rng.choice(("", " ", "")) for _ in range(rng.randrange(9))) for _ in range(6000)]
    texts += ["".join(rng.choice("ab1 2.3@+-(4)é") for _ in range(40)) for _ in range(6000)]
    for text in texts:
        assert base_spans(text) == by_hand(text), text


@pytest.mark.parametrize("piece", ["1", "1 ", "1.", "a@", "a", "@", "+", "+1", "+1-", "a1.", "1-", ".@", "é"])
def test_patterns_are_linear(piece):
    # Two hundred thousand characters that a backtracking pattern would read over and over.
    text = piece * (200_000 // len(piece))
    field = pii._Field(text, base_spans(text))
    assert len(field.edges) <= 45 * len(field.spans) + 1


def exact(unary, edges, pair):
    n, labels = unary.shape
    out = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        w = sum(unary[i, y[i]] for i in range(n)) + sum(pair[k, y[a], y[b]] for a, b, k in edges)
        out[range(n), y] += np.exp(w)
    return out / out.sum(1, keepdims=True)


def test_messages_are_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(3)
    pair = rng.normal(size=(2, 3, 3))
    unary = rng.normal(size=(7, 3))
    tree = np.array([(0, 1, 0), (1, 2, 1), (3, 1, 0), (5, 4, 1)])
    np.testing.assert_allclose(marginals(unary, tree, pair), exact(unary, tree, pair), atol=1e-3)
    loop = np.array([(0, 1, 0), (1, 2, 0), (2, 3, 0), (3, 0, 1)])
    weak = pair / 4
    assert np.abs(marginals(unary, loop, weak) - exact(unary, loop, weak)).max() < 0.02
    np.testing.assert_allclose(marginals(unary, np.zeros((0, 3), int), pair), exact(unary, [], pair))


def test_potentials_are_counts():
    found = fit_potentials({(0, 5): np.array([3.0, 1.0])}, np.array([[[6.0, 0.0], [0.0, 2.0]], [[0, 0], [0, 0]]]))
    for feature in ((0, 5), (0, 6), (1, 5)):
        assert np.exp(found.node(feature)).sum() == pytest.approx(1)
        assert found.node(feature)[0] > found.node(feature)[1]
    assert found.edges[0][0, 0] > 0 > found.edges[0][0, 1] and found.edges[0][1, 1] > found.edges[0][0, 0]
    assert (found.edges[1] == 0).all()
    skip = fit_potentials({}, np.array([[[50.0, 1.0], [1.0, 3.0]]]), skips=[0]).edges[0]
    assert skip[0, 0] == skip[1, 1] > 0 and skip[0, 1] == skip[1, 0] == 0


def spans_of(rows):
    return [(s["kind"], s["start"], s["end"]) for s in rows]


def corpus(n):
    """Texts with matches, and texts with plain numbers."""
    rng = random.Random(n)
    out = []
    for i in range(n):
        words = [rng.choice("the cat of river and stone".split()) for _ in range(40)]
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(d for d in "0123456789" if luhn(card + d))
        area, line = rng.randrange(100, 999), f"555-{rng.randrange(1000, 9999)}"
        found = [card, f"+1 ({area}) {line}", f"jo{i}.doe@mail{i}.org", f"{rng.randrange(256)}.7.7.{rng.randrange(256)}"]
        rng.shuffle(found)
        # Apart, as digits side by side would be one match.
        for place, text in zip((32, 25, 15, 3), found):
            words.insert(place, text)
        words += [f"{rng.randrange(10**k)}x" for k in (1, 2, 4, 5)]
        # Some matches come again, or nearly.
        again = [*words[-4:], "and", found[i % 4], "or", f"+1 ({area}) {line[:-1]}{i % 10}", "too"]
        out.append((i, " ".join(words + again)))
        out.append((10_000 + i, f"In {1900 + i % 100} there were {i} boats, v{i}.2 and #{i * 7919 + 10**6}."))
    return out


def test_other_ways_of_writing_agree_with_matches(spark):
    docs = corpus(150)
    card, other = "4000123456789017", "4000123456789027"
    assert luhn(card) and not luhn(other)
    cases = {
        20_000: (f"My card {card} is new. Pay with {card[:8]}.{card[8:]} or call.", ("card", f"{card[:8]}.{card[8:]}")),
        20_001: (f"Card {card} was read as {other} once.", ("card", other)),
        20_002: ("Call +1 (377) 555-0271 today, or from here (377) 555-0271 or so.", ("phone", "(377) 555-0271")),
        20_003: ("Write to mary.jones@mail.org now; mary.jones@localhost, it is.", ("email", "mary.jones@localhost")),
    }
    docs += [(i, text) for i, (text, _) in cases.items()]
    docs += [(30_000, f"Only {other} and {card[:8]}.{card[8:]} here."), (30_001, f"{card} in 1999 for 20 boats.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in find_personal_data(df).collect()}
    texts = dict(docs)
    for i, r in rows.items():
        base, spans = spans_of(r["base"]), spans_of(r["spans"])
        assert [(pii.KINDS[k - 1], a, b) for k, a, b in by_hand(texts[i])] == base
        assert set(base) <= set(spans)
        more = [(kind, texts[i][a:b]) for kind, a, b in spans if (kind, a, b) not in base]
        assert more == ([cases[i][1]] if i in cases else []), i


def test_texts_without_a_match_are_solved_too(spark):
    failing = "4000123456789027"
    cases = [
        ("Call (377) 555-0271 or so.", [("phone", "(377) 555-0271")]),
        (f"Only {failing} here.", []),
        ("Nothing but 20 boats in 1999.", []),
    ]
    docs = corpus(150) + [(20_000 + i, text) for i, (text, _) in enumerate(cases)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in find_personal_data(df).collect()}
    for i, (text, expected) in enumerate(cases):
        row = rows[20_000 + i]
        assert row["base"] == [] and [(k, text[a:b]) for k, a, b in spans_of(row["spans"])] == expected
    assert all(pii._passes(2, x) for x in ("1.2.3.255", "01-02-03-04")) and not pii._passes(2, "1.2.3.256")
    assert pii._passes(3, "4000.1234 56789017") and not pii._passes(3, failing)
    assert list(pii._groups(["no node", "1", "", "a@b.cc"])) == [[1, 3]]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = find_personal_data(odd_docs.withColumns({"base": F.lit(1), "spans": F.lit("x")})).collect()
    assert len(rows) == odd_docs.count() and {len(r["spans"]) for r in rows} == {0}
    assert find_personal_data(no_docs).count() == 0
    text = "é x@y.zz, +1 (377) 555-0271\n4111 1111 1111 1111, 1.2.3.4"
    docs = [(1, text), (1, text), (None, text), (2, "@" * 9), (3, " ".join(["a.b@c.de"] * 30_000))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = find_personal_data(df).collect()
    assert sorted(len(r["base"]) for r in rows) == [0, 4, 4, 4, 30_000]
    assert all(r["base"] == r["spans"] for r in rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = workload.QUERIES["op13_personal_data"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = by_hand(texts[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k - 1]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == i for b in base) for i in (1, 2, 3, 4)]
        assert set(text.split(",")) <= set(r["spans"].split(",")) if text else r["spans"] == ""
