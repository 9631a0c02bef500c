"""Near duplicates, leaks and lines against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from tidemark.llm import dedup
from tidemark.llm.decontamination import find_leaks, without_leaks
from tidemark.llm.dedup import near_duplicates, without_near_duplicates
from tidemark.llm.graph import components
from tidemark.llm.lines import drop_common_lines


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def groups_by_hand(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), i == root(i)) for i in sets}


def family(rng, first, size, passage):
    """Copies of one text with a few words changed, and texts that share a passage."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = [(first, " ".join(base))]
    for i in range(1, size):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        docs.append((first + i, " ".join(text)))
    for i in range(size):
        own = [f"y{rng.randrange(10**6)}" for _ in range(30 + i)]
        docs.append((first + size + i, " ".join([*own, *passage])))
    return docs


@pytest.mark.parametrize("short", [48, 3])
def test_groups_are_those_of_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(dedup, "SHORT", short)
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    docs = family(rng, 100, 25, passage) + family(rng, 300, 12, passage)
    docs += [(1, "a b c"), (2, "A b  c"), (3, ""), (4, None), (5, " \n"), (6, docs[0][1].upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in near_duplicates(df).collect()}
    assert got == groups_by_hand(docs)


def test_supersets_of_one_body_are_found_in_long_lists(spark):
    rng = random.Random(12)
    body = [f"w{i}" for i in range(300)]
    docs = [(0, " ".join(body))]
    for i in range(1, 301):
        docs.append((i, " ".join([*body, *(f"x{rng.randrange(10**9)}" for _ in range(50))])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    assert got == dict.fromkeys(range(301), 0)


def test_only_different_components_meet(spark):
    rows = [(v, i, i % k) for v, k in ((1, 1), (2, 3), (3, 8), (4, 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "v long, doc_id long, component long")
    sides = dedup._across(df)
    keys = ["v", "digit", "rest", "bit"]
    left = sides.select(*keys, F.col("doc_id").alias("a"))
    right = sides.withColumn("bit", 1 - F.col("bit")).select(*keys, F.col("doc_id").alias("b"))
    met = sorted((r["v"], r["a"], r["b"]) for r in left.join(right, keys).collect())
    assert met == sorted((v, i, j) for v, i, c in rows for w, j, d in rows if v == w and c != d)


def linked(a, b, percent):
    both = len(shingles(a) & shingles(b))
    return 100 * both >= percent * len(shingles(a) | shingles(b))


def test_pipeline_stage_drops_what_is_80_percent_alike(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHORT", 3)
    rng = random.Random(5)
    docs = []
    for first in (100, 200):
        base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        for i in (0, 22):
            docs.append((first + i, " ".join([*base, *(f"x{rng.randrange(10**6)}" for _ in range(i))])))
    # With 22 more of 122 shingles a copy is 82 percent alike.
    assert linked(docs[0][1], docs[1][1], 80) and not linked(docs[0][1], docs[1][1], 85)
    assert not linked(docs[0][1], docs[2][1], 1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, 80).collect()}
    assert got == {100: 100, 122: 100, 200: 200, 222: 200}
    kept = dict(STAGES)["minhash near-dedup"](spark, df, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [100, 200]
    assert near_duplicates(df).where("kept").count() == 4


def test_odd_documents(spark, odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"]}
    assert found[1] == (3, 1, True) and found[2] == (3, 1, False)
    assert found[3] == (0, 3, True) and found[5] == (0, 5, True) and found[6][0] == 29_996
    assert {(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None} == {(None, True)}
    assert near_duplicates(no_docs).count() == 0
    kept = without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2


def texts_of(rng, n=120):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_repeated_ids_go_by_their_text(spark):
    rng = random.Random(15)
    a, b, c, d = (texts_of(rng) for _ in range(4))
    near = a + " and more"
    docs = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, c), (4, near), (5, d), (5, ""), (5, ""), (6, b), (7, d), (None, c), (None, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_n", F.lit("x"))
    rows = near_duplicates(df).collect()
    got = sorted(((r["doc_id"] or 0, r["n_shingles"] > 0, r["component_id"] or 0) for r in rows))
    assert got == sorted(
        [(1, True, 1), (2, True, 1), (2, True, 2), (3, True, 3), (3, True, 3), (3, True, 3), (4, True, 1), (5, True, 5),
         (5, False, 5), (5, False, 5), (6, True, 2), (7, True, 5), (0, True, 0), (0, False, 0)]
    )
    kept = without_near_duplicates(df.drop("_n"))
    order = lambda r: (r[0] or 0, r[1])
    assert sorted(map(tuple, kept.collect()), key=order) == sorted(
        [(1, a), (2, b), (3, c), (5, d), (5, ""), (5, ""), (None, c), (None, "")], key=order
    )


def test_one_id_with_two_texts_joins_no_groups(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHORT", 3)
    rng = random.Random(16)
    one, two = texts_of(rng), texts_of(rng)
    # Id 9 has a copy of either text; ids 20 and up are near copies of one, 40 and up of two.
    docs = [(9, one), (9, two)] + [(20 + i, f"{one} x{i}") for i in range(9)] + [(40 + i, f"{two} y{i}") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_duplicates(df).collect()
    assert {r["component_id"] for r in rows} == {9}
    kept = sorted(map(tuple, without_near_duplicates(df).collect()))
    assert kept == sorted([(9, one), (9, two)])
    texts = {t for _, t in without_near_duplicates(df.where("doc_id <> 9")).collect()}
    assert texts == {f"{one} x0", f"{two} y0"}


def test_rich_families_without_links_are_told_by_sketches(spark, monkeypatch):
    """Texts of 12 blocks, each in one of three forms: all shingles are shared and none is alike."""
    monkeypatch.setattr(dedup, "SHORT", 8)
    measured = []
    real = dedup._measured
    monkeypatch.setattr(dedup, "_measured", lambda pairs, *a, **k: (measured.append(pairs.count()), real(pairs, *a, **k))[1])
    counts = {}
    for n in (100, 200):
        rng = random.Random(n)
        blocks = [[texts_of(rng, 25) for _ in range(3)] for _ in range(12)]
        docs = [(i, " ".join(rng.choice(forms) for forms in blocks)) for i in range(n)]
        measured.clear()
        got = {r["doc_id"]: tuple(r)[1:] for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        assert got == groups_by_hand(docs)
        counts[n] = sum(measured)
    # Of 4,950 and 19,900 pairs.
    assert counts[100] < 500 and counts[200] < 2_000


def edited(rng, n, most):
    """Texts of one body, each with up to so many words changed, some in a common way."""
    base = [f"w{i}" for i in range(146)]
    docs = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(most + 1)):
            at = rng.randrange(len(text))
            text[at] = f"x{at}" if rng.random() < 0.3 else f"y{rng.randrange(10**9)}"
        docs.append((i, " ".join(text)))
    return docs


def test_a_family_of_near_copies_meets_few_times(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHORT", 8)
    met, sides = [], []
    similar, across = dedup._similar, dedup._across

    def by_leaders(pairs, *a, hot=False):
        met.append(pairs.count() if hot else 0)
        return similar(pairs, *a, hot=hot)

    def copied(rows):
        out = across(rows)
        sides.append(out.count())
        return out

    monkeypatch.setattr(dedup, "_similar", by_leaders)
    monkeypatch.setattr(dedup, "_across", copied)
    for n in (150, 300):
        docs = edited(random.Random(n), n, 6)
        met.clear(), sides.clear()
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = {r["doc_id"]: tuple(r)[1:] for r in near_duplicates(df).collect()}
        assert got == groups_by_hand(docs)
        # Of 11,175 and 44,850 pairs; each document is in up to 16 lists.
        assert sum(met) < 12 * n, met
        assert sum(sides) < 20 * n, sides


@pytest.mark.parametrize("percent", [30, 80, 85, 100])
def test_documents_of_a_home_are_linked_by_differences(spark, percent):
    rng = random.Random(percent)
    body = range(60)
    sets = {0: set(body), 500: set(range(1000, 1050))}
    homes = []
    for i in range(1, 120):
        lost = rng.sample(body, rng.randrange(12))
        sets[i] = (set(body) - set(lost)) | {rng.randrange(100, 130) for _ in range(rng.randrange(8))}
        homes.append((0, i))
    for i in range(501, 504):
        sets[i] = set(range(1000 + i - 500, 1050 + i))
        homes.append((500, i))
    df = spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "doc_id long, shingles array<long>")
    homes_df = spark.createDataFrame(homes, "home long, doc_id long")
    found = [tuple(r) for r in dedup._at_home(homes_df, df, percent).collect()]
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    assert all(alike(a, b) for a, b in found)

    def groups(links):
        group = {i: i for _, i in homes}
        for a, b in links:
            old, new = group[a], group[b]
            group = {i: new if g == old else g for i, g in group.items()}
        return {frozenset(i for i in group if group[i] == g) for g in group.values()}

    every = [(a, b) for h, a in homes for k, b in homes if h == k and a < b and alike(a, b)]
    assert groups(found) == groups(every)
    assert len(found) <= len(every)


def test_lists_of_one_home_are_not_copied_by_the_pipeline_stage(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHORT", 8)
    copied, across = [], dedup._across

    def counted(rows):
        out = across(rows)
        copied.append(out.count())
        return out

    monkeypatch.setattr(dedup, "_across", counted)
    docs = edited(random.Random(8), 300, 8)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = dict(STAGES)["minhash near-dedup"](spark, df, "").count()
    assert 1 < kept < 300
    # Each document is in up to 20 lists.
    assert len(copied) == 1 and copied[0] < 20 * 300, copied


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(1, 60)] + [(100 + rng.randrange(40), 100) for _ in range(60)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r["id"]: r["component"] for r in rows}
    assert len(rows) == len(found)
    assert {i: found[i] for i in range(1, 61)} == dict.fromkeys(range(1, 61), 1)
    assert {c for i, c in found.items() if i >= 100} == {100}


ITEM = (
    "Tom has 3 apples and gives 2 apples to Anna before he walks 5 km home. "
    "How many apples are left with Tom?"
)


def test_leaks(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, ITEM), (2, "short one"), (3, None), (4, ""), (None, "9 9 9")], "item_id long, text string"
    )
    other = ITEM.replace("Tom", "Mary").replace("3", "1,250.5").replace("5 km", "7miles")
    docs = [
        (1, f"Intro text. {ITEM} And so on."),
        (2, f"Other words first. {other}"),
        (3, ITEM.replace("3", "8").replace("How many apples", "What number of pears")),
        (4, "Tom has 3 apples and gives 2"),
        (5, "Short, one!"),
        (6, "this is a short one"),
        (7, None),
        (8, " ".join("1 2 3 4 5 6 7 8 9".split() * 5)),
        (None, ITEM.upper()),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {(r["doc_id"], r["item_id"]): r for r in find_leaks(df.union(df), bench).collect()}
    assert {k for k in rows if k[0]} == {(1, 1), (2, 1), (3, 1), (5, 2)}
    assert rows[1, 1]["changed"] == 0 and rows[1, 1]["start"] == 2
    assert rows[2, 1]["changed"] >= 3
    assert {r["doc_id"] for r in without_leaks(df, bench).collect()} - {None} == {4, 6, 7, 8}
    assert find_leaks(no_docs, bench).count() == find_leaks(df, bench.limit(0)).count() == 0
    assert without_leaks(odd_docs, bench).columns == odd_docs.columns
    assert without_leaks(odd_docs, bench).count() == odd_docs.count()


def test_contradicting_slots_do_not_count(spark):
    item = " ".join(f"from {a} to {b} by" for a, b in ((1, 1), (1, 1), (1, 1)))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = re.sub("1", "7", item)
    mixed = re.sub("1", lambda m, n=iter(range(10, 99)): str(next(n)), item)
    docs = spark.createDataFrame([(1, same), (2, mixed)], "doc_id long, text string")
    assert [r["doc_id"] for r in find_leaks(docs, bench).collect()] == [1]


SLOTS = [
    "Find the sum of 12, 15, 18, 21, 24 and 30.",
    "Evaluate 3 + 4 - 5 * 6 / 7 + 8 - 9 + 10 * 11 - 12 + 13.",
    "Sort these: 9 4 7 1 8 2 6 3 5 12 11 10 from least to greatest.",
]


def found(spark, items, docs):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in find_leaks(df, bench).collect()}


def test_items_of_many_slots_are_found(spark):
    docs = [f"Some words first. {x} And more." for x in SLOTS]
    docs += ["Find the sum of 1, 2, 3, 4, 5 and 6.", SLOTS[1].replace("8", "80"), "1 2 3 4 5 6 7 8 9 10 11 12 13"]
    assert found(spark, SLOTS, docs) == {(0, 0), (1, 1), (2, 2), (3, 0)}


WORDS = "a farmer drives slowly past his old barn and then stops near the wide river to look for lost sheep today".split()


def test_changed_places_leave_a_leak(spark):
    long, middle = " ".join(WORDS), " ".join(WORDS[:16])
    named = "the cook met Tom at noon and then Tom paid for all of the bread"
    capital = "Where did all of the old wooden boats go after the storm"
    short = "which rivers flow past our farm"
    items = [long, middle, named, capital, short]
    docs = [
        " ".join([*WORDS[:10], "suddenly", *WORDS[10:]]),
        " ".join([*WORDS[:8], "changed", *WORDS[9:16]]),
        named.replace("Tom", "Mary Ann Smith"),
        f"we read that {capital} and so on",
        f"he asked, {short}, again",
        " ".join(WORDS[:11]),
        "which rivers flow past our town",
    ]
    assert found(spark, items, docs) == {(0, 0), (0, 1), (1, 1), (1, 0), (2, 2), (3, 3), (4, 4)}


def lines_by_hand(docs, min_docs):
    strip = " \t\n\x0b\f\r"

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(strip))

    documents = {}
    for i, text in docs:
        if i is not None:
            for x in (text or "").split("\n"):
                documents.setdefault(key(x), set()).add(i)
    seen = {k: len(ids) for k, ids in documents.items()}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or seen.get(key(x), 0) < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_lines(spark, odd_docs, no_docs):
    rng = random.Random(3)
    pool = ["Share", " share\t", "é É", "É é", "", "  ", "own", "x\ry"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(40)]
    docs += [(40, None), (None, "share\nshare"), (7, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = drop_common_lines(df, min_docs=12).collect()
    order = lambda r: (r[0] is None, r[0], *r[1:])
    assert sorted(map(tuple, rows), key=order) == sorted(lines_by_hand(docs, 12), key=order)
    got = {r["doc_id"]: r for r in drop_common_lines(odd_docs, min_docs=2).collect()}
    assert got[2]["n_dropped"] == 1 and got[7]["n_lines"] == 3 and got[7]["n_dropped"] == 0
    # One document on many rows is one document.
    one = spark.createDataFrame([(1, "a\nb")] * 10 + [(2, "b")] + [(None, "a")] * 9, "doc_id long, text string")
    assert {r["n_dropped"] for r in drop_common_lines(one, min_docs=3).collect()} == {0}
    assert sorted(r["n_dropped"] for r in drop_common_lines(one, min_docs=2).collect()) == [0] * 9 + [1] * 11
    assert drop_common_lines(no_docs).count() == 0
    assert hashlib.sha256(got[6]["text"].encode()).hexdigest()
