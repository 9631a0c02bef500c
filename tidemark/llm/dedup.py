"""Near-duplicate documents by bottom-k sketches and exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import lookup, store
from tidemark.llm.graph import components
from tidemark.llm.tokens import mix, words

SHINGLE = 5
# Values of a sketch, and the smallest of them that have inverted lists.
SKETCH, LISTED = 64, 32
# A list up to this long gives all its pairs; longer ones go by leaders.
SHORT = 48
# A leader is home to documents at least this many percent like it, if links need as many.
HOME = 50
# Accepted chance that a link does not show in lists.
MISSED = 3e-7
# Linked if intersection / union is at least this many percent, unless a caller says otherwise.
PERCENT = 85


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text, as 63-bit hashes."""
    hashes, at = words(texts)
    shingles = np.zeros(max(len(hashes) - SHINGLE + 1, 0), np.uint64)
    for i in range(SHINGLE):
        shingles = (shingles + hashes[i : i + len(shingles)]) * np.uint64(0xD6E8FEB86659FD93)
    shingles = (mix(shingles) >> np.uint64(1)).astype(np.int64)
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        if end - begin >= SHINGLE:
            yield np.unique(shingles[begin : end - SHINGLE + 1])
        elif end > begin:
            whole = np.array([end - begin], np.uint64)
            for h in hashes[begin:end]:
                whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + h)
            yield (whole >> np.uint64(1)).astype(np.int64)
        else:
            yield np.zeros(0, np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sums(shingles: np.ndarray) -> tuple[np.int64, np.int64]:
    """Sums of hashes: equal sets, and no others, have equal sums."""
    x = shingles.view(np.uint64)
    first = mix(x + np.uint64(1)).sum(dtype=np.uint64)
    second = mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return first.view(np.int64), second.view(np.int64)


def _own_node(sums: tuple[np.int64, np.int64]) -> int:
    """The node of a text whose id is on several rows, a negative number."""
    both = mix(np.array(sums, np.int64).view(np.uint64))
    return -1 - int((both[0] ^ mix(both[1:] + np.uint64(1))[0]) >> np.uint64(1))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(_shingle_sets(batch.column(1)))
        sums = [_sums(shingles) for shingles in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(shingles) for shingles in found], pa.int64()),
                pa.array([s[0] for s in sums], pa.int64()),
                pa.array([s[1] for s in sums], pa.int64()),
                pa.array(map(_own_node, sums), pa.int64()),
                # Copies, so that whole sets are let go.
                _lists([shingles[:SKETCH].copy() for shingles in found]),
            ],
            names=["doc_id", "n", "s1", "s2", "own", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # In small blocks, as sets are larger than texts.
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            sets = list(_shingle_sets(part.column(1)))
            ids = [
                _own_node(_sums(shingles)) if many else i
                for i, many, shingles in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), sets)
            ]
            columns = [pa.array(ids, pa.int64()), _lists(sets)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shingles"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number and the sums of their shingles."""
    for batch in batches:
        found = [(len(x), *_sums(x)) for x in _shingle_sets(batch.column("text"))]
        columns = [pa.array(list(column), pa.int64()) for column in zip(*found)] or [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *columns], names=[*batch.schema.names, "_n", "_s1", "_s2"]
        )


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from the k smallest values of the union of two sketches."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def _measured(pairs: DataFrame, sets: DataFrame, percent: int, hot: bool = False) -> DataFrame:
    """The pairs ``a, b`` that are ``percent`` alike by their full sets, with ``both, either``,
    the sizes of intersection and union."""
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - F.col("both")
    measured = _with_sides(pairs, sets, "shingles", hot).withColumn("both", both)
    measured = measured.select("a", "b", "both", either.alias("either"))
    return measured.where(100 * F.col("both") >= percent * F.col("either"))


def _with_sides(pairs: DataFrame, source: DataFrame, column: str, hot: bool) -> DataFrame:
    """Adds what ``source`` has for ``a`` and ``b``. If ``hot``, one ``a`` may have very many
    pairs, and they are dealt to several tasks."""
    left = source.select(F.col("doc_id").alias("a"), F.col(column).alias("x"))
    right = source.select(F.col("doc_id").alias("b"), F.col(column).alias("y"))
    if hot:
        left = left.join(pairs.select("a").distinct(), "a", "left_semi")
        return lookup(pairs, left, ["a"], "inner").join(right, "b")
    return pairs.join(left, "a").join(right, "b")


def _short_pairs(index: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet in a short list and look similar by their sketches."""
    left = index.select("v", F.col("doc_id").alias("a"), F.col("n").alias("na"))
    right = index.select("v", F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & _near_in_size(F.col("na"), F.col("nb"), percent)
    pairs = left.join(right, "v").where(fits).select("a", "b").distinct()
    return _similar(pairs, sketches, percent)


def _similar(pairs: DataFrame, sketches: DataFrame, percent: int, hot: bool = False) -> DataFrame:
    least = (SKETCH + 1 - _never_lacking(SKETCH, percent)) / SKETCH
    near = _estimate(F.col("x"), F.col("y")) >= least
    return _with_sides(pairs, sketches, "sketch", hot).where(near).select("a", "b")


def _never_lacking(values: int, percent: int) -> int:
    """So many of a sketch's values that a partner as good as never lacks them all, or more.

    Whatever the lists look like, the values that one of two texts has and the other lacks are
    a binomial draw at most.
    """
    lack, tail = 1 - percent / 100, 0.0
    for x in range(values, 0, -1):
        tail += comb(values, x) * lack**x * (1 - lack) ** (values - x)
        if tail > MISSED:
            return x + 1
    return 1


def _leading(percent: int) -> int:
    """Lists in which a document leads: so many that a partner as good as never lacks them all."""
    return max(1, ceil(log(MISSED) / log(1 - percent / 100))) if percent < 100 else 1


def _long_list_members(counted: DataFrame, percent: int) -> DataFrame:
    """Rows of long lists whose documents might have a partner that no short list shows.

    A document meets its partners in short lists if more of its values are there, or alone,
    than a partner can lack. The values that are short may be just those that a partner lacks,
    as where many texts hold one body, so each of them says nothing by itself: only their
    number does. Not listed by both are at most as many as the shingles that only one has,
    which is an exact bound for small texts.
    """
    long = counted.where(F.col("m") > SHORT)
    per = long.groupBy("doc_id", "n").agg(F.count("*").alias("long"))
    short = F.least(F.col("n"), F.lit(LISTED)) - F.col("long")
    lacking = F.floor((100 - percent) * F.col("n") / percent)
    enough = F.least(F.lit(_never_lacking(LISTED, percent)), lacking + 1)
    members = per.where(short < enough).select("doc_id")
    return long.join(members, "doc_id", "left_semi").select("v", "doc_id", "n")


def _with_shared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``doc_id, n, shared, lists`` of the members that can have a link among themselves.

    ``shared`` is how many of a document's shingles any other member has, and ``lists`` are
    the long lists in which it may be met, in order. What two texts have in common is shared,
    and a link needs ``percent`` of either text in common: who shares less has none.
    """
    ids = members.select("doc_id").distinct()
    own = sets.join(ids, "doc_id", "left_semi").select("doc_id", F.explode("shingles").alias("w"))
    held = own.groupBy("w").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    shared = lookup(own, held, ["w"], "inner").groupBy("doc_id").agg(F.count("*").alias("shared"))
    # Of each document LISTED values have lists.
    docs = members.groupBy("doc_id", "n").agg(F.array_sort(F.collect_list("v")).alias("lists"))
    lists = F.slice("lists", 1, 2 * _leading(percent))
    docs = docs.withColumn("lists", lists).join(shared, "doc_id")
    docs = docs.where(100 * F.col("shared") >= percent * F.col("n"))
    return docs.select("doc_id", "n", "shared", "lists")


def _may_link(a: tuple[Column, Column], b: tuple[Column, Column], percent: int) -> Column:
    """Whether documents of such size and shared shingles can be ``percent`` alike at all.

    They have at most the lesser number of shared shingles in common.
    """
    common = F.least(a[1], b[1])
    return (100 + percent) * common >= percent * (a[0] + b[0])


def _across(rows: DataFrame) -> DataFrame:
    """Rows of lists with keys by which only rows of different components meet.

    Components of a list are numbered. Two numbers differ first in one binary digit: there they
    agree in the ``rest`` below it, and have opposite values of ``bit``. Each pair of different
    components meets once, and lists of one component are left out.
    """
    each = rows.select("v", "component").distinct()
    per_list = Window.partitionBy("v")
    number = F.row_number().over(per_list.orderBy("component")) - 1
    each = each.withColumns({"number": number, "most": F.count("*").over(per_list)})
    each = each.where(F.col("most") > 1)
    numbered = lookup(rows, each, ["v", "component"], "inner")
    digits = F.sequence(F.lit(0), F.ceil(F.log2("most")).cast("int") - 1)
    numbered = numbered.withColumn("digit", F.explode(digits))
    above = F.call_function("shiftright", F.col("number"), F.col("digit"))
    rest = F.col("number") - F.call_function("shiftleft", above, F.col("digit"))
    return numbered.withColumns({"bit": above.bitwiseAND(1), "rest": rest}).drop("number", "most")


def _homes(found: DataFrame) -> DataFrame:
    """``home, doc_id``: of the leaders ``a`` that a document ``b`` is like, the one of the most
    documents, so that a family has one home."""
    size = found.groupBy("a").agg(F.count("*").alias("size"))
    sized = lookup(found.select("a", "b"), size, ["a"], "inner")
    best = sized.groupBy("b").agg(F.min(F.struct((-F.col("size")).alias("size"), "a")).alias("best"))
    return best.select(F.col("best.a").alias("home"), F.col("b").alias("doc_id"))


def _differing(x: Column, y: Column) -> Column:
    """What is in one of two arrays only."""
    return F.array_union(F.array_except(x, y), F.array_except(y, x))


def _at_home(homes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that connect what is linked among the documents of each home.

    A document is told by how it differs from the home's middle, the set of what more than half
    of the home's documents have. Two documents differ by what is in one of their differences
    only: with ``off``, (100 + percent) times a difference's size less (100 - percent) times the
    document's, they are linked exactly if ``off`` of both is 2 * (100 + percent) times what
    their differences have in common, or less. So all that can do without anything in common are
    linked to the document of the least ``off``, and the others, loose, need so much in common
    that pairs show in the rarest of it, by prefixes.
    """
    unit = 2 * (100 + percent)
    pairs = homes.select(F.col("home").alias("a"), F.col("doc_id").alias("b"))
    differing = _differing(F.col("x"), F.col("y")).alias("differs")
    own = _with_sides(pairs, sets, "shingles", hot=True)
    own = store(own.select(F.col("a").alias("home"), F.col("b").alias("doc_id"), F.size("y").alias("n"), differing))
    docs = own.groupBy("home").agg(F.count("*").alias("docs"))
    held = own.select("home", F.explode("differs").alias("w")).groupBy("home", "w").agg(F.count("*").alias("held"))
    middle = lookup(held, docs, ["home"], "inner").where(2 * F.col("held") > F.col("docs"))
    middle = middle.groupBy("home").agg(F.collect_list("w").alias("middle"))
    own = lookup(own, middle, ["home"], "left")
    from_middle = F.when(F.col("middle").isNull(), F.col("differs")).otherwise(
        _differing(F.col("differs"), F.col("middle"))
    )
    own = own.withColumn("differs", from_middle).drop("middle")
    off = (100 + percent) * F.size("differs") - (100 - percent) * F.col("n")
    own = store(own.select("home", "doc_id", "differs", off.cast("long").alias("off")))

    centre = own.groupBy("home").agg(F.min(F.struct("off", "doc_id")).alias("centre"))
    centre = centre.select("home", F.col("centre.off").alias("least"), F.col("centre.doc_id").alias("centre"))
    placed = lookup(own, centre, ["home"], "inner")
    placed = store(placed.withColumn("loose", F.col("off") + F.col("least") > 0))
    sure = placed.where(~F.col("loose") & (F.col("doc_id") != F.col("centre")))
    sure = sure.select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))

    # What others have too, rarest first.
    each = placed.select("home", "doc_id", "off", "least", "loose", F.explode("differs").alias("w"))
    held = each.groupBy("home", "w").agg(F.count("*").alias("held")).where("held > 1")
    common = lookup(each, held, ["home", "w"], "inner")
    common = common.groupBy("home", "doc_id", "off", "least", "loose").agg(
        F.array_sort(F.collect_list(F.struct("held", "w"))).alias("common")
    )
    # The least that a link needs in common: a loose document with any, the others with a loose one.
    needs = lambda other: F.greatest(F.lit(1), F.ceil((F.col("off") + F.col(other)) / unit))
    common = store(common.where(~F.col("loose") | (F.size("common") >= needs("least"))))
    looser = common.where("loose").groupBy("home").agg(F.min("off").alias("looser"))
    common = lookup(common, looser, ["home"], "inner")
    common = common.withColumn("needed", F.when(F.col("loose"), needs("least")).otherwise(needs("looser")).cast("int"))
    common = common.where(F.size("common") >= F.col("needed"))
    prefix = F.slice("common", F.lit(1), F.size("common") - F.col("needed") + 1)
    each = common.select("home", "doc_id", "off", "loose", F.size("common").alias("size"), F.posexplode(prefix).alias("at", "x"))
    # So much may come from the first that two have in common on.
    each = store(each.select("home", F.col("x.w").alias("w"), "doc_id", "off", "loose", (F.col("size") - F.col("at")).alias("rest")))
    left = each.where("loose").select("home", "w", F.col("doc_id").alias("a"), F.col("off").alias("oa"), F.col("rest").alias("ra"))
    right = each.select("home", "w", F.col("doc_id").alias("b"), F.col("off").alias("ob"), F.col("rest").alias("rb"), "loose")
    once = (F.col("a") < F.col("b")) | (~F.col("loose") & (F.col("a") != F.col("b")))
    needed = F.col("oa") + F.col("ob")
    fits = once & (unit * F.least("ra", "rb") >= needed)
    pairs = left.join(right, ["home", "w"]).where(fits).select("a", "b", needed.alias("needed")).distinct()
    both = F.size(F.array_intersect("x", "y"))
    met = _with_sides(store(pairs), own, "differs", hot=True).where(unit * both >= F.col("needed"))
    return sure.unionByName(met.select("a", "b"))


def _by_leaders(
    members: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links among the members of long lists, without all pairs of a list.

    Shingles that no other member has bound what a document can have in common with others,
    and the smaller document of a link must have few of them. Such rich documents lead, those
    with the least of their own first: each round some of those with one first list are held
    against their lists, by sketches and then by full sets, eight times as many as in the round
    before, and members that are at home with a leader lead no more. Documents of one home are
    linked by how they differ from it. At last rich documents meet those of other homes and
    components that they can link with by numbers alone; that leaves no link out.

    A document leads in the first of its lists, eight at 85 percent, and is met in twice as
    many, lists being in one order for all; a partner misses all of them as rarely as sketches
    fail each other. Between the joins there is one row for each document.
    """
    most, at_home = _leading(percent), min(HOME, percent)
    docs = store(_with_shared(members, sets, percent))
    rich = (100 + percent) * F.col("shared") >= 2 * percent * F.col("n")
    led = F.slice("lists", 1, most).alias("led")
    by_own = Window.partitionBy("v").orderBy(F.desc(F.col("shared") / F.col("n")), "doc_id")
    of_a = (F.col("na"), F.col("sa"))
    of_b = (F.col("n"), F.col("shared"))
    names = [F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"), led]
    # A pair meets in the first list of both only.
    here = F.array_min(F.array_intersect("led", "lists")) == F.col("v")

    # Documents that may still lead, and those that have not met all leaders.
    ready, waiting, per_list = docs.where(rich), docs, 1
    alike = []
    while True:
        # By the first list of each, so that a family has few leaders.
        ranked = ready.select("doc_id", "n", "shared", F.get("lists", F.lit(0)).alias("v"))
        ranked = ranked.withColumn("rank", F.row_number().over(by_own))
        chosen = store(ranked.where(F.col("rank") <= per_list).select("doc_id").distinct())
        if chosen.isEmpty():
            break
        leaders = ready.join(chosen, "doc_id", "left_semi").select(*names)
        leaders = leaders.select("*", F.explode("led").alias("v"))
        mates = waiting.join(chosen.withColumn("leads", F.lit(True)), "doc_id", "left")
        met = lookup(mates.select("*", F.explode("lists").alias("v")), leaders, ["v"], "inner")
        once = F.col("leads").isNull() | (F.col("a") < F.col("doc_id"))
        # Who cannot link with a leader may have it for a home.
        like = 100 * F.least("na", "n") >= at_home * F.greatest("na", "n")
        met = met.where((_may_link(of_a, of_b, percent) | like) & once & (F.col("a") != F.col("doc_id")) & here)
        pairs = store(met.select("a", F.col("doc_id").alias("b")).distinct())
        near = store(_similar(pairs, sketches, percent, hot=True))
        found = store(_measured(near, sets, at_home, hot=True))
        alike.append(found)
        housed = found.select(F.col("b").alias("doc_id")).unionByName(chosen).distinct()
        ready = store(ready.join(housed, "doc_id", "left_anti"))
        waiting = store(waiting.join(chosen, "doc_id", "left_anti"))
        per_list *= 8

    if not alike:
        return docs.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0)
    found = reduce(DataFrame.unionByName, alike)
    links = found.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")
    # Leaders have met everyone; what waits may still have links among itself.
    homes = store(_homes(found.join(waiting.select(F.col("doc_id").alias("b")), "b", "left_semi")))
    links = store(links.unionByName(_at_home(homes, sets, percent)))
    groups = components(links).withColumnRenamed("id", "doc_id").withColumnRenamed("component", "grp")
    placed = waiting.join(groups, "doc_id", "left").withColumn("grp", F.coalesce("grp", "doc_id"))
    # Documents without a home are not rich, and have no link among themselves.
    home = F.coalesce(F.col("home").cast("string"), F.lit("")).alias("component")
    placed = placed.join(homes, "doc_id", "left").select("doc_id", "n", "shared", "lists", "grp", home)
    placed = store(placed.select("*", rich.alias("rich"), F.explode("lists").alias("v")))
    leads = F.col("rich") & F.array_contains(F.slice("lists", 1, most), F.col("v"))
    # Lists in which nobody is left to lead show no pair.
    sides = _across(lookup(placed, placed.where(leads).select("v").distinct(), ["v"], "left_semi"))
    left = sides.where(leads).select("v", "digit", "rest", "bit", F.col("grp").alias("ga"), *names)
    right = sides.withColumn("bit", 1 - F.col("bit"))
    right = right.select("v", "digit", "rest", "bit", "doc_id", "n", "shared", "lists", "grp")
    smaller = (F.col("na") < F.col("n")) | ((F.col("na") == F.col("n")) & (F.col("a") < F.col("doc_id")))
    apart = smaller & (F.col("ga") != F.col("grp")) & _may_link(of_a, of_b, percent) & here
    # Sizes of a link are in one class or in neighbouring ones, each class a step of the ratio.
    step = log(100 / percent) if percent < 100 else 1.0
    size = F.floor(F.log("n") / step + 1e-9)
    left = left.withColumn("size", F.explode(F.array(*[F.floor(F.log("na") / step + 1e-9) + i for i in (0, 1)])))
    right = right.withColumn("size", size)
    pairs = left.join(right, ["v", "digit", "rest", "bit", "size"]).where(apart)
    pairs = store(pairs.select("a", F.col("doc_id").alias("b")).distinct())
    near = store(_similar(pairs, sketches, percent, hot=True))
    return links.unionByName(store(_measured(near, sets, percent, hot=True)).select("a", "b"))


def _grouped(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``doc_id, n, s1, s2``, classes of equal sets ``n, s1, s2, component, grp``, and the
    ids that are on several rows. ``component`` is the least id of the group ``grp``; texts of
    one id may be in several groups."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is not in (0, 100]: {percent}")
    schema = "doc_id long, n long, s1 long, s2 long, own long, sketch array<long>"
    seen = store(texts.mapInArrow(_sketches, schema))
    key = ["s1", "s2", "n"]
    real = seen.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    repeated = real.groupBy("doc_id").count().where("count > 1")
    repeated = store(repeated.select("doc_id", F.lit(True).alias("many")))
    classes = real.groupBy(*key).agg(
        F.min("doc_id").alias("doc_id"), F.first("own").alias("own"), F.first("sketch").alias("sketch")
    )
    # A node is a class. The least id of its rows names it, unless other texts have that id too.
    node = F.when(F.col("many"), F.col("own")).otherwise(F.col("doc_id"))
    classes = classes.join(repeated, "doc_id", "left").withColumn("node", node)
    classes = store(classes.select(*key, "doc_id", "many", "node", "sketch"))
    sketches = classes.select(F.col("node").alias("doc_id"), "n", "sketch")

    index = sketches.select("doc_id", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("v"))
    lengths = index.groupBy("v").agg(F.count("*").alias("m")).where(F.col("m") > 1)
    counted = store(lookup(index, lengths, ["v"], "inner"))
    short = store(_short_pairs(counted.where(F.col("m") <= SHORT), sketches, percent))
    members = store(_long_list_members(counted, percent))

    wanted = short.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = wanted.unionByName(members.select(F.col("doc_id").alias("node"))).distinct()
    wanted = classes.join(wanted, "node", "left_semi")
    once = texts.join(wanted.where(F.col("many").isNull()).select("doc_id"), "doc_id", "left_semi")
    several = wanted.where("many").select("doc_id").distinct()
    several = texts.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    needed = once.withColumn("many", F.lit(False)).unionByName(several.withColumn("many", F.lit(True)))
    sets = store(needed.mapInArrow(_sets, "doc_id long, shingles array<long>"))

    links = store(_measured(short, sets, percent)).select("a", "b")
    links = links.unionByName(_by_leaders(members, sketches, sets, percent))
    groups = components(links).withColumnRenamed("id", "node")
    linked = classes.select("node", "doc_id").join(groups, "node")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("least"))
    least = linked.join(least, "component").select("node", "least", F.col("component").alias("grp"))
    classes = classes.select(*key, "doc_id", "node").join(least, "node", "left")
    component = F.coalesce("least", "doc_id").alias("component")
    return seen, classes.select(*key, component, F.coalesce("grp", "node").alias("grp")), repeated


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Groups of documents whose word shingles are at least ``percent`` alike.

    Texts are lower-cased (A-Z) and cut into words at white space; a document's set holds its
    distinct runs of five words, or all its words as one run if it has fewer. Documents are
    linked if 100 * intersection >= percent * union, and groups are the connected components.
    Returns ``doc_id, n_shingles, component_id, kept``; ``component_id`` is the least id of
    the group, and that document is kept.

    A NULL or empty text, or one of white space, has no shingles and is linked to nothing. A
    row with a NULL ``doc_id`` is linked to nothing, has a NULL ``component_id`` and is kept.
    Rows with one ``doc_id`` are grouped each by their own text; repeated rows are returned
    each. Texts of any length are read whole. An empty table gives no rows. Other columns are
    not read.

    Texts with equal sets become one class, so that copies never meet as pairs. Each class
    keeps the 64 smallest of its hashed shingles, one hash function for all. Inverted lists of
    the 32 smallest give candidates, the union of two sketches estimates their similarity, and
    what is left is measured on full sets, which are made again for candidates only. Of two
    texts ``percent`` alike, the chance that they are missed is below one in a hundred
    thousand at 80 or more: all bounds follow from the percentage. Without long lists it is
    that of 32 values lacking, 0.15 ** 32 at 85.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen, classes, _ = _grouped(texts, percent)
    found = lookup(seen.drop("sketch", "own"), classes.drop("grp"), ["s1", "s2", "n"], "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that of the least id, with all columns.

    Of several rows of that id in the group one stays: the first by its text's shingles and
    then by a hash of all columns. Rows without words, or without an id, all stay.
    """
    ids = F.col("doc_id").cast("long")
    texts = docs.select(ids.alias("doc_id"), "text")
    seen, classes, repeated = _grouped(texts, percent)
    key = ["s1", "s2", "n"]
    found = lookup(seen.select("doc_id", *key).where("n > 0"), classes, key, "inner")
    found = store(found.join(repeated, "doc_id", "left"))
    gone = found.where(F.col("many").isNull() & (F.col("doc_id") > F.col("component")))
    once = gone.select(F.col("doc_id").alias("_gone"))
    left = docs.join(once, ids == F.col("_gone"), "left_anti")

    # Rows of ids that are on several rows go by their own text.
    several = repeated.select(F.col("doc_id").alias("_many"))
    single = left.join(several, ids == F.col("_many"), "left_anti")
    rows = left.join(several, ids == F.col("_many"), "left_semi")
    keys = {"_n": "long", "_s1": "long", "_s2": "long"}
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in keys)])
    rows = rows.mapInArrow(_keyed, schema)
    named = classes.select(*[F.col(c).alias(f"_{c}") for c in (*key, "component", "grp")])
    placed = lookup(rows, named, ["_s1", "_s2", "_n"], "left")
    order = Window.partitionBy("_grp").orderBy("_s1", "_s2", "_n", F.xxhash64(*docs.columns))
    first = placed.where((F.col("_n") > 0) & (ids == F.col("_component")))
    first = first.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    empty = placed.where(F.col("_n") == 0)
    return single.unionByName(first.select(*docs.columns)).unionByName(empty.select(*docs.columns))
