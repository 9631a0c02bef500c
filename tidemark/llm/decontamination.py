"""Documents that hold benchmark items, as they are or with other numbers, names and units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

# Tokens of a window, and how many of them must be words for placeholders to stand for any value.
WINDOW, LITERALS = 8, 4
# Matching tokens that make a leak; shorter items must match whole.
LEAK = 13
# Tokens that may come in or fall out within an item, and the least run that counts beside them.
SHIFT, RUN = 8, 3
# Rows of one long each that may be broadcast (16 MB).
BROADCAST_ROWS = 1_000_000

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour "
    "hours day days week weeks month months year years percent dollar dollars euro euros cent cents "
    "degree degrees mph kmh w kw v hz mb gb tb"
).split()

# Marks put into texts: a name follows, a unit follows, a separator within a number.
NAME, UNIT, POINT = "\x01", "\x02", "\x03"


def tokens(text: Column) -> Column:
    """Lower-cased words of a text, slots marked.

    A slot is a word that sorts before a colon: a number begins with a digit, a name or a unit
    with its mark. Names are capitalised words, but at the start of a sentence; units are
    known words right after a number. Two or three capitalised words in a row are one name, that of
    the first. Punctuation separates words and is dropped. NULL has no
    words.
    """
    text = F.coalesce(text, F.lit(""))
    numbers = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", POINT)
    units = rf"(?i)(?<=\d)\s?\b?({'|'.join(UNITS)})\b"
    marked = F.when(text.rlike(r"\d"), F.regexp_replace(numbers, units, f" {UNIT}$1"))
    marked = marked.otherwise(text)
    named = F.regexp_replace(marked, r"(?=\p{Lu}\p{Ll})(?<=[^.!?:\s]\s{1,3})", NAME)
    word = r"\x01[\p{L}\p{M}\p{N}]++"
    named = F.regexp_replace(named, rf"({word})(?:\s{{1,3}}{word}){{1,2}}+(?!\s{{1,3}}\x01)", "$1")
    parts = F.split(F.lower(named), r"[^\p{L}\p{M}\p{N}\x01-\x03]+")
    return F.array_remove(parts, "")


def is_slot(token: Column) -> Column:
    return token < ":"


def _kind(slot: Column) -> Column:
    """The type of a slot."""
    return F.when(slot < UNIT, 1).when(slot < POINT, 2).otherwise(3)


def _template(token: Column) -> Column:
    """Hash of a word, or the type of a slot."""
    return F.when(is_slot(token), _kind(token).cast("long")).otherwise(F.xxhash64(token))


def _windows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``windows``, the hashes of all runs of tokens, to rows with ``tokens``.

    A window with enough words is hashed with placeholders, any other with the values of its
    slots. Windows double from one token to eight. A text of fewer tokens is one window, with
    placeholders. ``lengths`` are those of short items, which have windows of their own.
    Windows are structs of the hash, the place and whether placeholders stand in it.
    They are for an outer explode: an inner one would first ask for their number, computing
    them twice.
    """
    one = F.transform(
        "tokens",
        lambda t: F.struct(
            _template(t).alias("t"), F.xxhash64(t).alias("e"), (~is_slot(t)).cast("int").alias("words")
        ),
    )
    rows = rows.withColumn("w", one).withColumn("one", F.col("w"))
    size = 1
    while size < WINDOW:
        n = F.greatest(F.size("w") - size, F.lit(0))
        joined = F.zip_with(
            F.slice("w", 1, n),
            F.slice("w", size + 1, n),
            lambda a, b: F.struct(
                F.xxhash64(a["t"], b["t"]).alias("t"),
                F.xxhash64(a["e"], b["e"]).alias("e"),
                (a["words"] + b["words"]).alias("words"),
            ),
        )
        rows = rows.withColumn("w", joined)
        size *= 2

    def window(x: Column, pos: Column) -> Column:
        good = x["words"] >= LITERALS
        code = F.when(good, x["t"]).otherwise(F.xxhash64(F.lit("values"), x["e"]))
        return F.struct(code.alias("window"), pos.alias("pos"), good.alias("good"))

    def own(length: int) -> Column:
        """All windows of one length under eight."""

        def at(i: Column) -> Column:
            part = F.slice("one", i + 1, length)
            words = F.aggregate(part, F.lit(0), lambda n, x: n + x["words"])
            t = F.xxhash64(F.lit(length), F.transform(part, lambda x: x["t"]))
            e = F.xxhash64(F.lit(length), F.transform(part, lambda x: x["e"]))
            x = F.struct(F.xxhash64(F.lit("own"), t).alias("t"), e.alias("e"), words.alias("words"))
            return window(x, i)

        places = F.sequence(F.lit(0), F.size("one") - length)
        none = F.array().cast("array<struct<window:bigint,pos:int,good:boolean>>")
        return F.when(F.size("one") >= length, F.transform(places, at)).otherwise(none)

    few = F.xxhash64(F.size("one"), F.transform("one", lambda x: x["t"]))
    few = F.array(F.struct(few.alias("window"), F.lit(0).alias("pos"), F.lit(True).alias("good")))
    none = F.array().cast("array<struct<window:bigint,pos:int,good:boolean>>")
    whole = F.when(F.size("one") > 0, few).otherwise(none)
    windows = F.when(F.size("one") >= WINDOW, F.transform("w", window)).otherwise(whole)
    for length in lengths:
        windows = F.concat(windows, own(length))
    return rows.withColumn("windows", windows).drop("w", "one")


def _few(rows: DataFrame) -> DataFrame:
    """Broadcast after a count that keeps within the bound; left to Spark beyond it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _forms(text: Column) -> Column:
    """An item's tokens as at the start of a sentence, and as within one if that differs."""
    start = tokens(text)
    within = tokens(F.concat(F.lit("- "), F.ltrim(text)))
    return F.array_distinct(F.array(start, within))


def _benchmark_windows(items: DataFrame, lengths: list[int]) -> DataFrame:
    """``window, item, at, good`` of all windows; short items have those of their length, too."""
    items = items.withColumn("size", F.size("tokens"))
    rows = _windows(items.where(~F.col("size").isin(lengths)), [])
    for length in lengths:
        rows = rows.unionByName(_windows(items.where(F.col("size") == length), [length]))
    words = F.size(F.filter("tokens", lambda t: ~is_slot(t)))
    enough = words >= F.least(F.lit(LITERALS), F.ceil(F.col("size") / 2))
    rows = rows.select("item", enough.alias("enough"), F.explode("windows").alias("w"))
    rows = rows.where(~F.col("w.good") | F.col("enough"))
    return rows.select("w.window", "item", F.col("w.pos").alias("at"), "w.good")


def _row_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    Numbers, names and units become typed placeholders, and windows of eight template tokens
    are joined by hash; windows of fewer than four words keep the values of their slots. What
    an item's window hits is aligned as a whole and compared token by token. Tokens missed
    there are looked for up to eight places before and after, where words may have come in or
    fallen out, in runs of three. Where only windows with values hit, other values do not match.
    A slot whose value in the item stands against different values in the document contradicts
    itself and does not count. A pair is a leak if at least 13 tokens count, or all tokens of a
    shorter item. An item's first word is taken as at the start of a sentence and as within one.

    ``docs`` has ``doc_id, text`` and ``benchmark`` has ``item_id, text``. Returns, once per
    pair, ``doc_id, item_id, matched`` tokens, ``item_tokens, start`` (the token of the
    document where the item would begin, from 0), ``slots`` that match and ``changed``, those
    of them with another value: 0 for a verbatim copy.

    NULL and empty texts, and texts without words, hold nothing and are held by nothing. An
    item of four to seven tokens has windows of its own length; one of fewer says too little
    and is only found in documents that are nothing else. NULL ids are kept. Repeated rows, of either table, give one pair. Items that are alike are each
    reported. Empty tables give no rows. Other columns are not read.
    """
    return _leaks(docs, benchmark).drop("row")


def _matches() -> Column:
    """For each token of the item, its place in ``part`` less that by the alignment, or NULL.

    ``part`` is the document around the item, which would begin there at ``base``.
    """

    def alike(p: Column, x: Column, shift: Column) -> Column:
        at = F.col("base") + p + shift
        y = F.when(at >= 0, F.get("part", at))
        kind = is_slot(x) & is_slot(y) & (_kind(x) == _kind(y))
        return F.coalesce((x == y) | (F.col("good") & kind), F.lit(False))

    def in_runs(shift: Column) -> Column:
        found = F.transform("tokens", lambda x, p: alike(p, x, shift))

        def at(m: Column, p: Column) -> Column:
            return F.when(p >= 0, F.coalesce(F.get(m, p), F.lit(False))).otherwise(F.lit(False))

        def of_run(m: Column) -> Column:
            def within(hit: Column, p: Column) -> Column:
                runs = F.lit(False)
                for first in range(1 - RUN, 1):
                    run = F.lit(True)
                    for i in range(first, first + RUN):
                        run = run & at(m, p + i)
                    runs = runs | run
                return hit & runs

            return F.transform(m, within)

        # The one-element array binds the array to a variable, so that it is computed once.
        return F.element_at(F.transform(F.array(found), of_run), 1)

    straight = F.transform("tokens", lambda x, p: F.when(alike(p, x, F.lit(0)), F.lit(0)))
    shifts = F.array(*[F.lit(s * i) for i in range(1, SHIFT + 1) for s in (1, -1)])
    shifted = F.aggregate(
        shifts,
        straight,
        lambda done, shift: F.zip_with(
            done, in_runs(shift), lambda d, hit: F.coalesce(d, F.when(hit, shift))
        ),
    )
    return F.when(F.exists(straight, lambda d: d.isNull()), shifted).otherwise(straight)


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    forms = benchmark.select("item_id", _forms(F.col("text")).alias("forms"))
    items = forms.where(F.size(F.col("forms")[0]) > 0).distinct()
    items = items.select(
        "item_id", F.xxhash64("item_id", "forms").alias("origin"), F.explode("forms").alias("tokens")
    )
    items = store(items.withColumn("item", F.xxhash64("origin", "tokens")))
    sizes = items.select(F.size("tokens").alias("n")).where(F.col("n").between(LITERALS, WINDOW - 1))
    lengths = sorted(r["n"] for r in sizes.distinct().collect())
    windows = store(_benchmark_windows(items, lengths))

    rows = _row_key(docs)
    split = rows.select("row", tokens(F.col("text")).alias("tokens"))
    placed = _windows(split, lengths).select("row", F.explode_outer("windows").alias("w"))
    placed = placed.select("row", "w.pos", "w.window")
    hits = placed.join(_few(windows.select("window").distinct()), "window", "left_semi")
    hits = store(hits.distinct())

    apart = F.col("pos") - F.col("at")
    runs = hits.join(windows, "window").groupBy("row", "item", apart.alias("apart"))
    runs = runs.agg(F.max("good").alias("good"))
    hit_rows = _few(hits.select("row").distinct())
    texts = rows.join(hit_rows, "row", "left_semi").dropDuplicates(["row"])
    texts = texts.select("row", "doc_id", tokens(F.col("text")).alias("found"))
    aligned = runs.join(items, "item").join(texts, "row")
    first = F.greatest(F.col("apart") - SHIFT, F.lit(0))
    length = F.greatest(F.col("apart") + F.size("tokens") + SHIFT - first, F.lit(0))
    aligned = aligned.withColumns(
        {"part": F.slice("found", first + 1, length), "base": F.col("apart") - first}
    )
    aligned = store(aligned.drop("found"))

    aligned = store(aligned.withColumn("matches", _matches()))
    counted = F.filter(
        F.transform(
            "tokens",
            lambda x, p: F.struct(
                x.alias("x"),
                (F.col("base") + p + F.get("matches", p)).alias("at"),
                F.get("part", F.col("base") + p + F.get("matches", p)).alias("y"),
            ),
        ),
        lambda m: m["at"].isNotNull(),
    )
    aligned = aligned.withColumn("counted", counted)
    pairs = F.transform(
        F.filter("counted", lambda m: is_slot(m["x"])),
        lambda m: F.struct(m["x"].alias("x"), m["y"].alias("y")),
    )
    aligned = aligned.withColumn("pairs", pairs).withColumn("kinds", F.array_distinct("pairs"))
    agrees = F.filter(
        "pairs",
        lambda p: F.forall("kinds", lambda q: (q["x"] != p["x"]) | (q["y"] == p["y"])),
    )
    aligned = aligned.withColumn("agreeing", agrees)
    # A token of the document counts once, though shifted places may share it.
    places = F.size(F.array_distinct(F.transform("counted", lambda m: m["at"])))
    matched = F.size("counted") - F.size("pairs") + F.size("agreeing")
    aligned = aligned.withColumn("matched", F.least(matched, places))
    leak = F.col("matched") >= F.least(F.lit(LEAK), F.size("tokens"))
    straight = F.size(F.filter("matches", lambda d: d == 0))
    best = Window.partitionBy("row", "origin").orderBy(
        F.desc("matched"), F.desc(straight), "apart", "item"
    )
    leaks = aligned.where(leak).withColumn("nth", F.row_number().over(best)).where("nth = 1")
    changed = F.filter("agreeing", lambda p: p["x"] != p["y"])
    return leaks.select(
        "row",
        "doc_id",
        "item_id",
        "matched",
        F.size("tokens").alias("item_tokens"),
        F.col("apart").alias("start"),
        F.size("agreeing").alias("slots"),
        F.size(changed).alias("changed"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Rows are told apart by id and text, so a row without an id is judged like any other.
    """
    leaks = _leaks(docs, benchmark).select("row").distinct()
    return docs.join(leaks, F.xxhash64(docs["doc_id"], docs["text"]) == leaks["row"], "left_anti")
