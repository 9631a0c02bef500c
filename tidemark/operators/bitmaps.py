"""Activity of a player as a bitmap of days, and a stored state of it that grows by merging.

A row of bitmaps is (cohort, player_id, first_log, words, counts): bit ``d`` of ``words``, 64
days to a word, says whether the player was active ``d`` days after ``first_log``, and
``counts`` holds the sessions of those days in order. Retention of any list of days is read
from it without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.activity import player_days
from tidemark.params import ActivityParams, one_of

KEYS = ("cohort", "player_id", "first_log")
DAYS_PER_WORD = 64


def word_count(span: int) -> int:
    """Words of a bitmap for days 0 .. span - 1."""
    if span < 1:
        raise ValueError("a bitmap needs at least one day")
    return -(-span // DAYS_PER_WORD)


def _words(word: Column, bit: Column, words: int) -> Column:
    """Aggregate: the bitmap of the days of a group, by OR, so that parts of a group merge."""
    none = F.lit(0).cast("long")
    return F.array(*[F.coalesce(F.bit_or(F.when(word == w, bit)), none) for w in range(words)])


def activity_bitmaps(days: DataFrame, span: int) -> DataFrame:
    """Bitmaps of (cohort, player_id, first_log, days_to_return, daily_sessions) rows, which
    have one row per day. ``span`` bounds the day numbers; a day from there on is an error."""
    day = F.col("days_to_return")
    fits = day.between(0, word_count(span) * DAYS_PER_WORD - 1)
    late = F.concat(F.lit("a day is beyond the span of the bitmap: "), day.cast("string"))
    checked = days.withColumn("days_to_return", F.when(fits, day).otherwise(F.raise_error(late)))
    one = F.lit(1).cast("long")
    placed = checked.withColumns(
        {
            "_word": F.floor(day / DAYS_PER_WORD).cast("int"),
            "_bit": F.call_function("shiftleft", one, day % DAYS_PER_WORD),
        }
    )
    # One entry per active day at most, so bounded by the span.
    entries = F.array_sort(F.collect_list(F.struct("days_to_return", "daily_sessions")))
    maps = placed.groupBy(*KEYS).agg(
        _words(F.col("_word"), F.col("_bit"), word_count(span)).alias("words"),
        entries.alias("entries"),
    )
    return maps.select(*KEYS, "words", F.col("entries.daily_sessions").alias("counts"))


def _word(words: Column, i) -> Column:
    return F.coalesce(F.get(words, i), F.lit(0).cast("long"))


def _has(words: Column, day: int) -> Column:
    word, bit = divmod(day, DAYS_PER_WORD)
    return F.call_function("getbit", _word(words, F.lit(word)), F.lit(bit)) == 1


def _has_from(words: Column, day: int) -> Column:
    """Whether a day from ``day`` on is set."""
    word, bit = divmod(day, DAYS_PER_WORD)
    rest = F.shiftrightunsigned(_word(words, F.lit(word)), bit) != 0
    later = F.slice(words, word + 2, F.greatest(F.size(words) - word - 1, F.lit(0)))
    return rest | F.exists(later, lambda w: w != 0)


def _rank(words: Column, day: int) -> Column:
    """How many days up to ``day`` are set."""
    word, bit = divmod(day, DAYS_PER_WORD)
    # Shifting out the higher bits keeps those up to ``bit``.
    upto = F.call_function("shiftleft", _word(words, F.lit(word)), F.lit(DAYS_PER_WORD - 1 - bit))
    full = [F.bit_count(_word(words, F.lit(w))) for w in range(word)]
    return sum(full, F.bit_count(upto))


def retention_of_bitmaps(
    maps: DataFrame, days: Sequence[int], mode: str = "rolling"
) -> DataFrame:
    """(cohort, player_id, first_log, D{d}R, D{d}_Sessions, ...), as ``user_activity`` gives it
    by the calendar, for any list of days and either mode; a select without a shuffle."""
    one_of("mode", mode, ("rolling", "exact"))
    words, counts = F.col("words"), F.col("counts")
    columns = []
    for d in days:
        reached = _has_from(words, d) if mode == "rolling" else _has(words, d)
        kept = _has(words, 0) & reached
        total = F.aggregate(
            F.slice(counts, F.lit(1), _rank(words, d)), F.lit(0).cast("long"), lambda s, n: s + n
        )
        columns.append(F.when(kept, 1).otherwise(0).alias(f"D{d}R"))
        columns.append(F.when(kept, total).otherwise(0).alias(f"D{d}_Sessions"))
    return maps.select(*KEYS, *columns)


def active_days(words: Column) -> Column:
    """The set days of a bitmap, ascending."""
    none = F.array().cast("array<int>")
    bits = F.sequence(F.lit(0), F.lit(DAYS_PER_WORD - 1))

    def days(word: Column, i: Column) -> Column:
        held = F.filter(bits, lambda b: F.call_function("getbit", word, b) == 1)
        return F.when(word != 0, F.transform(held, lambda b: b + i * DAYS_PER_WORD)).otherwise(none)

    return F.flatten(F.transform(words, days))


def shifted(words: Column, by: Column) -> Column:
    """The bitmap with every day ``by`` later, which is not negative; longer by as many words
    as the days need."""
    skip = F.floor(by / DAYS_PER_WORD).cast("int")
    bits = (by % DAYS_PER_WORD).cast("int")
    last = F.size(words) - 1 + skip + F.when(bits > 0, 1).otherwise(0)

    def word(i: Column) -> Column:
        low = F.call_function("shiftleft", _word(words, i - skip), bits)
        carry = F.call_function("shiftrightunsigned", _word(words, i - skip - 1), 64 - bits)
        # A shift by 64 is one by 0.
        return low.bitwiseOR(F.when(bits > 0, carry).otherwise(0))

    moved = F.transform(F.sequence(F.lit(0), last), word)
    return F.when((by > 0) & (F.size(words) > 0), moved).otherwise(words)


def _merged(parts: Column) -> Column:
    """One (words, counts) out of several for the same first day."""
    none = F.lit(0).cast("long")
    both = F.aggregate(
        parts,
        F.array().cast("array<long>"),
        lambda acc, p: F.zip_with(
            acc, p["words"], lambda a, b: F.coalesce(a, none).bitwiseOR(F.coalesce(b, none))
        ),
    )
    maps = F.transform(parts, lambda p: F.map_from_arrays(active_days(p["words"]), p["counts"]))

    def added(x: Column) -> Column:
        def sessions(day: Column) -> Column:
            return F.aggregate(
                x["maps"], none, lambda s, m: s + F.coalesce(F.try_element_at(m, day), none)
            )

        counts = F.transform(active_days(x["words"]), sessions)
        return F.struct(x["words"].alias("words"), counts.alias("counts"))

    # In an array of one, so that the maps are made once and not once a day.
    bound = F.array(F.struct(both.alias("words"), maps.alias("maps")))
    several = F.element_at(F.transform(bound, added), 1)
    one = F.element_at(parts, 1)
    alone = F.struct(one["words"].alias("words"), one["counts"].alias("counts"))
    return F.when(F.size(parts) > 1, several).otherwise(alone)


def merge_states(states: Sequence[DataFrame], scope: str = "global") -> DataFrame:
    """One state out of several, each made of other logs: the first day of a player is the
    least of all, bitmaps made for a later one are shifted to it, and those of one cohort are
    merged by OR with their sessions added up. Rows of a state that no other state touches
    come out as they went in. One shuffle, by player; the logs are not needed."""
    rows = states[0].select(*KEYS, "words", "counts")
    for state in states[1:]:
        rows = rows.unionByName(state.select(*KEYS, "words", "counts"))
    keys = ["player_id"] if scope == "global" else ["player_id", "cohort"]
    least = F.min("first_log").over(Window.partitionBy(*keys))
    rows = rows.withColumn("least", least)
    moved = shifted(F.col("words"), F.datediff("first_log", "least"))
    parts = rows.select("cohort", "player_id", "least", F.struct(moved.alias("words"), "counts").alias("part"))
    # As many parts as states, and the shuffle of the window serves the aggregate.
    merged = parts.groupBy("player_id", "cohort", "least").agg(F.collect_list("part").alias("parts"))
    merged = merged.withColumn("one", _merged(F.col("parts")))
    return merged.select(
        "cohort",
        "player_id",
        F.col("least").alias("first_log"),
        F.col("one.words").alias("words"),
        F.col("one.counts").alias("counts"),
    )


def activity_state(
    logs: DataFrame, span: int, frequency: str | None = "daily", scope: str = "global"
) -> DataFrame:
    """The state of some cohort logs (cohort, battleTime, player_id): their bitmaps."""
    return activity_bitmaps(player_days(logs, frequency, scope, per_day=False), span)


def advance_state(
    state: DataFrame,
    new_logs: DataFrame,
    span: int,
    frequency: str | None = "daily",
    scope: str = "global",
) -> DataFrame:
    """The state after more logs came, whatever their days: a late row that moves a player's
    first day shifts what is stored. Reads the state and the new logs only; each log must
    come once."""
    return merge_states([state, activity_state(new_logs, span, frequency, scope)], scope)


def user_activity_of_state(state: DataFrame, params: ActivityParams = ActivityParams()) -> DataFrame:
    """The activity table of a state, by the calendar."""
    if params.day_index != "calendar":
        raise ValueError("a state has days by the calendar only")
    return retention_of_bitmaps(state, params.days, params.mode)
