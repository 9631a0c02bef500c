"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import utf8

# N-grams in a profile, and characters in an n-gram at most.
TOP, LONGEST = 300, 3
# Characters in one step of numpy work, and distinct n-grams a task holds before it lets go.
BLOCK, HELD = 1 << 19, 1 << 20

UNKNOWN = "und"
BLANK = 1


def _code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the place of the first byte of each."""
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    lead = raw[heads].astype(np.int64)
    width = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    points = np.where(width == 1, lead, lead & (0xFF >> (width + 1)))
    for i in range(1, 4):
        more = width > i
        points[more] = (points[more] << 6) | (raw[heads[more] + i] & 0x3F)
    return points, heads


def _alphabet(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters in use, in order, and the index of each character among them.

    Letters are in lower case; all else is the blank, which is the first of all.
    """
    known = np.flatnonzero(np.bincount(points))
    letters = [ord(c.lower()[0]) if (c := chr(p)).isalpha() else BLANK for p in known.tolist()]
    used, at = np.unique([BLANK, *letters], return_inverse=True)
    index = np.zeros(known[-1] + 1, np.int64)
    index[known] = at[1:]
    return used, index[points]


def _piece(raw: np.ndarray, at: np.ndarray, begin: int, end: int) -> tuple:
    """Text, n-gram and count over the characters that begin in a range of bytes.

    In the order of text and n-gram. A character counts with its n-grams, so that pieces of
    one text add up; two characters on either side are looked at.
    """
    low, high = max(begin - 8, 0), min(end + 8, len(raw))
    while low and raw[low] & 0xC0 == 0x80:
        low -= 1
    while high < len(raw) and raw[high] & 0xC0 == 0x80:
        high += 1
    points, heads = _code_points(raw[low:high])
    heads = heads + low
    used, index = _alphabet(points)
    text = np.zeros(len(heads) + 1, np.int64)
    np.add.at(text, np.searchsorted(heads, at[(at > low) & (at < high)]), 1)
    text = np.cumsum(text[:-1]) + int(np.searchsorted(at, low, side="right") - 1)
    # A blank before each text and at the end; of blanks in a row the last one stays.
    new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    index = np.r_[np.insert(index, new, 0), 0]
    heads = np.r_[np.insert(heads, new, heads[new]), end]
    text = np.r_[np.insert(text, new, text[new]), -1]
    kept = np.r_[(index[1:] != 0) | (index[:-1] != 0), True]
    index, heads, text = index[kept], heads[kept], text[kept]
    solid = index != 0

    width = int(len(used)).bit_length()
    digit = index + 1
    first_text = int(text[0])
    keys, m = [], len(index)
    gram = np.zeros(m, np.int64)
    for n in range(1, LONGEST + 1):
        gram = (gram[: m - n + 1] << width) | digit[n - 1 :]
        # The first letter decides on the text and the piece: the n-gram's first or second place.
        here = solid[: m - n + 1]
        if n == 2:
            here = here | solid[1:]
        if n == 3:
            here = solid[1:-1]
        where = np.flatnonzero(here)
        letter = where + ~solid[where]
        inside = (heads[letter] >= begin) & (heads[letter] < end)
        where, letter = where[inside], letter[inside]
        keys.append((text[letter] - first_text) << (LONGEST * width) | gram[where])
    key = np.sort(np.concatenate(keys))
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
    count = np.diff(np.r_[starts, len(key)])
    key = key[starts]
    out = np.zeros(len(key), np.int64)
    letters = np.r_[0, used]
    for i in reversed(range(LONGEST)):
        out = (out << 21) | letters[(key >> (i * width)) & ((1 << width) - 1)]
    return (key >> (LONGEST * width)) + first_text, out, count


def _merged(parts: list[tuple]) -> tuple:
    """Counts of several parts added up, in order."""
    text, gram, count = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((gram, text))
    text, gram, count = text[order], gram[order], count[order]
    heads = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])])
    return text[heads], gram[heads], np.add.reduceat(count, heads)


def ngrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, n-gram and count, in order, for runs of whole texts; texts without letters lack.

    An n-gram is one to three characters, 21 bits each. Characters other than letters are
    blanks, which may begin or end an n-gram but never stand within one or alone; every word
    begins and ends with one. Long texts are counted piece by piece.
    """
    raw, at = utf8(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(at, at[begin] + BLOCK, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        parts, low = [], int(at[begin])
        while low < at[end]:
            high = min(low + BLOCK, int(at[end]))
            while high < at[end] and raw[high] & 0xC0 == 0x80:
                high += 1
            parts.append(_piece(raw, at, low, high))
            low = high
        parts = [p for p in parts if len(p[0])]
        if parts:
            yield parts[0] if len(parts) == 1 else _merged(parts)
        begin = end


@dataclass
class LanguageModel:
    """Languages, all n-grams of their profiles in order, and ranks by n-gram and language."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The nearest language of each text, and how much nearer it is than the next."""
        n = len(texts)
        distance = np.zeros((n, len(self.languages)))
        size = np.zeros(n, np.int64)
        for own, gram, count in ngrams(texts):
            # Stable, so that ties stay in the order of n-grams.
            order = np.argsort(own * (count.max() + 1) - count, kind="stable")
            own, gram = own[order], gram[order]
            heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            rank = np.arange(len(own)) - np.repeat(heads, np.diff(np.r_[heads, len(own)]))
            own, gram, rank = own[rank < TOP], gram[rank < TOP], rank[rank < TOP]
            at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            known = self.grams[at] == gram
            there = np.where(known[:, None], self.ranks[at], -1)
            off = np.where(there < 0, TOP, np.abs(there - rank[:, None]))
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            distance[own[starts]] = np.add.reduceat(off, starts, axis=0)
            size[own[starts]] = np.diff(np.r_[starts, len(own)])
        best = distance.argmin(1)
        nearest = distance[np.arange(n), best]
        found = size > 0
        if len(self.languages) > 1:
            second = np.partition(distance, 1, axis=1)[:, 1]
            score = (second - nearest) / np.maximum(second, 1)
        else:
            score = 1 - nearest / np.maximum(size * TOP, 1)
        names = [self.languages[b] if f else UNKNOWN for b, f in zip(best, found)]
        return names, np.where(found, score, 0.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language over one partition."""
    names: dict[str, int] = {}
    held: list[tuple] = []

    def out():
        lang, gram, count = _merged(held)
        known = pa.array(list(names), pa.string())
        return pa.RecordBatch.from_arrays(
            [known.take(pa.array(lang)), pa.array(gram), pa.array(count.astype(np.int64))],
            names=["lang", "gram", "n"],
        )

    for batch in batches:
        langs = [names.setdefault(x, len(names)) for x in batch.column(1).to_pylist()]
        langs = np.array(langs, np.int64)
        for text, gram, count in ngrams(batch.column(0)):
            held.append((langs[text], gram, count))
            if sum(len(x[0]) for x in held) > HELD:
                held = [_merged(held)]
                if len(held[0][0]) > HELD // 2:
                    yield out()
                    held = []
    if held:
        yield out()


def fit_languages(docs: DataFrame, learn: Column | None = None) -> LanguageModel | None:
    """Profiles of the languages in ``docs`` (``text, lang``); None if there is none.

    A profile is the 300 most frequent n-grams of all texts of a language, ties by n-gram.
    ``learn`` is a condition on the rows to learn from; a NULL ``lang`` or text teaches
    nothing. Tasks count by themselves before Spark adds the counts, and only profiles, whose
    size does not depend on the texts, reach the driver.
    """
    rows = docs if learn is None else docs.where(learn)
    rows = rows.where(F.col("lang").isNotNull()).select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < TOP)
    got = top.select("lang", "gram", "rank").toArrow()
    if not len(got):
        return None
    lang, gram = got["lang"].to_pylist(), got["gram"].to_numpy()
    languages, grams = sorted(set(lang)), np.unique(gram)
    ranks = np.full((len(grams), len(languages)), -1, np.int64)
    column = {name: i for i, name in enumerate(languages)}
    ranks[np.searchsorted(grams, gram), [column[x] for x in lang]] = got["rank"].to_numpy()
    return LanguageModel(languages, grams, ranks)


def language(model: LanguageModel | None, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` of a text.

    The distance to a profile is the sum of differences in rank over the text's 300 most
    frequent n-grams, an n-gram the profile lacks counting 300; the nearest profile wins, the
    first by name in a tie. The score is the lead over the next profile, from 0 to 1. A text
    that is NULL, empty or without letters is ``und`` with score 0, and so is every text when
    there are no profiles.
    """
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, score = model.predict(texts)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score)], names=["lang_pred", "score"]
        )

    return predict(text)


def identify_languages(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``.

    Repeated rows are predicted each, a NULL ``doc_id`` is kept, an empty table gives no
    rows, and columns other than ``doc_id``, ``text`` and ``lang`` are not read.
    """
    found = language(fit_languages(docs, learn), F.col("text"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")
