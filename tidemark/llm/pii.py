"""Personal data in texts: patterns, and a skip-chain field that makes labels agree."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crf import NEVER, Potentials, fit_potentials, marginals

KINDS = ("email", "ip", "card", "phone")
# Label 0 is none of these.
LABELS = 1 + len(KINDS)
CHAIN, REPEATED, SIMILAR = range(3)
# A span is added from this probability on.
LEAST = 0.9
# Nodes of fields that are solved together, at least.
NODES = 20_000

_MARK = re.compile("[0-9@]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Possessive, as no other split could match; whole runs of digits, so that each is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")
# What is cut off the ends of an added span.
_AROUND = re.compile(r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9]+$")

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the run of local characters before an ``@``, and the domain after."""
    least, at = 0, text.find("@")
    while at >= 0:
        local = text[least:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            yield at - size, domain.end()
        least = max(at + 1, domain.end() if domain else 0)
        at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(label, start, end) of all matches, by kind and place; linear in the text."""
    if not _MARK.search(text):
        return []
    found = (_emails, _ips, _cards, _phones)
    return [(label, *span) for label, spans in enumerate(found, 1) for span in spans(text)]


def _size_class(digits: int) -> int:
    return int(np.searchsorted((1, 2, 3, 4, 5, 6, 7, 8, 10, 13, 16, 17, 20), digits, "right"))


def _feature(token: str, digits: int) -> tuple[int, int]:
    """The shape of a token, one of some ten thousand. Its group is how many digits it has and
    whether it has an at; the rest dots, hyphens, letters, a bracket, a leading plus, other signs."""
    letters = sum(map(str.isalpha, token))
    signs = {c: token.count(c) for c in ".-@(+)"}
    other = len(token) - digits - letters - sum(signs.values()) > 0
    shape = 2 * token.startswith("+") + other
    for value, top in ((signs["."], 4), (signs["-"], 3), (letters, 3), (signs["("], 1)):
        shape = shape * (top + 1) + min(value, top)
    return 2 * _size_class(digits) + ("@" in token), shape


class _Field:
    """The field of one text: a node per token with a digit or an at."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans: list[Span] = [m.span() for m in _TOKEN.finditer(text)]
        self.labels = np.zeros(len(self.spans), np.int64)
        self.features: list[tuple[int, int]] = []
        signatures: dict[tuple, list[int]] = defaultdict(list)
        repeated: dict[str, list[int]] = defaultdict(list)
        ends = np.array([end for _, end in self.spans], np.int64)
        for label, start, end in reversed(base):
            # Kinds listed first win where spans overlap.
            node = int(np.searchsorted(ends, start, "right"))
            while node < len(ends) and self.spans[node][0] < end:
                self.labels[node] = label
                node += 1
        for node, (start, end) in enumerate(self.spans):
            token = text[start:end]
            digits = _NO_DIGIT.sub("", token)
            self.features.append(_feature(token, len(digits)))
            key = token.partition("@")[0].strip(".,;:<>()\"'").lower() if "@" in token else digits
            if len(key) >= 3:
                repeated[key].append(node)
            if 7 <= len(key) <= 40:
                # Texts one change apart share one of these.
                signatures[key,].append(node)
                for i in {key[:i] + key[i + 1 :] for i in range(len(key))}:
                    signatures[i,].append(node)
        edges: dict[Span, int] = {}
        # Each occurrence is linked with the next only, so that edges stay as few as nodes.
        for kind, groups in ((SIMILAR, signatures), (REPEATED, repeated)):
            for nodes in groups.values():
                for pair in zip(nodes, nodes[1:]):
                    edges[pair] = kind
        for node, (one, two) in enumerate(zip(self.spans, self.spans[1:])):
            if two[0] - one[1] == 1:
                edges[node, node + 1] = CHAIN
        self.edges = np.array([(a, b, k) for (a, b), k in edges.items()], np.int64).reshape(-1, 3)


def _passes(label: int, piece: str) -> bool:
    """Whether a piece passes the test of its kind, however it is written."""
    numbers = re.findall("[0-9]+", piece)
    if KINDS[label - 1] == "ip":
        return all(len(n.lstrip("0")) <= 3 and int(n) <= 255 for n in numbers)
    return KINDS[label - 1] != "card" or _luhn("".join(numbers))


def _added(text: str, field: _Field, chance: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of tokens that no base span touches and that are surely of a kind: neighbours of
    one kind are one span. A span has to look like its kind, but for the detail that kept it
    from being matched. Where the text has no match, nothing speaks for a number that fails
    the test of its kind, and only the way of writing may differ."""
    alone = not field.labels.any()
    best = chance.argmax(1)
    sure = (field.labels == 0) & (best > 0) & (chance.max(1) >= LEAST)
    found, node = [], 0
    while node < len(best):
        first, node = node, node + 1
        if not sure[first]:
            continue
        label = int(best[first])
        while (
            node < len(best)
            and sure[node]
            and best[node] == label
            and field.spans[node][0] - field.spans[node - 1][1] == 1
        ):
            node += 1
        start, end = field.spans[first][0], field.spans[node - 1][1]
        piece = text[start:end]
        inner = _AROUND.sub("", piece)
        start += piece.index(inner)
        digits = len(_NO_DIGIT.sub("", inner))
        groups = len(re.findall("[0-9]+", inner))
        fits = ("@" in inner.strip("@"), groups == 4 <= digits, 13 <= digits <= 19, 9 <= digits <= 15)
        if inner and fits[label - 1] and (not alone or _passes(label, inner)):
            found.append((label, start, start + len(inner)))
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often features have labels (``kind`` -1 less their group), and edges of a kind pairs
    of labels."""
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column("text").to_pylist():
            if text and _MARK.search(text):
                field = _Field(text, base_spans(text))
                seen.update((-1 - g, f, int(y)) for (g, f), y in zip(field.features, field.labels))
                for a, b, kind in field.edges.tolist():
                    y, z = int(field.labels[a]), int(field.labels[b])
                    seen[kind, y, z] += 1
        kinds, a, b = zip(*seen) if seen else ((), (), ())
        columns = [*(pa.array(x, pa.int32()) for x in (kinds, a, b)), pa.array(seen.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b", "n"])


def fit_fields(docs: DataFrame) -> Potentials:
    """Potentials from all documents, with the matches of the patterns as labels.

    The counts are summed in Spark; a shape or a pair of labels is one row of what is
    collected, so it stays below a hundred thousand rows at any size.
    """
    counts = docs.select("text").mapInArrow(_counts, "kind int, a int, b int, n long")
    features: dict[tuple[int, int], np.ndarray] = {}
    edges = np.zeros((3, LABELS, LABELS))
    for kind, a, b, n in counts.groupBy("kind", "a", "b").agg(F.sum("n")).collect():
        if kind < 0:
            features.setdefault((-1 - kind, a), np.zeros(LABELS))[b] = n
        else:
            edges[kind, a, b] += n
    # Skip edges have no direction.
    edges[REPEATED:] += edges[REPEATED:].transpose(0, 2, 1)
    return fit_potentials(features, edges, skips=(REPEATED, SIMILAR))


def _groups(texts: list[str]) -> Iterator[list[int]]:
    """Rows whose texts have nodes, with matches or without, cut so that the fields of a group
    have a bounded number of nodes."""
    group, nodes = [], 0
    for row, text in enumerate(texts):
        if _MARK.search(text):
            group.append(row)
            nodes += len(_TOKEN.findall(text))
        if nodes >= NODES:
            yield group
            group, nodes = [], 0
    if group:
        yield group


def _solved(texts: list[tuple[str, list]], potentials: Potentials) -> Iterator[list]:
    """All spans of texts that have nodes, solved together as one field."""
    fields = [_Field(text, base) for text, base in texts]
    at = np.cumsum([0, *(len(f.spans) for f in fields)])
    unary = np.array([potentials.node(x) for f in fields for x in f.features])
    labels = np.concatenate([f.labels for f in fields])
    clamped = np.flatnonzero(labels)
    unary[clamped] = NEVER
    unary[clamped, labels[clamped]] = 0.0
    edges = np.concatenate([f.edges + [a, a, 0] for f, a in zip(fields, at)])
    chance = marginals(unary, edges, potentials.edges)
    for (text, base), field, begin, end in zip(texts, fields, at, at[1:]):
        yield sorted(base + _added(text, field, chance[begin:end]))


_SPAN = "array<struct<kind:string,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _named(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": KINDS[label - 1], "start": start, "end": end} for label, start, end in spans]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Emails, IP addresses, card and phone numbers of whole texts.

    Returns ``doc_id, base, spans``, arrays of ``kind, start, end`` in code points, by kind and
    start. ``base`` holds the leftmost matches, not overlapping per kind, of four patterns,
    without those that fail the bound of a part, the check digit, or the number of digits.
    ``spans`` holds these and the ones that a skip-chain random field adds: a number or address
    that is written in a way that no pattern matches, but is repeated, or nearly, as a match
    of the same text, or looks like the matches of other texts. In a text without a match it
    has to pass the test of its kind as well.

    A NULL or empty text has no spans. Repeated rows, also of one ``doc_id``, are returned
    each; a NULL ``doc_id`` is kept. Ties between kinds on one token go to the kind first named.
    Texts of any length are read whole and in linear time. An empty table gives no rows.
    Other columns are not read.

    The nodes of a field are the tokens with a digit or an at. Tokens in matches are observed;
    chain edges join neighbouring tokens, and skip edges join each token with the next one that
    has the same digits or name, or differs in one character. Potentials are counted over all
    documents, matches being the labels, and loopy sum-product messages give each token's
    probabilities.
    """
    potentials = fit_fields(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            base = [base_spans(text) for text in texts]
            spans = list(base)
            for rows in _groups(texts):
                solved = _solved([(texts[r], base[r]) for r in rows], potentials)
                for row, found in zip(rows, solved):
                    spans[row] = found
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(map(_named, base), _SPAN_TYPE),
                    pa.array(map(_named, spans), _SPAN_TYPE),
                ],
                names=["doc_id", "base", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, f"doc_id long, base {_SPAN}, spans {_SPAN}")
