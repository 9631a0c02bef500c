"""Words of Arrow string arrays as 64-bit hashes, found in the UTF-8 bytes with numpy.

Texts are never turned into Python strings. A word is hashed as a polynomial of its bytes,
so that the hashes of all words come from one running sum. Work goes by pieces of about a
megabyte, cut at white space, which bounds memory for batches and texts of any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Classes of bytes. Bytes of non-ASCII characters count as letters.
SPACE, LETTER, DIGIT, OTHER = range(4)


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    out[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = LETTER
    out[ord("0") : ord("9") + 1] = DIGIT
    out[0x80:] = LETTER
    return out


CLASSES = _classes()
# White space against everything else.
SOLID = np.minimum(CLASSES, 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A random value per byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def up(base: np.uint64) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return up(_BASE), up(_BASE_INVERSE)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the n + 1 places where texts begin.

    A NULL text is empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _pieces(raw: np.ndarray) -> list[tuple[int, int]]:
    """Cut at white space near every megabyte; one endless word stays whole."""
    out, begin = [], 0
    while begin < len(raw):
        end = min(begin + PIECE, len(raw))
        while end < len(raw):
            found = np.flatnonzero(SOLID[raw[end : end + 4096]] == 0)
            if len(found):
                end += int(found[0])
                break
            end = min(end + 4096, len(raw))
        out.append((begin, end))
        begin = end
    return out


def words(texts: pa.Array, classes: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 places where the words of texts begin.

    A word is a longest run of bytes of one class other than white space. A-Z hash like a-z.
    """
    raw, at = utf8(texts)
    pieces = _pieces(raw)
    up, down = _powers(max((end - begin for begin, end in pieces), default=1))
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end in pieces:
        piece = raw[begin:end]
        n = len(piece)
        kind = classes[piece]
        cut = np.empty(n + 1, bool)
        cut[0] = cut[n] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
        inside = at[np.searchsorted(at, begin) : np.searchsorted(at, end)] - begin
        cut[inside] = True
        edges = np.flatnonzero(cut)
        solid = kind[edges[:-1]] != SPACE
        starts, ends = edges[:-1][solid], edges[1:][solid]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[piece] * up[:n], out=total[1:])
        hashes.append(mix((total[ends] - total[starts]) * down[starts]))
        places.append(starts + begin)
    starts = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(starts, at)


def owners(at: np.ndarray) -> np.ndarray:
    """For each word, the index of its text."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))
