"""Texts as NumPy arrays: the shared inner loops of the operators, run inside tasks.

A word is a run of characters other than U+0020 and U+0009 to U+000D. Null texts
count as empty. Work arrays are bounded by ``CHARS`` code points; only the result
for one text (eight bytes a word) grows with that text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
CHARS = 1 << 20

_SPACE = re.compile(r"[\x20\x09-\x0D]")
_U = np.uint64


def mix(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> _U(33)
    values *= _U(0xFF51AFD7ED558CCD)
    values ^= values >> _U(33)
    values *= _U(0xC4CEB9FE1A85EC53)
    values ^= values >> _U(33)
    return values


def codes_of(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _powers(size: int) -> np.ndarray:
    powers = np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS = _powers(256)


def _hash_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word."""
    global _POWERS
    codes = codes_of(text)
    word = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    if lengths.max() > len(_POWERS):
        _POWERS = _powers(int(lengths.max()))
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    terms = (codes[word].astype(np.uint64) + _U(1)) * _POWERS[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64)), starts


def pieces(text: str, size: int = CHARS) -> Iterator[str]:
    """The text cut before white space into pieces of about ``size``."""
    at = 0
    while len(text) - at > size:
        found = _SPACE.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text, one 64-bit hash a word, in order. Equal words hash alike everywhere."""
    texts = ["" if text is None else text for text in texts]
    for begin, end in runs([len(text) for text in texts]):
        if end == begin + 1:
            yield np.concatenate([_hash_words(piece)[0] for piece in pieces(texts[begin])])
            continue
        hashes, starts = _hash_words("\n".join(texts[begin:end]))
        sizes = np.array([len(text) + 1 for text in texts[begin:end]])
        yield from np.split(hashes, np.searchsorted(starts, np.cumsum(sizes)[:-1]))


def runs(sizes: list[int], limit: int = CHARS) -> Iterator[tuple[int, int]]:
    """Neighbouring rows in runs whose sizes add up to at most ``limit``, single rows aside."""
    begin = total = 0
    for at, size in enumerate(sizes):
        if at > begin and total + size > limit:
            yield begin, at
            begin, total = at, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` neighbouring values."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for power, at in zip(_powers(size), range(size), strict=True):
        total += hashes[at : at + count] * power
    return mix(total)


def bounded_batches(spark, size: str = "8m") -> None:
    """Arrow batches of texts are bounded by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def free_name(name: str, taken) -> str:
    """The name, or a longer one that no column has in any case."""
    taken = {column.lower() for column in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(columns, replaced) -> list[str]:
    """The columns but those that results replace, whatever their case."""
    replaced = {name.lower() for name in replaced}
    return [column for column in columns if column.lower() not in replaced]
