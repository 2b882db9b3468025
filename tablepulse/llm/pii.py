"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, ``://``, plus signs, dots before
digits, digits and cue words of identifiers. A local parser expands each anchor to
the span around it and validates it. Nothing else of a text is looked at.

Base kinds equal these patterns, leftmost and non-overlapping per kind; a match that
fails its test is dropped and not tried again:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 13 to 19 digits passing the Luhn test
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 9 to 15 digits

Added kinds: ``login`` is ``user:password`` before an at-sign in an address with a
scheme; ``account`` is an identifier of six or more of ``[A-Za-z0-9_-]`` with three or
more digits, after a cue word and up to four of ``[\\x20:=#"']``.

Connecting words such as "number" or "is" may stand between cue and identifier.

Spans count code points, end exclusive. Null and empty texts have no span. Rows are
independent of each other: repeated rows give equal rows. ``find_pii`` reads id and text
alone, ``redact_documents`` keeps every other column. An empty table gives no row. Work
on a text is linear in it.
"""

from __future__ import annotations

import functools
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import bounded_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "account")

# Words that announce an identifier.
CUES = (
    "account", "acct", "api key", "api_key", "apikey", "bearer", "iban", "license no",
    "passport", "password", "passwd", "routing", "secret", "ssn", "tax id", "token",
)
DIGITS = "0123456789"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:?#\"'<>]+:[^\s/@?#\"'<>]+(?=@)")
# Connecting words between a cue and its identifier are passed over.
_ACCOUNT = re.compile(
    r"[\x20:=#\"']{1,4}(?:(?i:number|num|no|nr|id|is|code|key|was)\b[\x20.:=#\"']{1,4}){0,2}"
    r"([A-Za-z0-9_-]{6,})"
)

Span = tuple[str, int, int]


@functools.cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in ("@", "://", "+"):
        found.add_word(word, word)
    for digit in DIGITS:
        found.add_word(digit, "digit")
        found.add_word(f".{digit}", "dotted")
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, "cue")
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _card(text: str, start: int, end: int) -> bool:
    digits = text[start:end].replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _parts(text: str, start: int, end: int) -> bool:
    """Each part at most 255, whatever its leading zeros."""
    parts = [part.lstrip("0") for part in text[start:end].split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def _reachable(text: str, start: int, end: int) -> bool:
    return 9 <= sum(c in DIGITS for c in text[start:end]) <= 15


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed, then by start."""
    if not text:
        return []
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    after = dict.fromkeys(KINDS, 0)  # the end of the last match, kept or dropped

    def keep(kind: str, start: int, end: int, good: bool) -> None:
        after[kind] = end
        if good:
            found[kind].append((kind, start, end))

    for last, anchor in _automaton().iter(text):
        if anchor == "digit":
            if last >= after["card"] and (match := _CHAIN.match(text, last)):
                keep("card", last, match.end(), _card(text, last, match.end()))
        elif anchor == "dotted":
            # The first dot of an address follows the digits where its first part starts.
            start, floor = last - 1, after["ip"]
            while start > floor and text[start - 1] in DIGITS:
                start -= 1
            if start >= floor and (match := _ADDRESS.match(text, start)) and start < last - 1:
                keep("ip", start, match.end(), _parts(text, start, match.end()))
        elif anchor == "@":
            start, floor = last, after["email"]
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (match := _DOMAIN.match(text, last + 1)):
                keep("email", start, match.end(), True)
        elif anchor == "+":
            if last >= after["phone"] and (match := _PHONE.match(text, last + 1)):
                keep("phone", last, match.end(), _reachable(text, last, match.end()))
        elif anchor == "://":
            if last >= after["login"] and (match := _LOGIN.match(text, last + 1)):
                keep("login", match.start(), match.end(), True)
        elif last >= after["account"] and (match := _ACCOUNT.match(text, last + 1)):
            # A word without digits may hold the next cue, so only a find moves on.
            if sum(c in DIGITS for c in match.group(1)) >= 3:
                keep("account", *match.span(1), True)
    return [span for kind in KINDS for span in found[kind]]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by ``[KIND]``; overlapping spans become one."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _row(text: str | None) -> dict:
    spans = find_spans(text)
    base = [span for span in spans if span[0] in BASE]
    counts = {f"n_{kind}": sum(span[0] == kind for span in base) for kind in BASE}
    digest = hashlib.sha256(written(base).encode()).hexdigest()
    return counts | {"base_sha256": digest, "spans": written(spans)}


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` with counts and digest of the base spans and all spans of each document."""
    bounded_batches(docs.sparkSession)
    names = [f"n_{kind}" for kind in BASE] + ["base_sha256", "spans"]
    types = [pa.int64()] * len(BASE) + [pa.string()] * 2

    def search(batches):
        for batch in batches:
            rows = [_row(text) for text in batch.column(1).to_pylist()]
            columns = [
                pa.array([row[name] for row in rows], kind)
                for name, kind in zip(names, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    fields = [f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"]
    fields += [f"n_{kind} long" for kind in BASE] + ["base_sha256 string", "spans string"]
    return docs.select("doc_id", "text").mapInArrow(search, ", ".join(fields))


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with each span of their text replaced by its kind."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def replace(batches):
        for batch in batches:
            texts = [redact(text, find_spans(text)) for text in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(replace, docs.schema)
