import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablepulse.llm import alignment
from tablepulse.llm.queries import op13_alignment

from .common import SF, prose


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_VOCABULARY)


def token_bytes(models, text):
    a, b = models
    letters = alignment.byte_letters()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(x)) for x in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode()
        for x in ids_b
    ]
    return ids_a, ids_b, bytes_a, bytes_b


def spans(tokens):
    at, out = 0, []
    for token in tokens:
        out.append((at, at + len(token)))
        at += len(token)
    return out


def brute_force(models, texts):
    """For each text n_a, n_b, n_groups, n_links, n_best, count_sum and the groups."""
    found = []
    for text in texts:
        ids_a, ids_b, bytes_a, bytes_b = token_bytes(models, text or "")
        whole = f" {text}".encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(([], [], [], ""))
            continue
        a, b = spans(bytes_a), spans(bytes_b)
        links = [
            (x, y)
            for x, (s, e) in zip(ids_a, a)
            for y, (t, u) in zip(ids_b, b)
            if max(s, t) < min(e, u)
        ]
        ends = sorted({e for _, e in a} & {u for _, u in b})
        groups, start = [], 0
        for end in ends:
            sides = (
                ",".join(str(x) for x, (s, e) in zip(ids, where) if s >= start and e <= end)
                for ids, where in ((ids_a, a), (ids_b, b))
            )
            groups.append("|".join(sides))
            start = end
        found.append((ids_a, ids_b, links, ";".join(groups)))
    counts = Counter(link for row in found for link in row[2])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (
            len(a),
            len(b),
            groups.count(";") + 1 if groups else 0,
            len(links),
            sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links),
            groups,
        )
        for a, b, links, groups in found
    ]


TEXTS = [
    "The quick brown fox, the lazy dog.", "the the the fox", "naïve café — “quotes” 12345 67,890.12",
    "  two  spaces\tand\ttabs\n\n\nlines \n", "<s>hi</s> <|endoftext|> [INST]", "日本語のテキスト 🎉🎉 emoji",
    "x▁y has the mark", "a b 　 c", "\x00\x01 control", "", None, " ", "   ", "\n", "é" * 40,
    "don't won't I'll it's", "snake_case camelCase HTTPServer", "ﬁ ligature é combining", "a" * 300,
    "The quick brown fox, the lazy dog.", "İstanbul ß Straße",
]
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def aligned(documents, texts):
    docs = documents(list(enumerate(texts))).repartition(3)
    return {r["doc_id"]: tuple(r[x] for x in NAMES) for r in alignment.align_tokens(docs).collect()}


def test_equals_brute_force(documents, models):
    texts = TEXTS + [prose(at, 80) for at in range(12)]
    got = aligned(documents, texts)
    assert [got[at] for at in range(len(texts))] == brute_force(models, texts)


def test_counts_in_slices_and_small_runs(spark, documents, models, monkeypatch):
    monkeypatch.setattr(alignment, "RUN", 200)
    docs = documents(list(enumerate(TEXTS))).repartition(3)
    encoded, encoders = alignment.encode(docs, alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    counts = alignment.count_links(encoded, encoders)
    assert len(alignment._slices(counts, 40)) > 3
    rows = alignment.align(encoded, counts, encoders, most=40).collect()
    got = {r["doc_id"]: tuple(r[x] for x in NAMES) for r in rows}
    assert [got[at] for at in range(len(TEXTS))] == brute_force(models, TEXTS)


def test_parts_encode_as_the_whole(models, monkeypatch):
    with open(alignment.BYTE_VOCABULARY, "rb") as a, open(alignment.PIECE_VOCABULARY, "rb") as b:
        encoders = alignment.Encoders(a.read(), b.read())
    assert encoders.cuttable
    texts = [text for text in TEXTS if text] + [prose(3, 400), " ".join(TEXTS[:5] * 9)]

    def ids():
        return [(a.tolist(), b.tolist()) for a, b in encoders.encode(texts)]

    whole = ids()
    monkeypatch.setattr(alignment, "PART", 7)
    assert len(list(encoders.parts(prose(3, 400)))) > 50
    assert ids() == whole
    monkeypatch.setattr(alignment, "has_long_run", lambda text: True)  # all by the slower encoder
    assert ids() == whole


def test_long_runs_are_seen():
    words = prose(4, 3000)
    assert not alignment.has_long_run(words) and not alignment.has_long_run("")
    for run in (" " * 4096, "\n\t" * 2048, "z" * 4096):
        assert alignment.has_long_run(run) and alignment.has_long_run(f"{words} {run} {words}")


def test_windows_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(alignment, "_tuple_hashes", lambda ids, sizes: np.zeros(len(sizes), np.uint64))
    a, b = np.array([1, 2, 1, 2, 1, 3], alignment.IDS), np.array([5, 5, 6], alignment.IDS)
    sizes = np.array([2, 2, 2]), np.array([1, 1, 1])
    first, order = alignment._distinct((a, b), sizes)
    assert first[order].tolist() == [0, 0, 2]


def test_long_texts_repeated_rows_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    texts = [" " * 300_000, "word " * 100_000, "z" * 60_000, "same text", "same text"]
    docs = documents([(7, text) for text in texts])
    for name in ("row", "a", "b", "groups", "n", "best"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = alignment.align_tokens(docs).collect()
    assert len(rows) == 5 and {r["doc_id"] for r in rows} == {7}
    assert sorted(r["n_links"] > 0 for r in rows) == [True] * 5
    assert alignment.align_tokens(documents([])).collect() == []


def test_query_gives_digests(spark):
    rows = op13_alignment(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    groups = {r["doc_id"]: r["groups"] for r in alignment.align_tokens(docs).collect()}
    for row in rows:
        text = groups[row["doc_id"]]
        want = hashlib.sha256(text.encode()).hexdigest() if row["n_a"] else ""
        assert row["groups_sha256"] == want
