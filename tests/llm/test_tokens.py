import random
import re

from tablepulse.llm import tokens

from .common import SF, prose


def encoder():
    with open(tokens.VOCABULARY, encoding="ascii") as lines:
        return tokens._encoder(tuple(lines.read().splitlines()))


def test_histogram_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lengths = [len(encoder().encode_ordinary(r["text"])) for r in docs.collect()]
    histogram = tokens.length_histogram(tokens.token_lengths(docs)).cache()
    rows = {r["n_tokens"]: r for r in histogram.collect()}
    assert set(rows) == set(lengths)
    for length, row in rows.items():
        assert row["n_docs"] == lengths.count(length)
        assert row["docs_longer"] == sum(x > length for x in lengths)
        assert row["tokens_up_to"] == sum(x for x in lengths if x <= length)
        assert row["truncated_tokens"] == sum(min(x, length) for x in lengths)
        assert row["total_tokens"] == sum(lengths)
    for limit in (0, 1, 100, 777, 10**6):
        got = tokens.truncated_total(histogram, limit).head()[0]
        assert got == sum(min(x, limit) for x in lengths)
    for share in (0.01, 0.5, 0.9, 1.0):
        want = min(x for x in lengths if sum(y <= x for y in lengths) >= share * len(lengths))
        assert tokens.length_quantile(histogram, share).head()[0] == want


def test_encoding_is_a_round_trip():
    for text in ("", "a  b\n\n c", "é😀 <|endoftext|>", prose(1, 500), "x" * 3000):
        assert encoder().decode(encoder().encode_ordinary(text)) == text


def test_edges(documents):
    frame = documents([(1, None), (2, ""), (2, ""), (None, "hello"), (4, "hello")])
    frame = frame.withColumnRenamed("n_chars", "n_tokens")
    rows = tokens.length_histogram(tokens.token_lengths(frame)).collect()
    assert [(r["n_tokens"], r["n_docs"]) for r in rows] == [(0, 3), (1, 2)]
    empty = tokens.length_histogram(tokens.token_lengths(frame.limit(0)))
    assert empty.count() == 0
    assert tokens.truncated_total(empty, 5).head()[0] == 0


def test_long_white_space_is_cut_where_the_pattern_cuts(monkeypatch):
    plain = encoder()
    monkeypatch.setattr(tokens, "_LONG_RUNS", re.compile(rf"[{tokens.SPACES}]{{3,}}"))
    rng = random.Random(4)
    parts = [" ", "  ", "\t", "\n\n", "\u3000", "\x85", "\x1c", "\u200b", "word", "1", "!", "'s", "é"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert tokens.text_length(plain, text) == len(plain.encode_ordinary(text)), repr(text)


def test_very_long_runs(documents):
    rows = [(1, " " * 10_000_000), (2, "a" + "\n" * 3_000_000 + "b"), (3, "y" * 1_000_000)]
    got = tokens.token_lengths(documents(rows)).collect()
    assert len(got) == 3 and min(r["n_tokens"] for r in got) > 1000
