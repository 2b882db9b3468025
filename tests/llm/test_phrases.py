import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tablepulse.llm import phrases

from .common import words


def brute_force(rows, threshold, longest, first, share=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for size in range(1, longest + 1):
                for at in range(len(found) - size + 1):
                    counts[lang, tuple(found[at : at + size])] += 1
    often = {key: n for key, n in counts.items() if n >= threshold}
    best = {}
    for (lang, phrase), n in often.items():
        for size in range(1, len(phrase)):
            for at in range(len(phrase) - size + 1):
                key = lang, phrase[at : at + size]
                best[key] = max(best.get(key, 0), n)
    out = []
    for (lang, phrase), a in often.items():
        if len(phrase) == 1 or 100 * best.get((lang, phrase), 0) >= share * a:
            continue
        n = totals[lang]
        cuts = []
        for k in range(1, len(phrase)):
            left, right = often[lang, phrase[:k]], often[lang, phrase[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(phrase).encode(), left, right, n))
    rows, place = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(out):
        place[lang] += 1
        if place[lang] <= first:
            rows.append((lang, place[lang], phrase.decode(), -a, left, right, n, -score))
    return rows


def corpus():
    rng = random.Random(3)
    vocabulary = words(1, 40)
    lines = [" ".join(words(50 + i, 5)) for i in range(6)]
    rows = []
    for at in range(160):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))
        parts = text.split(" ")
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(lines))
        joined = rng.choice([" ", "  ", "\t", " ", ", "]).join(parts)
        rows.append((rng.choice(["en", "fr", None]), joined.title() if at % 7 == 0 else joined))
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("en", "a b " * 200), ("en", "É é " * 50)]
    rows += [("de", "x. y! z? x. y"), ("fr", "same line here\n" * 30), ("xx", "İ ı K " * 10)]
    return rows + rows[:20]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("shards, slots", [(2, 1 << 16), (3, 1 << 16), (1, 1 << 16), (2, 4)])
def test_equals_brute_force(documents, shards, slots):
    rows = corpus()
    docs = documents([(at, text, lang) for at, (lang, text) in enumerate(rows)]).repartition(3)
    counts = phrases.count_phrases(docs, 6, 5, shards, slots)
    got = phrases.rank_collocations(counts, first=25).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(brute_force(rows, 6, 5, 25))


def test_shared_slots_lose_no_count(documents):
    """A slot that another phrase reached first starts no phrase before its subphrases."""
    rows = [(lang, " ".join([word] * (4 + at % 9))) for at in range(12) for lang in ("en", "fr") for word in words(9, 30)]
    docs = documents([(at, text, lang) for at, (lang, text) in enumerate(rows)])
    counts = phrases.count_phrases(docs, 40, 5, 3, slots=32)
    got = phrases.rank_collocations(counts, first=200).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(brute_force(rows, 40, 5, 200))


def test_phrases_across_the_cuts_of_long_texts(documents, monkeypatch):
    rng = random.Random(5)
    vocabulary = words(2, 12)
    long = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", "."]) for _ in range(4000))
    rows = [("en", long), ("en", "z" * 5000 + " " + long[:900])]
    docs = documents([(at, text, lang) for at, (lang, text) in enumerate(rows)])
    whole = brute_force(rows, 20, 5, 50)
    for text in (row[1].encode() for row in rows):
        monkeypatch.setattr(phrases, "RUN", 300)
        found = list(phrases.parts(text, 5))
        assert b"".join(part[skip:] for part, skip in found) == text and len(found) > 3
    got = phrases.collocations(docs, threshold=20, first=50).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(whole)


def test_arithmetic_beyond_64_bits(spark):
    big = 4_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "", 0, 9 * 10**15), ("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 7)],
        "lang string, phrase string, n_words int, n long",
    )
    (row,) = phrases.rank_collocations(counts).collect()
    assert row["score"] == 1000 * (big - 7) * 9 * 10**15 // (big * (big + 1))


def test_empty_tables_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    assert phrases.collocations(documents([])).collect() == []
    docs = documents([(1, "a b c. " * 9, "en")])
    for name in ("shard", "n", "phrase", "since", "done"):
        docs = docs.withColumn(name, F.lit(5))
    got = phrases.collocations(docs, threshold=9).collect()
    assert [(r["phrase"], r["a"], r["score"]) for r in got] == [("a b c", 9, 3000)]


def test_hashes_do_not_depend_on_the_blocks(monkeypatch):
    texts = [" ".join(words(at, 60)).encode() + b" " + b"z" * 300 for at in range(9)]
    langs = ["en", "fr", "und"] * 3
    whole = phrases.Words(texts, langs, [0] * 9).hashes
    assert len(set(whole.tolist())) > 100
    for block in (1, 7, 100, 1000):
        monkeypatch.setattr(phrases, "BLOCK", block)
        assert (phrases.Words(texts, langs, [0] * 9).hashes == whole).all()


def test_a_run_takes_a_bounded_part_of_memory():
    rng = random.Random(7)
    vocabulary = [word.encode() for word in words(3, 3000)]
    texts = [b" ".join(rng.choices(vocabulary, k=200)) for _ in range(2600)]
    known = np.zeros(1 << 16, np.uint8)
    tracemalloc.start()
    try:
        run = phrases.Words(texts, ["en"] * len(texts), [0] * len(texts))
        n = sum(len(batch) for batch in phrases._counts(run, known, 1, 2, 5))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 1_000_000 and len(run.text) > 3_000_000
    assert most < 40 * len(run.text)
