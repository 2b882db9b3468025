"""Plain helpers for the operator tests."""

import random

SF = "/root/testdata/sf0.001"
SYLLABLES = "ka lo mi ten sor va re du pil na gro es ti fam bel or".split()


def words(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(count)]


def prose(seed, count):
    return " ".join(words(seed, count))


def edited(text, changes, seed=0):
    """The text with some of its words replaced."""
    rng = random.Random(seed)
    parts = text.split(" ")
    for at in rng.sample(range(len(parts)), changes):
        parts[at] = f"new{seed}x{at}"
    return " ".join(parts)


def rows(df, *columns):
    return sorted(
        (tuple(row) for row in df.select(*columns).collect()),
        key=lambda row: [(x is None, str(x)) for x in row],
    )
