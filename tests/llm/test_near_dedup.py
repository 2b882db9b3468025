import itertools

import numpy as np

from tablepulse.llm import near_dedup as nd
from tablepulse.llm.arrays import word_hashes
from tablepulse.llm.components import components

from .common import SF, edited, prose, rows


def plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_banded_distance_is_the_edit_distance_within_the_budget():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 4, rng.integers(0, 14)).astype(np.uint64)
        b = rng.integers(0, 4, rng.integers(0, 14)).astype(np.uint64)
        want = plain_distance(a, b)
        for budget in (0, 1, 3, 8, 14):
            got = nd.edit_distance(a, b, budget)
            assert got == (want if want <= budget else None)


def test_the_anchored_alignment_never_costs_less():
    for seed in range(60):
        base = prose(seed, 30 + seed)
        other = edited(base, seed % 9, seed) if seed % 3 else prose(seed + 1, 40) + " " + base
        a, b = word_hashes([base, other])
        assert nd.anchored_distance(a, b) >= plain_distance(a, b)
        assert nd.similar(a, b) == (plain_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_sketches_keep_order_and_count_occurrences():
    (a, b, c, empty) = word_hashes([prose(1, 60), prose(1, 60), prose(2, 60), ""])
    assert (nd.order_minhash(a) == nd.order_minhash(b)).all()
    assert not (nd.order_minhash(a) == nd.order_minhash(c)).any()
    assert len(nd.order_minhash(empty)) == 0
    turned = np.concatenate([a[30:], a[:30]])
    assert (nd.order_minhash(a) == nd.order_minhash(turned)).mean() < 0.7
    labels = nd.occurrence_labels(np.array([7, 7, 9, 7], np.uint64))
    assert len(set(labels.tolist())) == 4


def test_components_of_chains_and_stars(spark):
    chain = [(f"{i:04d}", f"{i + 1:04d}") for i in range(200)]
    star = [("z0", f"a{i}") for i in range(50)]
    got = dict(rows(components(spark.createDataFrame(chain + star, "a string, b string")), "*"))
    assert len({got[f"{i:04d}"] for i in range(201)}) == 1
    assert len({got[x] for x in ("z0", "a0", "a49")}) == 1
    assert len(set(got.values())) == 2
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def brute_force(table):
    """Least id of the class, by comparing all pairs of texts."""
    texts = sorted({text or "" for _, text in table})
    hashes = dict(zip(texts, word_hashes(texts)))
    root = {text: text for text in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(texts, 2):
        x, y = hashes[a], hashes[b]
        if len(x) and len(y) and nd.similar(x, y):
            root[find(a)] = find(b)
    least = {}
    for doc_id, text in table:
        if doc_id is not None:
            top = find(text or "")
            least[top] = min(doc_id, least.get(top, doc_id))
    return {doc_id: least.get(find(text or "")) for doc_id, text in table}


def test_classes_equal_brute_force_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    got = dict(rows(nd.near_duplicate_classes(docs), "doc_id", "class_id"))
    assert got == brute_force(table)


def edge_rows():
    base, other = prose(3, 120), prose(4, 120)
    table = [
        (1, base), (2, base), (2, base), (3, edited(base, 4, 1)), (4, edited(base, 6, 2)),
        (5, other), (6, other.replace(" ", "  \n")), (7, None), (8, ""), (9, " \t"),
        (10, "two words"), (11, "two words"), (12, "two  words"), (13, "one"),
        (14, prose(5, 6000)), (15, edited(prose(5, 6000), 50, 3)),
        (16, edited(base, 60, 4)), (17, prose(6, 120)),
    ]
    return table


def test_edges_and_bucket_rest(documents):
    table = edge_rows()
    got = dict(rows(nd.near_duplicate_classes(documents(table)), "doc_id", "class_id"))
    assert got == brute_force(table)
    assert got[4] == 1 and got[6] == 5 and got[16] == 16 and got[8] == 7 and got[9] == 9
    assert got[12] == 10 and got[15] == 14


def test_large_groups_around_one_text(documents):
    base = prose(8, 150)
    table = [(i, edited(base, 5, i)) for i in range(60)] + [(100 + i, base) for i in range(60)]
    shared = prose(9, 40)
    table += [(200 + i, f"{shared} {prose(300 + i, 110)}") for i in range(30)]
    frame = documents(table)
    got = dict(rows(nd.near_duplicate_classes(frame), "doc_id", "class_id"))
    assert {got[i] for i in range(60)} | {got[100 + i] for i in range(60)} == {0}
    assert all(got[200 + i] == 200 + i for i in range(30))
    sizes = dict(rows(nd.near_duplicate_classes(frame), "doc_id", "class_size"))
    assert sizes[0] == 120 and sizes[200] == 1


def test_drop_keeps_one_row_of_each_class_with_all_columns(documents, spark):
    table = [(*row, "en", "s", 1, "x") for row in edge_rows()] + [
        (None, "no id here at all", "en", "s", 2, "y"),
        (None, "no id here at all", "en", "s", 2, "y"),
    ]
    frame = documents(table, ", h1 long, `count` string")
    kept = nd.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    want = set(brute_force(edge_rows()).values())
    ids = [row["doc_id"] for row in kept.collect()]
    assert sorted(ids, key=str) == sorted([*want, None], key=str)
    assert nd.drop_near_duplicates(frame.limit(0)).count() == 0
    assert nd.near_duplicate_classes(frame.limit(0)).count() == 0


def test_similar_pairs_share_a_sketch():
    rng = np.random.default_rng(11)
    for size, similarity, least in ((150, 0.8, 0.88), (150, 0.85, 0.98), (400, 0.8, 0.88)):
        shared = total = 0
        for _ in range(300):
            a = rng.integers(1 << 62, size=size).astype(np.uint64)
            b = a.copy()
            places = rng.choice(size, int((1 - similarity) * size + 1e-9), replace=False)
            b[places] = rng.integers(1 << 62, size=len(places)).astype(np.uint64)
            gone = places[::3]
            b = np.delete(b, gone)
            if nd.similar(a, b):
                total += 1
                shared += bool((nd.order_minhash(a) == nd.order_minhash(b)).any())
        assert total > 250 and shared / total >= least, (size, similarity, shared / total)


def test_every_pair_of_a_large_bucket_is_compared(documents, monkeypatch):
    """All texts in one bucket: links that no pivot meets are found too."""
    docs = []
    for group in range(9):
        text = prose(400 + group, 40)
        docs += [(2 * group, text), (2 * group + 1, edited(text, 6, group))]
    whole = nd._Search.nodes
    one = nd.F.array(nd.F.lit(7).cast("long"))
    monkeypatch.setattr(nd._Search, "nodes", lambda self: whole(self).withColumn("sketches", one))
    got = rows(nd.near_duplicate_classes(documents(docs)), "doc_id", "class_id", "class_size")
    assert sorted(got) == [(at, at // 2 * 2, 2) for at in range(18)]


def test_bins_rule_out_no_similar_pair(spark):
    pairs = [(prose(at, 50), edited(prose(at, 50), at % 14, at)) for at in range(40)]
    found = [[next(word_hashes([text])) for text in pair] for pair in pairs]
    fields = [[(len(x), nd.word_bins(x).tolist()) for x in pair] for pair in found]
    kind = "struct<n_words: int, bins: array<int>>"
    frame = spark.createDataFrame([(at, *pair) for at, pair in enumerate(fields)], f"at int, a {kind}, b {kind}")
    kept = {row[0] for row in frame.where(nd.may_be_similar("a", "b")).select("at").collect()}
    assert {at for at, (a, b) in enumerate(found) if nd.similar(a, b)} <= kept


def test_a_group_of_near_copies_has_few_links(documents, monkeypatch):
    """Links grow with the texts of a group, not with its texts and pivots."""
    base = prose(20, 150)
    docs = documents([(at, edited(base, 10, at)) for at in range(60)])
    seen = []

    def counted(links):
        seen.append(links.count())
        return components(links)

    monkeypatch.setattr(nd, "components", counted)
    got = rows(nd.near_duplicate_classes(docs), "class_id", "class_size")
    assert set(got) == {(0, 60)}
    assert 59 <= sum(seen) <= 120


def test_texts_with_a_common_passage_are_not_compared_pair_by_pair(documents, monkeypatch):
    """Pairs compared in the last step grow with what is alike, not with the square of a bucket."""
    passage = prose(30, 20)
    table = [(at, f"{passage} {prose(500 + at, 60)}") for at in range(60)]
    table += [(60 + at, edited(table[at][1], 9, at)) for at in range(0, 60, 6)]
    whole, links = nd._Search.nodes, nd._Search.links
    one = nd.F.array(nd.F.lit(7).cast("long"))
    monkeypatch.setattr(nd._Search, "nodes", lambda self: whole(self).withColumn("sketches", one))
    seen = {}

    def counted(self, texts, pairs, name):
        found = links(self, texts, pairs, name)
        seen[name] = self.spark.read.parquet(f"{self.folder}/{name}_pairs").count()
        return found

    monkeypatch.setattr(nd._Search, "links", counted)
    monkeypatch.setattr(nd, "may_be_similar", lambda a, b: nd.F.lit(True))
    got = dict(rows(nd.near_duplicate_classes(documents(table)), "doc_id", "class_id"))
    assert got == brute_force(table)
    assert 0 < seen["last"] < 200


def test_similar_texts_share_one_of_their_rarest_words():
    rng = np.random.default_rng(5)
    for size in (1, 4, 5, 9, 30, 121):
        for at in range(40):
            a = rng.integers(0, 40, size).astype(np.uint64)
            b = a.copy()
            places = rng.choice(size, size // 5, replace=False)
            b[places] = rng.integers(0, 60, len(places))
            b = np.delete(b, places[: at % 3])
            frequent = np.arange(at, dtype=np.uint64), np.arange(at)[::-1] + 1
            if nd.similar(a, b):
                assert set(nd.rarest_words(a, frequent)) & set(nd.rarest_words(b, frequent))


def test_bins_rule_out_pairs_a_little_too_far_apart(spark):
    """Texts of 800 words with 0.75 of them in common."""
    rng = np.random.default_rng(7)
    base = rng.integers(1 << 62, size=800).astype(np.uint64)
    other = rng.integers(1 << 62, size=800).astype(np.uint64)
    texts = [base, np.where(np.arange(800) % 4 > 0, base, other)]
    often = np.append(np.zeros(400, np.uint64), base[:600]), np.append(np.zeros(500, np.uint64), base[:600])
    assert not nd.similar(*texts) and nd.similar(*often)
    fields = [[(len(x), nd.word_bins(x).tolist()) for x in pair] for pair in (texts, often)]
    kind = "struct<n_words: int, bins: array<int>>"
    frame = spark.createDataFrame([(at, *pair) for at, pair in enumerate(fields)], f"at int, a {kind}, b {kind}")
    assert [row[0] for row in frame.where(nd.may_be_similar("a", "b")).select("at").collect()] == [1]


def test_texts_with_many_rare_words_in_common_make_one_row(spark):
    """Rows of the join by rare words grow with the pairs that may be similar, not with their words."""
    texts = [prose(40, 100)] + [edited(prose(40, 100), 8 + at, at) for at in range(12)] + [prose(41, 100)]
    docs = spark.createDataFrame([(at, f"{at:03d}", text) for at, text in enumerate(texts)], "t1 long, root string, text string")
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    found = rows(nd.word_pairs(nd._rare_words(docs, none)), "a1", "b1")
    hashes = list(word_hashes(texts))
    want = {(a, b) for a, b in itertools.combinations(range(14), 2) if nd.similar(hashes[a], hashes[b])}
    assert len(found) == len(set(found)) < 14 * 13 / 2
    assert len(want) > 12 and want <= set(found)


def _rare(spark, texts):
    docs = [(at, f"{at:03d}", text) for at, text in enumerate(texts)]
    frame = spark.createDataFrame(docs, "t1 long, root string, text string")
    return nd._rare_words(frame, (np.empty(0, np.uint64), np.empty(0, np.int64)))


def test_rows_of_the_word_join_do_not_grow_with_the_text(spark):
    """A long text has more rows, but none of them carries all of its words."""
    texts = [prose(50, 4000), edited(prose(50, 4000), 300, 1), prose(51, 50), edited(prose(51, 50), 4, 2)]
    found = nd.word_rows(_rare(spark, texts)).collect()
    assert {row["t1"] for row in found} == {0, 1, 2, 3}
    assert sum(row["t1"] == 0 for row in found) > 10 * nd.LEAST
    assert all(len(row["least"]) <= nd.LEAST and len(row["bins"]) <= nd.DEEP * nd.BINS // 32 for row in found)
    assert rows(nd.word_pairs(_rare(spark, texts)), "a1", "b1") == [(0, 1), (2, 3)]


def test_words_that_only_texts_of_other_lengths_have_make_no_rows(spark):
    whole = prose(52, 300).split(" ")
    texts = [" ".join(whole), " ".join(whole[:150]), " ".join(whole[:60])]
    assert nd.word_rows(_rare(spark, texts)).count() == 0
    shorter = [" ".join(whole[:n]) for n in (100, 80)]
    assert rows(nd.word_pairs(_rare(spark, shorter)), "a1", "b1") == [(0, 1)]
    n = np.arange(1, 200_000)
    least = n - np.floor((1 - nd.SIMILARITY) * n + 1e-9)
    bands = [np.floor(np.log(x) / np.log(nd.BAND)) for x in (least, n)]
    assert (bands[1] - bands[0]).max() == 1
