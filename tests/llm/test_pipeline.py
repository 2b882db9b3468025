"""The pipeline against the operators' own brute force, stage by stage."""

import corpus_pipeline
from tablepulse.llm import decontaminate, mixing, pii

from .common import SF, edited, prose
from .test_near_dedup import brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_contract(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "pii", "mixing",
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == COLUMNS


def test_decisions_take_effect(spark, documents, tmp_path):
    item = prose(77, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    texts = {i: prose(i, 60) for i in range(30)}
    texts |= {100: edited(texts[0], 2), 101: texts[1], 102: None, 103: "12 34", 104: ""}
    texts |= {105: f"{prose(50, 20)} {item}", 106: f"{prose(51, 30)} a.b@c.org"}
    frame = documents([(i, text, "en", f"s{i % 3}") for i, text in texts.items()])
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    lettered = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    kept = set(brute_force(list(lettered.items())).values()) - {105}
    assert {r["doc_id"] for r in out} <= kept
    assert {100, 101, 102, 103, 104, 105}.isdisjoint(r["doc_id"] for r in out)
    for row in out:
        want = pii.redact(texts[row["doc_id"]], pii.find_spans(texts[row["doc_id"]]))
        assert row["text"] == want and row["n_chars"] == len(want)
        assert "@" not in row["text"]
    copies = {}
    for row in out:
        copies[row["doc_id"]] = copies.get(row["doc_id"], 0) + 1
    assert max(copies.values()) <= 2


def test_every_stage_takes_edges(spark, documents, tmp_path):
    spark.createDataFrame([(1, prose(77, 40))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    names = ", Score double, matches string, size long, h1 long, `count` string, redacted string"
    extra = (0.5, "m", 3, 4, "c", "r")
    rows = [(1, prose(1, 20), "en", "a"), (1, prose(1, 20), "en", "a"), (None, None, None, None)]
    rows += [(4, "", "en", None), (None, prose(2, 20), None, "b"), (6, prose(3, 50000), "en", "b")]
    frame = documents([(*row, *extra) for row in rows], names)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        if name != "mixing":
            assert out.columns == frame.columns, name
        assert {r["h1"] for r in out.collect()} == {4}
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0
    assert decontaminate.SHORTEST > 0 and mixing.DRAW_DIGITS == 13
