import numpy as np

from tablepulse.llm import language
from tablepulse.llm.queries import QUERIES

from .common import prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_language"](spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(want) and len(held) > 100
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_presence_is_the_set_of_folded_n_grams():
    same = language.presence("Ab  Ç!ab")
    assert (same == language.presence("ab ç 1 AB")).all()
    assert len(language.presence("")) == len(language.presence("12 !? 3")) == 0
    grams = {"ab ç"[i : i + n] for n in (1, 2, 3) for i in range(4 - n + 1)}
    assert len(language.presence("Ab ç")) <= len(grams)
    assert len(language.presence("Ab ç")) >= len(grams) - 1


def test_scores_equal_the_kernel_expansion(spark, documents):
    rows = [(i, prose(i, 30), "aa", "s") for i in range(30)]
    rows += [(100 + i, prose(i, 30).upper()[::-1] + " qu xyz", "bb", "s") for i in range(30)]
    model = language.fit_language(documents(rows), per_language=20, landmarks=8)
    sets = [language.presence(text) for _, text, *_ in rows]
    landmarks = model.landmarks.T
    for buckets, score in zip(sets, model.scores(sets)):
        kernel = np.zeros(len(landmarks))
        for at, landmark in enumerate(landmarks):
            places = model.place[buckets]
            kernel[at] = landmark[places[places >= 0]].sum() / np.sqrt(len(buckets))
        want = kernel @ model.coefficients[:-1] + model.coefficients[-1]
        assert np.allclose(score, want, atol=1e-4)


def test_every_language_is_learned(documents):
    rng = np.random.default_rng(2)
    rows = []
    for number in range(140):
        letters = [chr(0x4E00 + 20 * number + i) for i in range(20)]
        for at in range(3 if number else 60):
            rows.append((len(rows), "".join(rng.choice(letters, 30)), f"l{number:03}", "s"))
    model = language.fit_language(documents(rows), per_language=40, sample=300)
    assert len(model.languages) == 140
    got = language.predict_language(documents(rows), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.9


def test_the_pipeline_rejects_by_the_prediction(documents):
    def other(i):
        return prose(i, 40).translate(str.maketrans("aeioulmnrt", "öäüßyqwxzj"))

    rows = [(i, prose(i, 40), "aa", "s") for i in range(40)]
    rows += [(100 + i, other(i), "bb", "s") for i in range(40)]
    odd = [(200, other(90), "aa", "s"), (201, prose(91, 40), "bb", "s"), (202, "漢字仮名交じり文", "aa", "s"),
           (203, prose(92, 40), None, "s"), (204, other(93), "cc", "s"), (205, "12 34", "aa", "s")]
    model = language.fit_language(documents(rows))
    kept = {r["doc_id"] for r in language.keep_known_language(documents(rows + odd), model).collect()}
    assert kept == {row[0] for row in rows} | {203, 204}


def test_edges(documents):
    rows = [(i, prose(i, 30), "aa", "s", "x") for i in range(20)]
    rows += [(50 + i, " ".join(["zzyx", "wvut"] * 9) + str(i), "bb", "s", "x") for i in range(20)]
    rows += [(50, " ".join(["zzyx", "wvut"] * 9) + "0", "bb", "s", "x")]
    odd = [(90, None, "aa", "s", "x"), (91, "", "bb", None, "x"), (92, "12 !", "aa", "s", "x"),
           (None, "zzyx wvut", None, "s", "x"), (94, "kalo " * 400000, "aa", "s", "x")]
    frame = documents(rows + odd, ", Score string")
    model = language.fit_language(frame)
    out = language.predict_language(frame, model)
    assert [c.lower() for c in out.columns].count("score") == 1
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert got[90] == got[91] == got[92] == ("und", 0.0)
    assert got[None][0] == "bb" and got[94][0] == got[3][0] == "aa" and got[55][0] == "bb"
    kept = language.keep_known_language(frame, model)
    assert kept.columns == frame.columns and kept.count() == len(rows) + 2
    assert language.fit_language(frame.limit(0)) is None
    assert {r["lang_pred"] for r in language.predict_language(frame, None).collect()} == {"und"}
    assert language.predict_language(frame.limit(0), model).count() == 0
