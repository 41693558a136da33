import numpy as np
import pytest

from tidewatch.llm import language_id, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
ODD = [None, "", "123 !!", "a", "x " * 30000]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op3_language_id(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_language_ridge_equals_brute_force():
    texts = [f"{a} {b} text {i}" for i, (a, b) in enumerate([("der", "hund"), ("the", "cat"), ("le", "chat")] * 7)]
    langs = ["de", "en", "fr"] * 7
    model = language_id.fit_rows(texts, langs, max_n=3, buckets=1 << 12, landmarks=12, ridge=1e-2)
    sets = [set(np.flatnonzero(language_id.presence(t, 3, 1 << 12))) for t in texts]

    def kernel(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    marks = sets[:12]  # dealt over the languages in turn, as the rows are
    k = np.array([[kernel(a, b) for b in marks] for a in sets])
    kmm = np.array([[kernel(a, b) for b in marks] for a in marks])
    y = np.where(np.array(langs)[:, None] == np.array(["de", "en", "fr"])[None, :], 1.0, -1.0)
    w = np.linalg.solve(k.T @ k + 1e-2 * len(texts) * kmm + 1e-8 * np.eye(12), k.T @ y)
    assert model.languages == ["de", "en", "fr"] and np.allclose(model.weights, w, rtol=1e-3, atol=1e-3)


def test_many_languages_and_rows_are_all_learned(spark):
    rows = [(None if i % 9 == 0 else i // 3, " ".join([f"lang{i % 70}word"] * 3) + f" {i % 4}", f"l{i % 70:02d}", 1)
            for i in range(560)]
    rows += rows[:70] + [(1, "x" * 30_000, "long", 1), (2, None, "l00", 1), (3, "no", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, th int")
    model = language_id.fit(df, buckets=1 << 12, max_n=3, rows=210)
    assert model.languages == [f"l{i:02d}" for i in range(70)] and len(model.landmarks) == 210
    got = language_id.identify(spark.createDataFrame([(i, f"lang{i}word", "") for i in range(70)],
                                                     "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id:02d}" for r in got) >= 60


def test_language_edges(docs):
    model = language_id.fit_rows(["the cat is here", "der hund ist da"] * 3, ["en", "de"] * 3)
    rows = language_id.identify(docs(ODD), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows][:3] == ["und"] * 3 and all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(docs([]), model).count() == 0
    assert language_id.keep_identified(docs(ODD[:3]), model).count() == 0


def test_language_kernel():
    texts = ["abcab", "bca", "zz"]
    model = language_id.fit_rows(texts, ["x", "x", "y"])
    sets = [{t[i:i + n] for n in range(1, 5) for i in range(len(t) - n + 1)} for t in texts]
    want = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets]
    got = model.kernel(np.array([language_id.presence(t) for t in texts]))
    order = [0, 2, 1]  # landmarks are dealt over the languages
    assert np.allclose(got, np.array(want)[:, order], atol=1e-5)


def _brute(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {i for i, g in enumerate(grams) if grams.count(g) > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)),
            len({j for i in often for j in range(i, i + 8)}))


@pytest.mark.parametrize("text", [None, "", "a b é\x1cx\n\na b é\x1cx\n \n", "a b " * 9, "#* <x>\n#* <x>",
                                  " ".join(f"w{i % 11}" for i in range(60)), " ".join(f"w{i}" for i in range(40))])
def test_quality_measures(text):
    assert quality.measures(text) == _brute(text)


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").join(
        labels.where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id")
    model = quality.fit(learn.where("doc_id % 3 <> 1"))
    rows = quality.quality_rules(learn.where("doc_id % 3 = 1"), model).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.9


def test_quality_edges(docs):
    rows = quality.quality_rules(docs(ODD), None).orderBy("doc_id").collect()
    assert [r.n_words for r in rows] == [0, 0, 2, 1, 30000] and not any(r.kept for r in rows)
    assert quality.quality_rules(docs([]), None).count() == 0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic IS NOT NULL")
    rows = queries.op10_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    # about a quarter of the rows marked toxic hold no toxic word: the marks are noisy
    assert np.mean(toxic) > 0.65 and np.mean(clean) < 0.01


def test_toxicity_edges(docs):
    model = toxicity.fit_rows([], [])
    rows = toxicity.score_toxicity(docs(ODD), model).collect()
    assert {r.score for r in rows} == {0.5} and toxicity.score_toxicity(docs([]), model).count() == 0
