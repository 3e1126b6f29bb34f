"""Language and quality models: held-out accuracy and the awkward inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chamberlens.llm import language_id, quality
from chamberlens.llm.grams import gram_counts, linear_svm, packed, platt, unpacked
from chamberlens.llm.language_id import features as language_features, fit_languages, identify_language
from chamberlens.llm.quality import _fitted as quality_fitted, fit_quality, score_quality
from chamberlens.llm.queries import LLM_QUERIES


def test_languages_of_held_out_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang")
    found = LLM_QUERIES["op1_language_id"](spark, medium).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= right[2] <= 1


def test_quality_of_held_out_documents(spark, medium):
    labels = spark.read.parquet(f"{medium}/labels.parquet").select("doc_id", "quality")
    found = LLM_QUERIES["op9_quality"](spark, medium).join(labels, "doc_id").where("held_out")
    rows = found.select("quality", "score", "predicted").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    auc = np.mean([(g["score"] > b["score"]) + 0.5 * (g["score"] == b["score"]) for g in good for b in bad])
    assert auc > 0.97 and np.mean([r["predicted"] for r in good]) > 0.95 and np.mean([r["predicted"] for r in bad]) < 0.2
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_language_model_is_unmoved_by_order_and_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    models = [fit_languages(docs.repartition(n)) for n in (1, 5)]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].languages == models[1].languages


def test_awkward_texts_for_languages(spark, small, docs_of):
    model = fit_languages(spark.read.parquet(f"{small}/documents.parquet"))
    rows = [(1, None), (2, ""), (3, "123 --- !"), (4, "der die das und nicht"), (4, "der die das und nicht"), (5, "\U0001d538"), (6, "the " * 400_000)]
    df = docs_of(rows).selectExpr("*", "'x' AS Score", "'y' AS _lettered", "'z' AS lang_pred")
    got = sorted((r["doc_id"], r["lang_pred"], r["score"] > 0, r["_lettered"]) for r in identify_language(df, model).collect())
    assert [g[1] for g in got[:3]] == ["und"] * 3 and not any(g[2] for g in got[:3])
    assert got[3][1] == got[4][1] == "de" and got[5][1] != "und" and got[6][1] == "en" and got[0][3] == "y"
    assert fit_languages(docs_of([])) is None and fit_languages(docs_of([(1, None), (2, "12")])) is None
    assert [tuple(r) for r in identify_language(docs_of([(1, "word")]), None).select("lang_pred", "score").collect()] == [("und", 0.0)]


def test_one_language_and_lone_families():
    draw = np.random.default_rng(0)
    x = np.abs(draw.normal(size=(60, 1 << language_id.BITS))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one = language_id._fitted(x, np.array(["xx"] * 60))
    assert one.predict("any words") == ("xx", 1.0)
    names = np.array(["en", "de", "nl", "fr", "es", "ja"] * 10)
    many = language_id._fitted(x, names)
    assert many.families == ["germanic", "ja", "romance"] and len(many.pairs) == 4
    language, score = many.predict("any words")
    assert language in set(names) and 0 <= score <= 1


def test_awkward_texts_for_quality(spark, small, docs_of):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    rows = [(1, None), (2, ""), (3, "word " * 300_000), (4, "BUY!! NOW!! "), (4, "BUY!! NOW!! ")]
    df = docs_of(rows).selectExpr("*", "'x' AS score", "'y' AS PREDICTED")
    got = score_quality(df, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert fit_quality(docs, labels.where("quality = 1")) is None and fit_quality(docs, labels.where("false")) is None
    assert fit_quality(docs, labels.withColumn("quality", F.lit(None).cast("int"))) is None
    assert fit_quality(docs.where("false"), labels) is None
    assert [tuple(r) for r in score_quality(docs_of([(1, "a")]), None).select("score", "predicted").collect()] == [(0.5, 1)]


def test_bradley_terry_orders_the_pairs():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 12)).astype(np.float32) * 0.3
    x[:, 0] = np.where(np.arange(300) % 4 == 0, -0.5, 0.5)
    labels = (np.arange(300) % 4 != 0).astype(int)
    model = quality._fitted(x, labels, 0.25, 4000)
    raw = x @ model.weights
    assert raw[labels == 1].min() > raw[labels == 0].max()
    assert raw[labels == 1].min() > model.cut > raw[labels == 0].max()


def test_linear_pieces():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 5)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.sign(x[:, 0] + 0.1)
    w = linear_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.95
    slope, _ = platt((x @ w[:-1] + w[-1]).astype(float), (y > 0).astype(int))
    assert slope > 0
    assert np.array_equal(unpacked([packed(x[0]), packed(x[1])], 5), x[:2])


def test_gram_counts_do_not_depend_on_pieces(monkeypatch):
    text = "some text, with Ümlaut and 12 words " * 50
    whole = gram_counts(text, language_id._LETTERS, 3, 12)
    monkeypatch.setattr("chamberlens.llm.grams.PIECE", 100)
    assert np.array_equal(gram_counts(text, language_id._LETTERS, 3, 12), whole)
    assert gram_counts("", language_id._LETTERS, 3, 12).sum() == 0


def plain_language(model, text):
    """Families, then votes of pairs, by a loop over single linear models."""
    x = language_features(text)

    def p(column):
        margin = sum(float(x[i]) * float(model.weights[i, column]) for i in np.flatnonzero(x)) + float(model.weights[-1, column])
        return 1 / (1 + math.exp(-(margin * model.links[0][column] + model.links[1][column])))

    shares = [p(i) for i in range(len(model.families))]
    best = max(range(len(shares)), key=lambda i: shares[i])
    members = model.languages[model.families[best]]
    score = shares[best] / sum(shares) if len(shares) > 1 else 1.0
    if len(members) == 1:
        return members[0], score
    votes, belief = {m: 0 for m in members}, {m: 0.0 for m in members}
    for i, (a, b) in enumerate(model.pairs):
        if a in members and b in members:
            q = p(len(model.families) + i)
            votes[a if q >= 0.5 else b] += 1
            belief[a], belief[b] = belief[a] + q, belief[b] + 1 - q
    winner = max(members, key=lambda m: (votes[m], belief[m]))
    return winner, score * belief[winner] / (len(members) - 1)


def test_language_predictions_equal_a_plain_loop(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    model = fit_languages(spark.read.parquet(f"{small}/documents.parquet"))
    for r in identify_language(docs.select("doc_id", "text"), model).collect():
        if r["lang_pred"] != "und":
            language, score = plain_language(model, r["text"])
            assert r["lang_pred"] == language and r["score"] == pytest.approx(score, rel=1e-4)


def test_languages_of_few_rows_are_learned(spark, docs_of):
    words = {"en": "the whole story of this house", "de": "das ganze Haus und seine Straße", "fr": "l'été où le garçon était là", "ru": "весь этот старый дом"}
    for few in (1, 2, 3, 4):
        rows = [(i, f"{words[lang]} {i} {words[lang]}", lang) for lang in words for i in range(few if lang == "fr" else 40)]
        docs = spark.createDataFrame([(n, t, lang) for n, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
        model = fit_languages(docs)
        assert model.doubtful == 1 / 5
        found = {r["lang"]: r["lang_pred"] for r in identify_language(docs.where("doc_id % 7 = 0 OR lang = 'fr'"), model).collect()}
        assert found == {lang: lang for lang in words}


def test_bradley_terry_weights_equal_another_solvers():
    """Plain gradient steps on the drawn pairs end at the fitted ranking loss."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5)).astype(np.float32)
    labels = (x @ np.array([2.0, -1, 0.5, 0, 0]) + 0.3 * rng.normal(size=80) > 0).astype(int)
    model = quality_fitted(x, labels, 0.5, 3000)
    draw = np.random.default_rng(7)
    better = x[draw.choice(np.flatnonzero(labels == 1), 3000)].astype(float)
    worse = x[draw.choice(np.flatnonzero(labels == 0), 3000)].astype(float)

    def loss(w):
        return np.logaddexp(0, -(better - worse) @ w).mean() + 0.5e-4 * w @ w

    w = np.zeros(5)
    for _ in range(20_000):
        p = 1 / (1 + np.exp((better - worse) @ w))
        w += 0.5 * ((p[:, None] * (better - worse)).mean(axis=0) - 1e-4 * w)
    assert loss(model.weights.astype(float)) <= loss(w) + 0.02
    assert np.corrcoef(x @ model.weights, x @ w)[0, 1] > 0.98


def test_labels_without_documents_neither_count_nor_are_drawn(spark, docs_of):
    docs = docs_of([(i, f"{'Good words, written well.' if i % 2 else '### 1234 !!! XX %%'} {i}" * 5) for i in range(4)])
    labels = spark.range(500_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    model = fit_quality(docs, labels, sample=100, pairs=200)
    assert model is not None
    scores = {r["doc_id"]: r["score"] for r in score_quality(docs, model).collect()}
    assert min(scores[1], scores[3]) > max(scores[0], scores[2])
    assert fit_quality(docs, labels.where("doc_id > 3")) is None
    assert fit_quality(docs, labels.where("doc_id % 2 = 0")) is None
