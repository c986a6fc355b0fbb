import math
from collections import Counter, defaultdict

import duckdb
import numpy as np

from blotter.llm import language_id, quality_svm
from blotter.llm.common import even_shares
from tests.conftest import SF_ORACLE
from tests.llm.data import TEXTS, edge_docs, empty_docs


def test_language_held_out(spark):
    got = language_id.op3_language_id(spark, SF_ORACLE).toPandas()
    docs = duckdb.sql(f"SELECT doc_id, lang FROM '{SF_ORACLE}/documents.parquet'").df()
    both = got.merge(docs, on="doc_id")
    held = both[both.held_out]
    assert 200 < len(held) < 500 and len(got) == len(docs)
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_edges(spark):
    docs = edge_docs(spark)
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    assert model["names"] == ["de", "en", "fr"]
    rows = language_id.identify(docs.select("doc_id", "lang", "text"), model).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(TEXTS)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5, 10))
    assert by_id[1]["lang_pred"] == "en" and by_id[2]["lang_pred"] in ("de", "en")
    assert language_id.identify(empty_docs(spark).select("doc_id", "text"), model).count() == 0
    none = language_id.train(empty_docs(spark).select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language_id.identify(docs.select("doc_id", "text"), none).collect()} == {"und"}


def test_backoff_reaches_known_parts(spark):
    docs = spark.createDataFrame([(1, "thether thether other", "en"), (2, "schule schulen schultag", "de")], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    asked = spark.createDataFrame([(1, "ether"), (2, "schulhof"), (3, "zzz")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(asked, model).collect()}
    assert got[1] == "en" and got[2] == "de" and got[3] in ("de", "en")


def test_rare_language_keeps_its_rows_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 60)
    rows = [(i, f"the river and the house w{i}" if i % 2 else f"der fluss und das haus w{i}", "en" if i % 2 else "de") for i in range(6000)]
    rows += [(10000 + i, f"mto na nyumba {'abcde'[i] * 4}", "sw") for i in range(5)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model["names"] == ["de", "en", "sw"]
    assert all(language_id.gram_key(x * 4) in model["orders"][0][0] for x in "abcde")
    asked = spark.createDataFrame([(1, "nyumba na mto"), (2, "the house"), (3, "das haus")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify(asked, model).collect()} == {1: "sw", 2: "en", 3: "de"}
    learned = language_id.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).groupBy("lang").count().collect()
    count = {r["lang"]: r["count"] for r in learned}
    assert count["sw"] == 5 and 10 < count["en"] < 60 and 10 < count["de"] < 60
    shares = even_shares({"a": 10 ** 9, "b": 10 ** 6, "c": 5}, 60)
    assert shares["c"] == 1 and abs(10 ** 9 * shares["a"] + 10 ** 6 * shares["b"] + 5 - 60) < 1e-6
    assert abs(10 ** 9 * shares["a"] - 10 ** 6 * shares["b"]) < 1e-6


def brute_language(texts, learned):
    """Sums of logarithms word by word and gram by gram, floor and discounts included."""
    names = sorted({lang for lang, _ in learned})
    counts = [defaultdict(Counter) for _ in range(6)]
    for lang, text in learned:
        for w in language_id.WORD.findall(text.lower()):
            counts[0][w][lang] += 1
            for n in range(1, 6):
                for k in range(len(w) + 2 - n + 1):
                    counts[n][f" {w} "[k:k + n]][lang] += 1
    total = [{x: sum(c[x] for c in order.values()) for x in names} for order in counts]
    base = [{x: math.log(total[n][x] + 0.5 * max(1, len(counts[n]))) for x in names} for n in range(6)]

    def log(n, gram, lang):
        c = counts[n][gram][lang]
        return math.log(c + 0.5) - base[n][lang] if c else math.log(0.5) - max(base[n].values())

    def backoff(gram, n):
        if gram in counts[n]:
            return [[log(n, gram, x) for x in names]]
        return [] if n == 1 else [[v + math.log(0.4) for v in row] for g in (gram[:-1], gram[1:]) for row in backoff(g, n - 1)]

    for text in texts:
        words = language_id.WORD.findall(text.lower())
        sums = [0.0] * len(names)
        for w in words:
            n = min(5, len(w) + 2)
            rows = [[log(0, w, x) for x in names]] if w in counts[0] else [r for k in range(len(w) + 2 - n + 1) for r in backoff(f" {w} "[k:k + n], n)]
            for k in range(len(names)):
                sums[k] += sum(r[k] for r in rows) / max(1, len(rows))
        best = max(range(len(names)), key=lambda k: (round(sums[k], 6), -k))
        p = [math.exp(2 * (v - max(sums)) / len(words)) for v in sums]
        yield names[best], p[best] / sum(p)


def test_language_against_brute_force(spark):
    learned = [("en", "The river and the house, the old house"), ("de", "Der Fluss und das Haus, schöne alte Häuser"),
               ("fr", "la rivière et la maison été"), ("xx", "qqq zzz the der la"), ("en", "houses rivers")]
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(learned)], "doc_id long, text string, lang string")
    texts = ["riverside housing", "Flusshaus Hausfluss", "maisonnette", "the der la zzz", "ÉTÉ häuslich", "w", "ŋŋŋ ŧŧ the", "a b c d house " * 30, "qqqqqqqqqq" * 50]
    got = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), language_id.train(docs)).orderBy("doc_id").collect()
    for r, (lang, score), text in zip(got, brute_language(texts, learned), texts):
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-4, (text, r, lang, score)


def test_many_languages_need_little_memory(spark):
    """150 languages of their own words: the model grows with the words, not with words times languages."""
    rows = [(i, " ".join(f"{chr(97 + i % 150 // 26)}{chr(97 + i % 150 % 26)}{'abcdefgh'[k % 8]}{'xyzuvw'[k // 8]}{'mnop'[i // 150 % 4]}" for k in range(40)), f"l{i % 150:03d}")
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert len(model["names"]) == 150
    grams, entries = sum(len(o[0]) for o in model["orders"]), sum(len(o[2]) for o in model["orders"])
    held = sum(x.nbytes for o in model["orders"] for x in o)
    assert held == 16 * grams + 8 * entries and held < 150 * 4 * grams / 4
    found = language_id.identify(docs.select("doc_id", "lang", "text"), model)
    assert found.filter("lang = lang_pred").count() > 2900


def test_more_labels_than_sampled_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 40)
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id % 800) AS text", "concat('l', id % 800) AS lang")
    learned = language_id.sample(docs)
    assert 10 < learned.select("lang").distinct().count() <= learned.count() < 120


def test_quality_held_out(spark):
    got = quality_svm.op2_quality_svm(spark, SF_ORACLE).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_ORACLE}/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_edges(spark):
    docs = edge_docs(spark).select("doc_id", "text")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (8, 0), (11, 0), (6, 1), (None, 1), (7, None)], "doc_id long, label int")
    model = quality_svm.train(quality_svm.training_rows(docs, labels))
    rows = quality_svm.score_quality(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    one = quality_svm.train(quality_svm.training_rows(docs, labels.filter("label = 1")))
    assert all(r["predicted"] == 1 for r in quality_svm.score_quality(docs, one).collect())
    none = quality_svm.train(quality_svm.training_rows(docs, labels.filter("label > 5")))
    assert {r["score"] for r in quality_svm.score_quality(docs, none).collect()} == {0.5}
    assert quality_svm.score_quality(empty_docs(spark).select("doc_id", "text"), model).count() == 0


def test_rare_class_is_learned_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(quality_svm, "SAMPLE_ROWS", 400)
    docs = spark.range(60_000).selectExpr(
        "id AS doc_id", "CASE WHEN id IN (7, 30001, 59999) THEN concat('a careful and well made text number ', id, ' with sense') "
        "ELSE concat('xq zz ', id, ' !!! ', id * 7, ' ???') END AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id IN (7, 30001, 59999) AS INT) AS label")
    sample = quality_svm.training_rows(docs, labels).collect()
    assert sum(r["label"] for r in sample) == 3 and 250 < len(sample) < 600
    model = quality_svm.train(quality_svm.training_rows(docs, labels))
    asked = docs.filter("doc_id IN (7, 30001, 59999) OR doc_id % 1000 = 1")
    got = {r["doc_id"]: r["score"] for r in quality_svm.score_quality(asked, model).collect()}
    good = [got.pop(i) for i in (7, 30001, 59999)]
    assert min(good) > 100 * max(got.values())


def test_repeated_ids_give_one_row(spark):
    docs = spark.createDataFrame([(1, "one text"), (1, "another text"), (1, None), (2, "two"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1)], "doc_id long, label int")
    rows = [quality_svm.training_rows(d, labels).orderBy("pick").collect() for d in (docs.repartition(1), docs.repartition(4))]
    assert rows[0] == rows[1] and len(rows[0]) == 2 and sorted(r["label"] for r in rows[0]) == [0.0, 0.5]


def test_solver_against_projected_gradient():
    """Small dense problems: the dual objective equals that of plain projected gradient steps."""
    rng = np.random.default_rng(11)
    for n, dims in ((12, 3), (40, 6), (60, 2)):
        x = rng.normal(size=(n, dims))
        y = np.where(x[:, 0] + 0.7 * rng.normal(size=n) > 0, 1, -1)
        cost = rng.uniform(0.2, 2, n)
        w, bias, alpha = quality_svm.dual_coordinate_descent([np.arange(dims)] * n, list(x), y, cost, dims, epochs=2000)
        z = np.hstack([x, np.ones((n, 1))]) * y[:, None]
        q = z @ z.T
        a, steepest = np.zeros(n), np.linalg.eigvalsh(q)[-1]
        for _ in range(40_000):
            a = np.clip(a + (1 - q @ a) / steepest, 0, cost)
        dual = lambda v: v.sum() - v @ q @ v / 2
        assert abs(dual(alpha) - dual(a)) < 1e-4 * abs(dual(a)) and (alpha >= 0).all() and (alpha <= cost).all()
        assert np.allclose(np.append(w, bias), z.T @ alpha)
        # no gap between primal and dual
        primal = (w @ w + bias * bias) / 2 + (cost * np.maximum(0, 1 - y * (x @ w + bias))).sum()
        assert abs(primal - dual(alpha)) < 1e-2 * abs(primal)
