from collections import defaultdict

from pyspark.sql import functions as F

from blotter.llm import mixing
from blotter.llm.mixing import mix_sources, prefix_sums
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset, words


def targets(sizes, weights, epochs=3):
    """Water filling by repeated sharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if epochs * sizes[s] < w[s] * unit}
        if not full:
            return out | {s: w[s] * unit for s in open_}
        for s in full:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def check(rows, docs):
    """rows: result with source; docs: (id, source, text)."""
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, t in docs:
        n = len(words(t))
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = targets(sizes, (1, 2, 3))
    assert len(rows) == len(docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= sum(largest.values()), s


def with_source(spark, df, result):
    # (id, size) is enough to find a row's source again in these tables
    return result.join(df.selectExpr("doc_id", "source").distinct(), "doc_id").collect()


def test_weights_and_reruns(spark):
    docs = [(i, ("x", "y", "z", None, "small")[i % 5 if i % 50 else 4 if i < 100 else 0], " ".join(["w"] * (i * 37 % 23 + 1))) for i in range(600)]
    docs = [(i, "x" if i % 3 == 0 else s if s != "small" or i < 40 else "y", t) for i, s, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    first, second = mix_sources(df.repartition(5)), mix_sources(df.repartition(2))
    assert multiset(first.collect()) == multiset(second.collect())
    check(with_source(spark, df, first), docs)
    assert sum(r["taken"] for r in first.collect()) <= sum(len(t.split()) for _, _, t in docs)


def test_edges(spark):
    rows = mix_sources(edge_docs(spark)).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for _, t, *_ in TEXTS)
    assert mix_sources(empty_docs(spark)).count() == 0
    blank = mix_sources(spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2


def brute_queue(docs, key, epochs=3):
    """Copies of (id, source, text) taken, by one queue per source and one sorted list of all copies."""
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(words(t))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    copies = []
    for s in names:
        mine = sorted((key[i], i, len(words(t))) for i, z, t in docs if z == s)
        for e in range(epochs):
            served = e * sizes[s]
            for k, i, n in mine:
                served += n
                if n:
                    copies.append((served / weight[s], k, i, n))
    left, out = sum(sizes.values()), defaultdict(int)
    for _, _, i, n in sorted(copies):
        if n > left:
            break
        left -= n
        out[i] += n
    return out


def test_taken_against_a_queue(spark, monkeypatch):
    """Every document's taken words, with one source of a third of all rows and many small ones."""
    docs = [(i, "big" if i % 3 == 0 else f"s{i % 71}" if i % 5 else None, " ".join(["w"] * (i * 31 % 17))) for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    key = {r["doc_id"]: r["k"] for r in df.select("doc_id", F.xxhash64(F.lit(20240501), "doc_id", "text").alias("k")).collect()}
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = mix_sources(df.repartition(4)).collect()
    want = brute_queue(docs, key)
    assert {r["doc_id"]: r["taken"] for r in rows} == {i: want[i] for i, _, _ in docs}
    check(with_source(spark, df, mix_sources(df)), docs)


def test_prefix_sums(spark):
    rows = [(i * 7919 % 1000, i, i % 13) for i in range(1000)]
    got = prefix_sums(spark.createDataFrame(rows, "o long, i long, n long"), ["o", "i"], ["n"], 9).collect()
    before, total = {}, 0
    for o, i, n in sorted(rows):
        before[i] = total
        total += n
    assert {r["i"]: r["before_n"] for r in got} == before
    assert prefix_sums(spark.createDataFrame(rows[:0], "o long, i long, n long"), ["o"], ["n"], 3).count() == 0
