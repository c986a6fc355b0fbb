import random

from blotter.llm import jaccard_join
from tests.conftest import SF_SMALL, duck_for
from tests.helpers import same_result
from tests.llm.data import TEXTS, components, edge_docs, empty_docs, multiset


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = multiset(jaccard_join.near_duplicates(df).collect())
    want = components(rows)
    assert got == multiset((d, *want[i]) for i, (d, _) in enumerate(rows))


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_edges(spark):
    rows = [(i, t) for i, t, *_ in TEXTS]
    want = components(rows)
    assert multiset(jaccard_join.near_duplicates(edge_docs(spark)).collect()) == multiset((d, *want[i]) for i, (d, _) in enumerate(rows))
    assert jaccard_join.near_duplicates(empty_docs(spark)).count() == 0


def corpus(seed):
    """Families at all distances, two of them sharing a passage, short texts and junk."""
    rng = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(60)]
    for k in range(6):
        base = [f"b{k}_{i}" for i in range(rng.choice((30, 60, 120)))]
        if k < 3:
            base += passage
        texts += family(rng, base, 25, rng.choice((1, 2, 4, 6)))
    texts += [" ".join(rng.choice(("a", "b")) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    texts += [" ".join(passage + [f"u{rng.random()}" for _ in range(rng.randint(0, 40))]) for _ in range(40)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_families(spark):
    check(spark, corpus(1))


def test_long_columns_and_many_senders(spark, monkeypatch):
    for name, value in (("LONG", 2), ("HELD_TOKENS", 1500), ("MIN_FREQUENT", 5), ("BLOCK", 3), ("TILE", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    check(spark, corpus(2))


def test_no_frequent_tokens_known(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MIN_FREQUENT", 10 ** 9)
    monkeypatch.setattr(jaccard_join, "LONG", 8)
    check(spark, corpus(3))


def test_large_groups_are_opened_in_tiles(spark, monkeypatch):
    """Two families of which only a member of one links with the other: no task holds a whole group."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    other, bridge = list(base), list(base)
    for i in (20, 50, 80):
        other[i] = f"c{i}"
    bridge[20] = "c20"
    texts = [" ".join(x) for x in (base, other)] + family(rng, base, 60, 1) + family(rng, other, 60, 1) + [" ".join(bridge)]
    whole = jaccard_join._open

    def bounded(t):
        assert t.num_rows <= 12, t.num_rows
        return whole(t)

    monkeypatch.setattr(jaccard_join, "BLOCK", 1)
    monkeypatch.setattr(jaccard_join, "_open", bounded)
    check(spark, list(enumerate(texts)))


def test_sql(spark):
    con = duck_for(SF_SMALL)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    same_result(jaccard_join.op9_jaccard_join(spark, SF_SMALL), con, jaccard_join.SQL)


def test_owners_follow_the_tokens(spark, monkeypatch):
    """Twenty documents of 20,000 words: no owner holds more than its share of tokens."""
    monkeypatch.setattr(jaccard_join, "OWNER_TOKENS", 2_000)
    monkeypatch.setattr(jaccard_join, "HELD_TOKENS", 50_000)
    rows = [(k, " ".join(f"w{(i * 7919 + k // 2) % 40_009}" if (i + k) % 400 or not k % 2 else "changed" for i in range(20_000))) for k in range(20)]
    whole = jaccard_join._frequent

    def bounded(t):
        assert sum(len(jaccard_join.decode(b)) for b in t.column("blob").to_pylist()) < 8_000
        return whole(t)

    monkeypatch.setattr(jaccard_join, "_frequent", bounded)
    check(spark, rows)


def test_tiles_give_all_pairs_of_a_long_column(spark, monkeypatch):
    """Long columns alone, in tiles of every size, give the pairs that comparing all groups gives."""
    import numpy as np

    rng = np.random.default_rng(5)
    groups = np.arange(1, 91, dtype=np.uint64)
    blob = np.full(90, 7, np.uint64).tobytes() + groups.tobytes() + np.zeros(90, np.uint16).tobytes()
    columns = spark.createDataFrame([(3, bytearray(blob))], "owner int, blob binary")
    info = [(int(g), int(g) % 30, int(n), int(n) + int(g) % 3, int(x)) for g, n, x in zip(groups, rng.integers(5, 40, 90), rng.integers(1, 9, 90))]
    want = {(a[0], b[0]) for a in info for b in info if a[0] < b[0] and a[1] != b[1] and 5 * a[3] >= 4 * b[2] and 5 * b[3] >= 4 * a[2]
            and 9 * (min(a[4], b[4]) + jaccard_join._rest(max(a[3], b[3]))) >= 4 * (a[2] + b[2])}
    df = spark.createDataFrame(info, "grp long, label long, least long, most long, n_long long")
    for tile in (1000, 20, 7):
        monkeypatch.setattr(jaccard_join, "TILE", tile)
        got = [(r["a"], r["b"]) for r in jaccard_join._open_pairs(columns, df).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    one = df.withColumn("label", df["label"] * 0)
    assert jaccard_join._open_pairs(columns, one).count() == 0
