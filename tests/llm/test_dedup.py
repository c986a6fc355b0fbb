import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from blotter.llm import exact_dedup, exchange
from tests.conftest import SF_SMALL, duck_for
from tests.helpers import same_result
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=200), st.integers(1, 9))
def test_golomb_round_trip(values, owners):
    v = np.array(sorted(values), np.uint64)
    assert (exchange.decode(exchange.encode(v)) == v).all()
    cuts = exchange.owner_cuts(v, owners)
    parts = [exchange.decode(exchange.encode(v[a:z])) for a, z in zip(cuts, cuts[1:])]
    assert np.concatenate(parts).tolist() == v.tolist()
    assert all((int(x) * owners) >> 64 == o for o, p in enumerate(parts) for x in p)


def brute(rows):
    groups = {}
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    for (d, t), n in zip(rows, norm):
        groups.setdefault(n, []).append((-len(t or ""), d is None, d if d is not None else 0, d))
    out, used = [], set()
    for (d, t), n in zip(rows, norm):
        best = min(groups[n], key=lambda x: x[:3])
        kept = (-len(t or ""), d) == (best[0], best[3]) and n not in used
        if kept:
            used.add(n)
        out.append((d, best[3], len(groups[n]), kept, hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_edges(spark):
    got = exact_dedup.exact_dedup(edge_docs(spark)).collect()
    assert multiset(got) == multiset(brute([(i, t) for i, t, *_ in TEXTS]))
    assert exact_dedup.exact_dedup(empty_docs(spark)).count() == 0


def test_hot_group_and_string_ids(spark):
    rows = [(f"d{i:04d}", "same text" if i % 3 else f"text {i}") for i in range(600)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id string, text string").repartition(7)).collect()
    assert multiset(got) == multiset(brute(rows))


def test_full_bloom_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOOM_BITS", 64)
    assert multiset(exact_dedup.exact_dedup(edge_docs(spark)).collect()) == multiset(brute([(i, t) for i, t, *_ in TEXTS]))


def test_sql(spark):
    con = duck_for(SF_SMALL)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    same_result(exact_dedup.op1_exact_dedup(spark, SF_SMALL), con, exact_dedup.SQL)


def test_a_large_partition_is_several_sources(spark, monkeypatch):
    """One input split of many short texts: no source has more than its rows."""
    monkeypatch.setattr(exact_dedup, "SOURCE_BITS", 5)
    rows = [(i, "same" if i % 3 == 0 else None if i % 7 == 0 else f"t{i % 400}") for i in range(900)]
    whole = exact_dedup._suspects

    def bounded(rows, masks):
        assert rows.num_rows <= 32
        return whole(rows, masks)

    monkeypatch.setattr(exact_dedup, "_suspects", bounded)
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert multiset(got) == multiset(brute(rows))
