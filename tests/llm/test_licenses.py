import re

import pytest

from blotter.llm import license_rules as lr, license_scan as ls
from tests.conftest import SF_ORACLE, SF_SMALL, duck_for
from tests.helpers import same_result
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset
from tests.llm.test_native import no_python

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = lr.all_rules()


def brute(text, rules=RULES):
    """Every rule on every text, without keywords; suppression by comparing all pairs."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    said = "".join(f"<{w}>" for w in words)
    hits = []
    for n, r in enumerate(rules):
        for m in re.finditer(r.pattern, said):
            start = said.count("<", 0, m.start())
            hits.append((n, r, start, start + m[0].count("<")))
    kept = [(r, s, t) for n, r, s, t in hits if not any(
        (q.priority < r.priority and u < t and s < v) or (q.priority == r.priority and u <= s and v >= t and (v - u > t - s or k < n))
        for k, q, u, v in hits if (k, u) != (n, s))]
    base = [(r.label, s) for _, r, s, _ in hits if r.base]
    labels = {r.label for r, _, _ in kept} | {x for x, _ in base}
    return (len(words), len(base), min((s for _, s in base), default=None), max((s for _, s in base), default=None),
            ",".join(sorted({x for x, _ in base})), ",".join(sorted(labels)), max((lr.CONFIDENCE[r.priority] for r, _, _ in kept), default=0.0))


SAID = {
    "Released under the MIT License.": "mit",
    "UNDER THE MIT\nLICENSE under the mit license, under the MIT license": "mit",
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache-2",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "CC-BY-NC-SA 3.0 unported": "cc-by-nc,cc-by-nc-sa",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
    "GPL version 2 or any later version": "gpl-2-plus",
    "GNU Lesser General Public License v2.1": "lgpl-2.1",
    "the terms of the GNU Affero General Public License version 3 license": "agpl-3",
    "SPDX-License-Identifier: MPL-2.0": "mpl-2.0",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "Creative Commons Attribution-NonCommercial 4.0 International": "cc-by-nc",
    "http://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "released to the public domain": "public-domain",
    "the mit license": "mit",
    "a word about licenses, permission and the general public": "",
    "the Massachusetts mitt licensing office": "",
    "underthe mit license": "mit",
    "under the mİt license, licKense, Ýnder the mit licenseé": "",
    "cc by nc": "",
}


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_sql(spark, sf_dir):
    con = duck_for(sf_dir)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = ls.op12_license_scan(spark, sf_dir)
    no_python(df)
    same_result(df, con, ls.SQL)


def test_by_hand_and_against_brute_force(spark):
    texts = list(SAID) + [" and ".join(SAID), ". ".join(reversed(SAID)), "under the mit license " * 400, "gpl " * 3000]
    got = ls.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [brute(t) for t in texts]
    assert [r["labels"] for r in got[:len(SAID)]] == list(SAID.values())
    assert got[1]["n_base"] == 3 and got[1]["first_word"] == 0 and got[1]["last_word"] == 8


def test_edges(spark):
    got = ls.scan_licenses(edge_docs(spark)).collect()
    assert multiset(got) == multiset((i, *brute(t)) for i, t, *_ in TEXTS)
    assert ls.scan_licenses(empty_docs(spark)).count() == 0


def test_suppression_with_own_rules(spark):
    rules = [lr.Rule("weak", 4, ("b",), "<a><b><c><d>"), lr.Rule("strong", 1, ("c",), "<c>"), lr.Rule("long", 3, ("x",), "<x><y><z>"),
             lr.Rule("short", 3, ("y",), "<y>"), lr.Rule("twin", 3, ("x",), "<x><y><z>"), lr.Rule("left", 2, ("p",), "<p><q>"),
             lr.Rule("right", 2, ("q",), "<q><r>"), lr.Rule("b", 2, ("m",), "<m>", True), lr.Rule("over", 1, ("m",), "<l><m><n>")]
    texts = ["a b c d", "a b d c", "x y z", "y x y z y", "p q r", "l m n", "m l m", "c a b c d x y z p q r l m n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ls.scan_licenses(docs, rules=rules).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [brute(t, rules) for t in texts]
    assert [r["labels"] for r in got[:7]] == ["strong", "strong", "long", "long,short", "left,right", "b,over", "b"]
    spans = {(r["doc_id"], r["label"], r["start"], r["stop"]): r["kept"] for r in ls.license_spans(docs, rules=rules).collect()}
    assert spans[(0, "weak", 0, 4)] is False and spans[(0, "strong", 2, 3)] and spans[(2, "twin", 0, 3)] is False


def test_rules():
    assert len(RULES) >= 300 and sum(r.base for r in RULES) == 3
    for r in RULES:
        assert r.priority in lr.CONFIDENCE and all(WORD.fullmatch(k) and k == k.lower() for k in r.keywords)
        assert re.search(r.pattern, "") is None  # no rule matches nothing
