"""The three operators of DataFrame functions only: against SQL, by hand, and without Python in the plan."""

import datetime
import re
import time
from collections import Counter

from blotter.llm import host_rules, line_templates, url_filter
from tests.conftest import SF_SMALL, duck_for
from tests.helpers import same_result
from tests.llm.data import TEXTS, edge_docs, empty_docs, multiset, words


def con():
    c = duck_for(SF_SMALL)
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def no_python(df):
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def counts(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    again = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if again[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_host_rules(spark):
    df = host_rules.op7_host_rules(spark, SF_SMALL)
    no_python(df)
    same_result(df, con(), host_rules.SQL)
    got = host_rules.host_rules(edge_docs(spark)).collect()
    assert multiset((r["doc_id"], *r[1:7]) for r in got) == multiset((i, *counts(t)) for i, t, *_ in TEXTS)
    assert host_rules.host_rules(empty_docs(spark)).count() == 0


def test_bad_host_takes_its_clean_documents(spark):
    clean = " ".join(f"word{i}" for i in range(30))
    rows = [(i, clean if i % 10 == 0 else "bad", "junk") for i in range(100)] + [(100 + i, clean, f"good{i % 4}") for i in range(200)]
    rows += [(300, clean, "junk2"), (301, "bad", "junk2")]
    got = {r["doc_id"]: r for r in host_rules.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0]["host_failed"] and not got[0]["base_failed"] and not got[0]["kept"]
    assert all(got[i]["kept"] for i in range(100, 300))
    assert got[300]["host_rate"] < 0.5  # one failure of two pages is shrunk towards the rest


def test_line_templates_sql(spark):
    df = line_templates.op4_line_templates(spark, SF_SMALL)
    no_python(df)
    same_result(df, con(), line_templates.SQL)


def kept_lines(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in line_templates.dedup_lines(docs, **options).collect()}


def test_line_templates_by_hand(spark):
    texts = [f"own line number {'abcdefgh'[i] * 3} stays\nUser {i}{i} logged in from 10.0.0.{i} at noon\n"
             f"closed by operator {'xyzuvwst'[i]} today as usual again" for i in range(8)]
    texts += ["User 7 logged in from 10.1.1.1 at noon", "", None, "\n\n"]
    got = kept_lines(spark, texts)
    for i in range(8):
        # one literal behind the leading three tokens does not make a template, three do
        assert got[i]["text"] == texts[i].split("\n")[0] and got[i]["n_dropped"] == 2
    assert got[8]["text"] == "" and got[9]["text"] == "" and got[10]["text"] is None and got[11]["text"] == "\n\n"
    assert got[10]["n_lines"] == 0 and got[11]["n_lines"] == 3
    assert all(r["n_dropped"] == 0 for r in kept_lines(spark, texts[:2]).values())


def test_line_templates_are_not_loose(spark):
    """Equal beginnings, and lines of numbers, are no templates; several templates of a leaf are found."""
    texts = ["I do not know\n2019 12 5 77", "I do not agree\n1 2 3 4", "I do not care\n8 9 10 11", "I do not know why he went home\nPage 1",
             "I do not see how that could help\nPage 2", "I do not think so at all today\nPage 3"]
    got = kept_lines(spark, texts)
    assert all(got[k]["text"] == t for k, t in enumerate(texts))
    leaf = [f"the old house {a} was built by {b} masons" for a, b in
            [("here", "local"), ("there", "local"), ("nearby", "local"), ("here", "foreign"), ("there", "foreign"), ("nearby", "unknown")]]
    got = kept_lines(spark, leaf)
    # five literals behind the beginning in common: with "local" masons three documents, with "foreign" ones two
    assert [got[k]["n_dropped"] for k in range(6)] == [1, 1, 1, 0, 0, 0]
    same = kept_lines(spark, ["Page 1", "Page 1", "Page 1", "Page 2", "7", "7", "7"])
    assert [same[k]["n_dropped"] for k in range(7)] == [1, 1, 1, 0, 1, 1, 1]


def test_line_templates_are_linear(spark):
    """A token of a million characters, and fifty thousand recurring lines in a document."""
    many = "\n".join(f"line with the words a{k}b and some more of them" for k in range(50_000))
    long = "x" * 1_000_000
    texts = [long + " 1 2", long + "7 y", many, many + "\nan end of its own", "other\n" + many, "\n".join(f"only {'w' * (k % 97)}{k}" for k in range(20_000))]
    began = time.time()
    got = kept_lines(spark, texts)
    assert time.time() - began < 60
    assert [got[k]["n_dropped"] for k in range(5)] == [0, 0, 50_000, 50_000, 50_000]
    assert got[2]["text"] == "" and got[3]["text"] == "an end of its own" and got[4]["text"] == "other"


def test_line_templates_edges(spark):
    got = line_templates.dedup_lines(edge_docs(spark)).collect()
    assert multiset((r["doc_id"], r["text"]) for r in got) == multiset((i, t) for i, t, *_ in TEXTS)
    assert line_templates.dedup_lines(empty_docs(spark)).count() == 0


def test_url_filter_sql(spark):
    df = url_filter.op6_url_filter(spark, SF_SMALL)
    no_python(df)
    same_result(df, con(), url_filter.SQL)


def test_url_filter_by_hand(spark):
    d = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    entries = [("bad.org", "block", "add", d(10)), ("bad.org", "block", "remove", d(50)), ("bad.org", "block", "add", d(90)),
               ("ok.bad.org", "allow", "add", d(20)), ("tie.org", "block", "add", d(5)), ("tie.org", "allow", "add", d(5)),
               ("tie2.org", "block", "add", d(5)), ("tie2.org", "block", "remove", d(5)),
               (None, "block", "add", d(1)), ("nul.org", "block", "add", None)]
    captures = [(1, "http://bad.org/x", d(9)), (2, "http://bad.org/x", d(10)), (3, "HTTP://u@WWW.Bad.org:80/", d(49)),
                (4, "http://bad.org", d(50)), (5, "http://bad.org", d(400)), (6, "http://a.ok.bad.org/", d(30)),
                (7, "http://ok.bad.org/", d(15)), (8, "http://notbad.org/", d(15)), (9, "http://tie.org/", d(5)),
                (10, "http://tie2.org/", d(6)), (11, None, d(15)), (12, "http://bad.org/", None), (13, "no host", d(15)),
                (None, "http://bad.org/", d(12)), (2, "http://bad.org/x", d(10))]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched date").selectExpr("*", "1 AS row", "2 AS host", "3 AS pattern")
    e = spark.createDataFrame(entries, "pattern string, verdict string, action string, day date")
    got = url_filter.filter_urls(c, e)
    blocked = sorted((r["page_id"] or 0) for r in got.collect() if r["blocked"])
    assert blocked == [0, 2, 2, 3, 5, 7, 10] and got.count() == len(captures)
    assert {r["page_id"]: r["since"] for r in got.collect()}[5] == d(90)
    assert url_filter.filter_urls(c.limit(0), e).count() == 0
    assert not any(r["blocked"] for r in url_filter.filter_urls(c, e.limit(0)).collect())


def test_url_filter_deep_hosts(spark):
    day = datetime.date(2024, 1, 1)
    deep = ".".join(f"l{i}" for i in range(14))
    entries = [(f"{deep}.farm.org", "block", "add", day), ("parent.org", "block", "add", day), (f"{deep}.parent.org", "allow", "add", day)]
    captures = [(1, f"http://{deep}.farm.org/", day), (2, f"http://x.{deep}.farm.org/", day), (3, "http://farm.org/", day),
                (4, f"http://a.{deep}.parent.org/", day), (5, f"http://b{deep}.parent.org/", day), (6, f"http://{'a.' * 200}parent.org/", day)]
    got = {r["page_id"]: (r["blocked"], r["pattern"]) for r in url_filter.filter_urls(
        spark.createDataFrame(captures, "page_id long, url string, fetched date"),
        spark.createDataFrame(entries, "pattern string, verdict string, action string, day date")).collect()}
    assert got == {1: (True, entries[0][0]), 2: (True, entries[0][0]), 3: (False, None), 4: (False, entries[2][0]),
                   5: (True, "parent.org"), 6: (True, "parent.org")}


def test_url_filter_list_side(spark):
    """An entry is one row, however long it holds; only what is asked for is copied, once per salt that asks."""
    day = datetime.date(2024, 1, 1)
    entries = spark.createDataFrame([(f"h{i}.org", "block", "add", day) for i in range(500)], "pattern string, verdict string, action string, day date")
    dated = url_filter.timeline(entries)
    asked = spark.createDataFrame([("h1.org", 3), ("h1.org", 3), ("h1.org", 4), ("h2.org", 3), ("not.listed", 3)], "pattern string, salt int")
    side = url_filter.list_side(asked, dated).collect()
    assert sorted((r["pattern"], r["salt"]) for r in side) == [("h1.org", 3), ("h1.org", 4), ("h2.org", 3)]
    # a year of captures of one hot host: each gets the entry of its day
    captures = [(i, "http://a.h7.org/", day + datetime.timedelta(i % 365)) for i in range(2000)]
    feed = [("h7.org", "block", "add", day + datetime.timedelta(10)), ("h7.org", "block", "remove", day + datetime.timedelta(300))]
    got = url_filter.filter_urls(spark.createDataFrame(captures, "page_id long, url string, fetched date"),
                                 spark.createDataFrame(feed, "pattern string, verdict string, action string, day date")).collect()
    assert all(r["blocked"] == (10 <= r["page_id"] % 365 < 300) for r in got) and len(got) == 2000
