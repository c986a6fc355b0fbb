"""Small tables with every awkward case, and brute-force versions of the operators' definitions."""

import re

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, T.LongType() if n in ("doc_id", "n_chars") else T.StringType())
                     for n in ("doc_id", "text", "lang", "source", "n_chars",
                               # names that the operators use inside
                               "row", "raw", "src", "fp", "sha", "part", "sid", "key", "score", "host", "salt", "label", "copies")])
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _long(change=()):
    words = [f"w{i * 7919 % 4001}" for i in range(12000)]
    for i in change:
        words[i] = "changed"
    return " ".join(words)


TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs all the way home.\nA second line of words.", "en", "a"),
    (2, "The  quick brown fox jumps over the lazy dog and runs all the way home. A second line of words.", "en", "a"),
    (2, "Der schnelle braune Fuchs springt ueber den faulen Hund und laeuft dann nach Hause zu uns.", "de", "b"),
    (2, "Der schnelle braune Fuchs springt ueber den faulen Hund und laeuft dann nach Hause zu uns.", "de", "b"),
    (None, "A text whose id is not known but which has quite a few words in it", None, None),
    (None, None, None, None),
    (3, None, "en", "a"),
    (4, "", "en", None),
    (5, " \t\n\r\x0b\x0c ", "de", "b"),
    (6, _long(), "en", "a"),
    (7, _long((5, 4000)), "en", "c"),
    (8, "one two", "en", "c"),
    (9, "One TWO", "en", "c"),
    (10, "12345 !!! ???", "en", "d"),
    (11, "spam spam spam spam spam spam spam spam spam spam spam spam\nspam\nspam", None, "d"),
    (12, "naïve café ▁ underscore   nbsp 日本語 🤷 \x00 zero", "fr", "é"),
]


def edge_docs(spark):
    rows = [(i, t, lang, source, 0 if t is None else len(t), *["x"] * 13) for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def components(rows):
    """{position: (size, component id)} of (id, text) rows by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    home = list(range(len(rows)))

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                home[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return {i: (len(sets[i]), least.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows))}


def multiset(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))
