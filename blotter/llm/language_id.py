"""Language identification: known words first, then shorter and shorter character n-grams.

Training counts words and character n-grams (``MAX_GRAM`` down to 1) of lower-cased
labelled texts per language, over a sample of expected size ``SAMPLE_ROWS`` at most
of the labelled rows: all languages have the same quota, rows that a rare one leaves of it go to
the others, and a language within its quota keeps all its rows, however large the rest is. (With more
labels than ``SAMPLE_ROWS``, about so many are drawn by a hash, with a row or so each.) All words and n-grams of
the sample are learned. A word that the model knows scores its log frequency in each language. Any
other word is cut into n-grams of the longest order; an n-gram that the model lacks is replaced
by its two shorter ones, down to single characters, each step at a fixed
discount. A text's language is the one with the largest sum; the score is the
softmax of the sums per word, so it is a share between 0 and 1.

The model is sparse: for each word or n-gram (by its 64-bit hash) the languages that have it, and how
much more likely it is there than in a language that lacks it. What all languages share
(the floor, the discounts) changes neither the sums' order nor their softmax and is left out.
Its size is that of the sample's distinct n-grams, 12 bytes and about 6 for each of their languages, whatever the number
of languages; sums are taken for ``SUMS`` (text, language) pairs at a time.

Texts that are NULL or have no letter get ``und`` and score 0; ties go to the
language first in code point order. NULL labels are never learned; with no
labelled row at all every text is ``und``. Whole texts are scored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter.llm.common import even_shares, pick, settle, slices, table

SAMPLE_ROWS = 10_000
MAX_GRAM = 5
SHARPNESS = 2.0    # the softmax works on the mean log frequency per word times this
SLICE_BYTES = 1 << 20
SUMS = 2_000_000
CACHE_GRAMS = 300_000

WORD = re.compile(r"[^\W\d_]+")


def _grams(word: str, n: int) -> list[str]:
    s = f" {word} "
    return [s[i:i + n] for i in range(len(s) - n + 1)]


WORD_ROWS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("c", pa.int64())])
GRAM_ROWS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.string()), ("c", pa.int64())])


def _added(rows, schema, limit=500_000):
    """Add up (key, count) pairs from ``rows``; hand out what is held whenever it gets large."""
    held: Counter = Counter()

    def batch():
        keys = [pa.array(x, f.type) for x, f in zip(zip(*held), schema)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(held.values(), pa.int64())], schema=schema)

    for key, c in rows:
        held[key] += c
        if len(held) >= limit:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _count_words(batches):
    return _added((((lang, w), c) for b in batches
                   for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist())
                   for w, c in Counter(WORD.findall(text.lower())).items()), WORD_ROWS)


def _count_grams(batches):
    return _added((((lang, n, g), c) for b in batches
                   for lang, w, c in zip(*(b.column(x).to_pylist() for x in ("lang", "gram", "c")))
                   for n in range(1, MAX_GRAM + 1) for g in _grams(w, n)), GRAM_ROWS)


def sample(labelled: DataFrame) -> DataFrame:
    """Rows (lang, text) to learn from columns ``doc_id`` (only picks the sample, with the text), ``text`` and ``lang``."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = settle(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("c")))
    spread = [(r["c"], r["n"]) for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()]  # a row per size of a label
    labels = sum(n for _, n in spread)
    at = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    if labels > SAMPLE_ROWS:
        drawn = F.pmod(F.xxhash64(F.lit("label"), "lang"), F.lit(1 << 30)) / float(1 << 30) < SAMPLE_ROWS / labels
        labelled, counts, quota = labelled.filter(drawn), counts.filter(drawn), 1.0
    else:
        shares = even_shares({(k, c): c for c, n in spread for k in range(n)}, SAMPLE_ROWS)
        quota = max((c * x for (_, c), x in shares.items()), default=0.0)
    # labels above the quota: SAMPLE_ROWS / quota rows at most, and the quota is 1 or more
    large = counts.filter(F.col("c") > quota).select("lang", (quota / F.col("c")).alias("share"))
    return (labelled.join(F.broadcast(large), "lang", "left")
            .filter(at < F.coalesce("share", F.lit(1.0))).select("lang", "text"))


def gram_counts(learned: DataFrame) -> DataFrame:
    """(lang, n, gram, c) of all words (n = 0) and n-grams of rows (lang, text)."""
    words = settle(learned.mapInArrow(_count_words, "lang string, gram string, c long")
                   .groupBy("lang", "gram").agg(F.sum("c").alias("c")))
    return (words.mapInArrow(_count_grams, "lang string, n int, gram string, c long")
            .groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
            .unionByName(words.select("lang", F.lit(0).alias("n"), "gram", "c")))


def train(labelled: DataFrame) -> dict:
    """Model from columns ``doc_id`` (only picks the sample, with the text), ``text`` and ``lang``."""
    counts = settle(gram_counts(sample(labelled)))
    names = sorted(r["lang"] for r in counts.filter("n = 0").select("lang").distinct().collect())
    ranks = counts.sparkSession.createDataFrame(list(enumerate(names)), "at int, lang string")
    # as many rows as the sample has labels
    kept = (counts.join(F.broadcast(ranks), "lang")
            .select(F.col("n").cast("byte").alias("n"), F.xxhash64("gram").alias("key"), "at", "c").toArrow())
    order, key, at, c = (kept.column(x).to_numpy() for x in ("n", "key", "at", "c"))
    orders = [_order(key[order == n].view(np.uint64), at[order == n], c[order == n], len(names)) for n in range(MAX_GRAM + 1)]
    return {"names": names, "orders": orders}


def _order(key: np.ndarray, at: np.ndarray, c: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, where each one's languages end, the languages, and their gain over a language that lacks the gram."""
    by = np.lexsort((at, key))
    key, at, c = key[by], at[by], c[by].astype(np.float64)
    keys, first = np.unique(key, return_index=True)
    # add half a count; what a language lacks is as rare in all: half a count of the largest
    base = np.log(np.bincount(at, weights=c, minlength=max(1, langs)) + 0.5 * max(1, len(keys)))
    gain = np.log(c + 0.5) - base[at] - (math.log(0.5) - base.max())
    ends = np.append(first[1:], len(key)) if len(keys) else first
    return keys, ends.astype(np.int64), at.astype(np.int32), gain.astype(np.float32)


def gram_key(gram: str) -> int:
    """Spark's xxhash64 of the gram, as an unsigned number."""
    return xxhash.xxh64_intdigest(gram.encode(), 42)


class Scorer:
    """Sums of word gains per language, a slice of texts at a time."""

    def __init__(self, model: dict) -> None:
        self.names, self.orders = model["names"], model["orders"]
        self.starts = [np.concatenate([[0], ends[:-1]]) if len(ends) else ends for _, ends, _, _ in self.orders]
        self.known: dict[str, int] = {}

    def _rows(self, n: int, grams: list[str]) -> np.ndarray:
        """Place of each gram in its order, -1 where the model lacks it."""
        keys = self.orders[n][0]
        if not len(keys):
            return np.full(len(grams), -1, np.int64)
        want = np.fromiter(map(gram_key, grams), np.uint64, len(grams))
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[at] == want, at, -1)

    def _entries(self, n: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the rows each entry belongs to, its language and its gain."""
        _, ends, langs, gain = self.orders[n]
        size = ends[rows] - self.starts[n][rows]
        owner = np.repeat(np.arange(len(rows)), size)
        at = np.arange(size.sum()) + np.repeat(self.starts[n][rows] - np.cumsum(size) + size, size)
        return owner, langs[at], gain[at].astype(np.float64)

    def _backoff(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (word, language, gain) of words that the model lacks: the mean over the word's n-grams, each
        from the longest order that has it."""
        todo: list[tuple[list[int], list[str]]] = [([], []) for _ in range(MAX_GRAM + 1)]
        for k, w in enumerate(words):
            n = min(MAX_GRAM, len(w) + 2)
            grams = _grams(w, n)
            todo[n][0].extend([k] * len(grams))
            todo[n][1].extend(grams)
        found, parts = np.zeros(len(words), np.int64), []
        for n in range(MAX_GRAM, 0, -1):
            owners, grams = todo[n]
            new = [g for g in dict.fromkeys(grams) if g not in self.known]
            self.known.update(zip(new, self._rows(n, new).tolist()))
            rows = np.fromiter(map(self.known.__getitem__, grams), np.int64, len(grams))
            owner, has = np.array(owners, np.int64), rows >= 0
            found += np.bincount(owner[has], minlength=len(words))
            if has.any():
                which, lang, gain = self._entries(n, rows[has])
                parts.append((owner[has][which], lang, gain))
            if n > 1:
                for k in np.flatnonzero(~has).tolist():
                    todo[n - 1][0].extend((owners[k], owners[k]))
                    todo[n - 1][1].extend((grams[k][:-1], grams[k][1:]))
        if len(self.known) > CACHE_GRAMS:
            self.known.clear()
        share = 1 / np.maximum(found, 1)
        return [(owner, lang, gain * share[owner]) for owner, lang, gain in parts]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums (texts x languages) and number of words of each text."""
        number: dict[str, int] = {}
        place, word, times = [], [], []
        for k, text in enumerate(texts):
            counted = Counter(WORD.findall(text.lower()))
            place += [k] * len(counted)
            word += [number.setdefault(w, len(number)) for w in counted]
            times += counted.values()
        place, word, times = np.array(place, np.int64), np.array(word, np.int64), np.array(times, np.float64)
        n_words = np.bincount(place, weights=times, minlength=len(texts))
        vocabulary = list(number)
        rows = self._rows(0, vocabulary)
        unseen = np.flatnonzero(rows < 0)
        seen = np.flatnonzero(rows >= 0)
        which, lang, gain = self._entries(0, rows[seen])
        parts = [(seen[which], lang, gain)]
        parts += [(unseen[owner], lang, gain) for owner, lang, gain in self._backoff([vocabulary[k] for k in unseen.tolist()])]
        of, lang, gain = (np.concatenate(x) for x in zip(*parts))
        by = np.argsort(of, kind="stable")
        lang, gain = lang[by], gain[by]
        ends = np.cumsum(np.bincount(of, minlength=len(vocabulary)))
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        size = (ends - starts)[word]
        at = np.arange(size.sum()) + np.repeat(starts[word] - np.cumsum(size) + size, size)
        sums = np.bincount(np.repeat(place, size) * len(self.names) + lang[at], weights=gain[at] * np.repeat(times, size),
                           minlength=len(texts) * len(self.names))
        return sums.reshape(len(texts), -1), n_words


def _score(model: dict):
    names = model["names"]

    def run(batches):
        scorer = Scorer(model) if names else None
        for b in batches:
            raws = b.column("raw").to_pylist()
            langs, scores = ["und"] * len(raws), np.zeros(len(raws))
            size = np.array([len(r or b"") for r in raws], np.int64)
            # sums of a slice are bounded, too
            for a, z in slices(size + SLICE_BYTES * len(names) // SUMS, SLICE_BYTES) if names else ():
                texts = [(r or b"").decode("utf-8", "replace") for r in raws[a:z]]
                rows = [k for k, t in enumerate(texts) if any(map(str.isalpha, t))]
                if not rows:
                    continue
                sums, n = scorer([texts[k] for k in rows])
                best = sums.argmax(axis=1)
                mean = sums / np.maximum(n, 1)[:, None] * SHARPNESS
                p = np.exp(mean - mean.max(axis=1)[:, None])
                scores[a + np.array(rows)] = p[np.arange(len(rows)), best] / p.sum(axis=1)
                for k, i in zip(rows, best.tolist()):
                    langs[a + k] = names[i]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in b.schema.names if c != "raw"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*(c for c in b.schema.names if c != "raw"), "lang_pred", "score"])
    return run


def identify(texts: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """All columns of ``texts`` but the text's, and lang_pred, score. One narrow pass, no shuffle."""
    rest = [c for c in texts.columns if c != text_col]
    raw = texts.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").cast("binary").alias("raw"))
    schema = raw.drop("raw").schema.add("lang_pred", "string").add("score", "double")
    return raw.mapInArrow(_score(model), schema)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    model = train(rows.filter(~F.col("held_out")).select("doc_id", "text", "lang"))
    return identify(rows.select("doc_id", "held_out", "text"), model)
