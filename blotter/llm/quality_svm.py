"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, linear SVM on top.

Features are indicators, hashed to ``DIMS`` places, of byte 1- to 3-grams, word 1- and
2-grams and 1- to 4-grams of word shapes (leading capital, capitals, last
character if it is no letter or digit, same word as before). With p and q the smoothed
shares of a feature among good and bad texts, a text's vector holds log(p / q) at
its features, over the root of their number. A hinge-loss linear model is fitted
by dual coordinate descent with equal weight for both classes, and its margins are mapped to
0..1 by a logistic curve fitted to a fifth of each class that the model has not seen (to
what it has seen, if a class has under ``MIN_LATE`` rows), shifted to the classes' shares among all labelled rows.

The fit uses a sample of about ``SAMPLE_ROWS`` labelled rows (never more than twice as
many) in one task; both classes have the same quota, and a class within it keeps all its rows
however many the other has. The model has a fixed size. Scoring is one narrow pass over
whole texts. NULL counts as empty; empty texts get a score from the constant term like any
other. NULL labels are not learned; an id's repeated labels are averaged, and of its different
texts one is learned. If the sample
lacks a class, every score is the share of label 1 (0.5 without labels). An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter.llm.common import even_shares, mix64, pick, slices, table
from blotter.llm.language_id import held_out
from blotter.llm.shingles import CHUNK_BYTES, WordHasher

SAMPLE_ROWS = 4_000
DIMS = 1 << 18
SMOOTH = 1.0
COST = 1.0
EPOCHS = 20
MIN_LATE = 10
THRESHOLD = 0.3


class Grams:
    """Distinct hashed n-gram places of texts."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.mark = np.zeros(DIMS, np.int32)
        kind = np.zeros(256, np.uint64)  # of a byte: letter or digit 0, any other ASCII sign its code
        signs = [c for c in range(33, 127) if not chr(c).isalnum()]
        kind[signs] = signs
        self.kind = kind
        self.upper = np.zeros(256, np.uint64)
        self.upper[65:91] = 1
        self.salt = mix64(np.arange(1, 20, dtype=np.uint64))

    def _runs(self, units: np.ndarray, sizes, salt: int) -> list[np.ndarray]:
        """Hashes of the n-grams of ``units`` that begin at each unit, one array per size."""
        out, h = [], np.zeros(len(units), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, max(sizes) + 1):
                h = h[:len(units) - k + 1] * self.salt[k] + units[k - 1:]
                h = h[:len(units) - k + 1]
                if k in sizes:
                    out.append(mix64(h + self.salt[salt + k]) >> np.uint64(46))
        return out

    def __call__(self, texts: list[bytes]):
        """For each text its distinct places."""
        words, counts = self.hasher(texts)
        data = np.frombuffer(b"\n".join(texts) + b"\n\n\n", np.uint8)
        gap = self.hasher.space[data[:-2]]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        same = np.zeros(len(words), np.uint64)
        same[1:] = words[1:] == words[:-1]
        shapes = mix64(self.upper[data[starts]] + self.upper[data[ends - 1]] * np.uint64(2) + same * np.uint64(4)
                       + self.kind[data[ends - 1]] * np.uint64(8)) if len(words) else words
        by_byte = self._runs(mix64(data.astype(np.uint64)), (1, 2, 3), 3)
        by_word = self._runs(words, (1, 2), 8) if len(words) > 1 else []
        by_shape = self._runs(shapes, (1, 2, 3, 4), 12) if len(words) > 4 else []
        at, w = 0, 0
        for text, n in zip(texts, counts.tolist()):
            parts = [g[at:at + max(0, len(text) - k)] for k, g in enumerate(by_byte)]
            parts += [g[w:w + max(0, n - k)] for k, g in enumerate(by_word)]
            parts += [g[w:w + max(0, n - k)] for k, g in enumerate(by_shape)]
            places = np.concatenate(parts).astype(np.int64)
            order = np.arange(len(places), dtype=np.int32)
            self.mark[places] = order  # the last of equal places stays
            yield places[self.mark[places] == order]
            at += len(text) + 1
            w += n


def _features(batches):
    grams = Grams()
    for b in batches:
        raws = b.column("raw").to_pylist()
        for a, z in slices(np.array([len(r) for r in raws], np.int64), CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(a, z - a) for c in ("label", "pick", "share")),
                 pa.array([np.sort(p).astype(np.int32).tobytes() for p in grams(raws[a:z])], pa.binary())],
                names=["label", "pick", "share", "places"])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a light ridge."""
    s, o = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(s * x + o, -30, 30)))
        g = np.array([((p - y) * x).sum() + 1e-2 * (s - 1), (p - y).sum() + 1e-2 * o])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        s, o = s - step[0], o - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(s), float(o)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, dims: int,
                            epochs: int = EPOCHS) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, constant term and dual variables of the hinge-loss linear model
    min |w|^2 / 2 + b^2 / 2 + sum of cost_i * max(0, 1 - y_i (w.x_i + b)), for sparse x_i (places and values)."""
    w, bias, alpha = np.zeros(dims), 0.0, np.zeros(len(y))
    square = [float(v @ v) + 1.0 for v in values]
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)).tolist():
            g = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias, alpha


def _fit(t: pa.Table) -> pa.Table:
    order = np.lexsort((t.column("pick").to_numpy(),))
    y = np.where(t.column("label").to_numpy()[order] >= 0.5, 1, -1)
    stands_for = 1 / t.column("share").to_numpy()[order]  # labelled rows per sampled row
    blobs = t.column("places").to_pylist()
    rows = [np.frombuffer(blobs[i], np.int32) for i in order.tolist()]

    def answer(weights, slope, offset):
        return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()),
                         "slope": pa.array([slope]), "offset": pa.array([offset])})

    classes = [np.flatnonzero(y == c) for c in (1, -1)]
    if not all(map(len, classes)):
        share = min(max(float((y > 0).mean()), 1e-6), 1 - 1e-6)
        return answer(np.zeros(DIMS + 1), 1.0, float(np.log(share / (1 - share))))
    few = min(map(len, classes)) < MIN_LATE
    late = np.concatenate([c[:0] if few else c[::5] for c in classes])
    seen = np.setdiff1d(np.arange(len(y)), late)
    p, q = np.full(DIMS, SMOOTH), np.full(DIMS, SMOOTH)
    for i in seen.tolist():
        (p if y[i] > 0 else q)[rows[i]] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    n = {c: int((y[seen] == c).sum()) for c in (1, -1)}
    cost = np.array([COST * len(seen) / (2 * n[c]) for c in y[seen].tolist()])
    w, bias, _ = dual_coordinate_descent([rows[i] for i in seen], [values[i] for i in seen], y[seen], cost, DIMS)
    held = seen if few else late
    margins = np.array([float(w[rows[i]] @ values[i]) + bias for i in held.tolist()])
    slope, offset = _logistic(margins, (y[held] > 0).astype(float))
    odds = np.log(stands_for[y > 0].sum() / stands_for[y < 0].sum()) - np.log((y > 0).sum() / (y < 0).sum())
    return answer(np.append(w * ratio, bias), max(slope, 1e-3), offset + float(odds))


def train(labelled: DataFrame) -> tuple[np.ndarray, float, float]:
    """Model from columns raw (binary text), label (0..1), pick (order of the sample) and share (of its class that is in the sample)."""
    rows = (labelled.mapInArrow(_features, "label double, pick long, share double, places binary")
            .groupBy(F.lit(1).alias("one")).applyInArrow(_fit, "weights binary, slope double, offset double").collect())
    if not rows:
        return np.zeros(DIMS + 1, np.float32), 1.0, 0.0
    return np.frombuffer(rows[0]["weights"], np.float32), rows[0]["slope"], rows[0]["offset"]


def _score(model):
    weights, slope, offset = model

    def run(batches):
        grams = Grams()
        for b in batches:
            raws, margins = b.column("raw").to_pylist(), []
            for a, z in slices(np.array([len(r) for r in raws], np.int64), CHUNK_BYTES):
                margins += [float(weights[p].sum(dtype=np.float64)) / max(1, len(p)) ** 0.5 for p in grams(raws[a:z])]
            score = 1 / (1 + np.exp(-np.clip(slope * (np.array(margins) + weights[-1]) + offset, -30, 30)))
            rest = [c for c in b.schema.names if c != "raw"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(score, pa.float64()),
                                              pa.array((score >= THRESHOLD).astype(np.int32))], names=[*rest, "score", "predicted"])
    return run


def score_quality(texts: DataFrame, model, text_col: str = "text") -> DataFrame:
    """All columns but the text's, and score, predicted."""
    rest = [F.col(f"`{c}`") for c in texts.columns if c != text_col]
    rows = texts.select(*rest, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("raw"))
    return rows.mapInArrow(_score(model), rows.drop("raw").schema.add("score", "double").add("predicted", "integer"))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Sample of (raw, label, pick, share) from documents (doc_id, text) and labels (doc_id, label): a row per sampled id."""
    labels = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("label").alias("label"))
    pick_order, good = F.xxhash64(F.lit("sample"), "doc_id"), F.col("label") >= 0.5
    shares = even_shares({r["good"]: r["count"] for r in labels.groupBy(good.alias("good")).count().collect()}, SAMPLE_ROWS)
    share = F.when(good, F.lit(float(shares.get(True, 1.0)))).otherwise(F.lit(float(shares.get(False, 1.0))))
    sample = (labels.withColumns({"pick": pick_order, "share": share})
              .filter(F.pmod("pick", F.lit(1 << 30)) / float(1 << 30) < F.col("share")).orderBy("pick").limit(2 * SAMPLE_ROWS))
    # at most 2 * SAMPLE_ROWS narrow rows: the texts need no shuffle; of an id's texts each task sends one
    found = docs.join(F.broadcast(sample), "doc_id").withColumn("raw", F.coalesce("text", F.lit("")).cast("binary"))
    return (found.groupBy("doc_id").agg(F.min_by("raw", F.struct(F.xxhash64("raw"), "raw")).alias("raw"), F.first("label").alias("label"),
                                        F.first("pick").alias("pick"), F.first("share").alias("share"))
            .select("raw", F.col("label").cast("double").alias("label"), "pick", "share"))


def op2_quality_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text").withColumn("held_out", held_out(F.col("doc_id"), 5, 0))
    labels = pick(table(spark, sf_dir, "labels"), doc_id="doc_id", label="quality").filter(~held_out(F.col("doc_id"), 5, 0))
    return score_quality(rows, train(training_rows(rows, labels)))
