"""Hard-negative mining with an inverted multi-index over vectors.

Every vector is cut into two halves, and each half gets the nearest of its own codebook's
words: the pair of words is the row's cell. A half's score with an anchor is at most
its score with the word plus the anchor half's length times the word's radius (the largest
distance of a row from its word, over all rows). A multi-sequence heap gives an
anchor the cells by descending sum of both half bounds, and stops at the first one
below what the anchor still needs. So results are exact; a bad codebook only makes
anchors visit more cells.

1. Codebooks are fitted (k-means) on ``SAMPLE_ROWS`` rows at most, drawn by a hash;
   every row is then assigned to its cell and written to the checkpoint folder.
2. The same sample gives each anchor a floor for its positives: the k-th best score
   of a row with its label. Cells that can reach the floor are visited, each of their
   rows is scored, and while a task visits cells the floor rises to the k-th best found.
3. A positive with score p asks for the best rows of other labels in the window
   from low% to high% of p. The sample again gives floors, the cells that can
   reach the lowest of an anchor's floors are visited, and a window is certified
   when the next cell's bound is below its k-th row, or below the window.

Cells are packed into blocks of ``BLOCK_ROWS`` rows; a cell with more (a vector that a
third of all rows share) is split by row. A block that more than ``QUERY_ROWS`` anchors
visit is copied for each further ``QUERY_ROWS`` of them, so neither side of a task grows. The
driver holds the sample, the codebooks (``MAX_WORDS`` words each) and a row per cell.

Rows with a NULL label, a NULL vector, or a NULL or non-finite component take no part.
Components become floor(scale * x) and scores are their integer inner products;
shorter vectors count as filled up with zeros. Ties go to the smaller id, a NULL
id comes last and is never an anchor. Repeated rows are rows of their own. An empty
table gives an empty result. Vectors whose scores can pass 2 ** 56 are an error.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotter.llm.common import pick, settle, table

SCALE = 256
SAMPLE_ROWS = 10_000
CELL_ROWS = 256
MAX_WORDS = 256
BLOCK_ROWS = 2_048
QUERY_ROWS = 1_024
ROUNDS = 8       # of k-means
SLICE_ROWS = 1_024
LOWEST, HIGHEST = -(1 << 62), 1 << 62


class Shape:
    """Number of components, and the type in which a component is kept."""

    def __init__(self, dims: int, largest: float, scale: int) -> None:
        self.dims, self.scale = dims, scale
        most = math.floor(largest * scale) + 1
        if dims * most * most >= 1 << 56:
            raise ValueError(f"scores of {dims} components of up to {most} can pass 2 ** 56")
        self.kept = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        # whole numbers below 2 ** 53 are exact in double precision
        self.work = np.float64 if dims * most * most < 1 << 53 else np.int64

    def pack(self, vectors: pa.Array) -> np.ndarray:
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = np.floor(self.scale * vectors.flatten().to_numpy().astype(np.float64)).astype(self.kept)
        out = np.zeros((len(vectors), self.dims), self.kept)
        out[np.arange(self.dims) < lengths[:, None]] = flat
        return out

    def blobs(self, x: np.ndarray) -> pa.Array:
        size = self.dims * np.dtype(self.kept).itemsize
        return pa.array([x[i].tobytes() for i in range(len(x))] if size else [b""] * len(x), pa.binary())

    def unpack(self, blobs) -> np.ndarray:
        joined = b"".join(blobs.to_pylist())
        return np.frombuffer(joined, self.kept).reshape(len(blobs), self.dims).astype(self.work)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = (self.dims + 1) // 2
        x = x.astype(np.float64)
        return x[:, :cut], x[:, cut:]


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(axis=1) - 2 * (x @ words.T), axis=1)


def codebook(x: np.ndarray, size: int) -> np.ndarray:
    """k-means words of the sample rows; starts from evenly spaced distinct rows."""
    distinct = np.unique(x, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(size, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        home = nearest(x, words)
        n = np.bincount(home, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, home, x)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def multi_sequence(u: np.ndarray, v: np.ndarray, floor: float):
    """(i, j, u[i] + v[j]) by descending sum, while it is not below ``floor``."""
    by_u, by_v = np.argsort(-u, kind="stable").tolist(), np.argsort(-v, kind="stable").tolist()
    su, sv = u[by_u].tolist(), v[by_v].tolist()
    heap, next_v = [(-su[0] - sv[0], 0, 0)], [0] * len(su)
    while heap:
        bound, a, b = heapq.heappop(heap)
        if -bound < floor:
            return
        yield by_u[a], by_v[b], -bound
        next_v[a] = b + 1
        # a cell enters when its neighbours in both sequences are out
        if b + 1 < len(sv) and (a == 0 or next_v[a - 1] > b + 1):
            heapq.heappush(heap, (-su[a] - sv[b + 1], a, b + 1))
        if a + 1 < len(su) and next_v[a + 1] == b:
            heapq.heappush(heap, (-su[a + 1] - sv[b], a + 1, b))


def _best(anchor: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Positions of each anchor's first k entries by descending score, then key."""
    order = np.lexsort((key, -score, anchor))
    a = anchor[order]
    first = np.ones(len(a), bool)
    first[1:] = a[1:] != a[:-1]
    start = np.flatnonzero(first)
    rank = np.arange(len(a)) - np.repeat(start, np.diff(start, append=len(a)))
    return order[rank < k]


class Index:
    """Codebooks with radii, the sample, and where each cell's rows are."""

    def __init__(self, shape: Shape, words: tuple[np.ndarray, np.ndarray], sample: np.ndarray, sample_labels: np.ndarray,
                 sample_rows: np.ndarray) -> None:
        self.shape, self.words = shape, words
        self.sample, self.sample_labels, self.sample_rows = sample, sample_labels, sample_rows

    def place(self, cells: list) -> None:
        """cells: (i, j, rows, radius of the first half, of the second half)."""
        self.radii = tuple(np.zeros(len(w)) for w in self.words)
        shape = tuple(map(len, self.words))
        self.first, self.subs = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
        block, held = -1, BLOCK_ROWS
        for i, j, n, r, s in sorted(cells):
            self.radii[0][i], self.radii[1][j] = max(self.radii[0][i], r), max(self.radii[1][j], s)
            if held + n > BLOCK_ROWS:
                block, held = block + 1, 0
            self.first[i, j], self.subs[i, j] = block, -(-n // BLOCK_ROWS)
            held += n
            block += int(self.subs[i, j]) - 1

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Highest half scores of each anchor with the rows of each word, rounded up."""
        out = []
        for q, words, radii in zip(self.shape.halves(anchors), self.words, self.radii):
            high = q @ words.T + np.sqrt((q * q).sum(axis=1))[:, None] * radii
            out.append(high + 1e-9 * np.abs(high) + 1e-3)
        return out

    def floors(self, x: np.ndarray, rows: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> np.ndarray:
        """Raises each window's low end to its k-th best row in the sample."""
        scores = (x @ self.sample.T).astype(np.int64)
        ok = (labels[:, None] == self.sample_labels) == same
        ok &= rows[:, None] != self.sample_rows
        out = low.copy()
        for w in range(low.shape[1]):
            fits = ok & (scores >= low[:, w, None]) & (scores <= high[:, w, None])
            if scores.shape[1] >= k:
                kth = -np.partition(np.where(fits, -scores, HIGHEST), k - 1, axis=1)[:, k - 1]
                out[:, w] = np.where(fits.sum(axis=1) >= k, kth, low[:, w])
        return out


def _assign(index: Index):
    def run(batches):
        for b in batches:
            x = index.shape.pack(b.column("vec"))
            columns = [b.column(c) for c in ("row", "id", "label", "anchor")]
            for half, words in zip(index.shape.halves(x), index.words):
                home = nearest(half, words)
                away = np.sqrt(((half - words[home]) ** 2).sum(axis=1))
                columns += [pa.array(home, pa.int32()), pa.array(away, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, index.shape.blobs(x)],
                                             names=["row", "id", "label", "anchor", "i", "away_i", "j", "away_j", "vec"])
    return run


VISITS = ("block long, row long, label long, vec binary, low array<long>, high array<long>, "
          "cells array<int>, bounds array<double>")


def _visits(index: Index, k: int, same: bool):
    """The blocks that each anchor has to visit for its windows, with its cells there and their bounds."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                x = index.shape.unpack(b.column("vec"))
                rows, labels = b.column("row").to_numpy(), b.column("label").to_numpy()
                lists = [b.column(c).to_pylist() for c in ("low", "high")]
                width = max(map(len, lists[0]), default=0)
                # windows that an anchor has not: above all scores
                low, high = (np.array([v + [HIGHEST] * (width - len(v)) for v in x], np.int64).reshape(-1, width) for x in lists)
                low = index.floors(x, rows, labels, low, high, k, same)
                u, v = index.bounds(x)
                blobs = b.column("vec").to_pylist()
                out = []
                for n in range(len(x)):
                    kept = len(lists[0][n])
                    if not kept:
                        continue
                    mine: dict[int, list] = {}
                    for i, j, bound in multi_sequence(u[n], v[n], float(low[n, :kept].min())):
                        for sub in range(index.subs[i, j]):
                            mine.setdefault(int(index.first[i, j]) + sub, []).append((i * len(index.words[1]) + j, bound))
                    out += [{"block": block, "row": rows[n], "label": labels[n], "vec": blobs[n], "low": low[n, :kept],
                             "high": high[n, :kept], "cells": [c for c, _ in cells], "bounds": [y for _, y in cells]}
                            for block, cells in mine.items()]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("block", pa.int64()), ("row", pa.int64()), ("label", pa.int64()), ("vec", pa.binary()),
                    ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())), ("cells", pa.list_(pa.int32())),
                    ("bounds", pa.list_(pa.float64()))]))
    return run


FOUND = "anchor long, high long, row long, id long, score long"


def _search(shape: Shape, k: int, same: bool):
    """A block's rows for its visitors: the first k rows of each window, cells by descending bound."""
    def run(rows: pa.Table, visits: pa.Table) -> pa.Table:
        schema = pa.schema([(n, pa.int64()) for n in ("anchor", "high", "row", "id", "score")])
        if not rows.num_rows or not visits.num_rows:
            return schema.empty_table()
        rows = rows.take(np.argsort(rows.column("cell").to_numpy(), kind="stable"))
        cell = rows.column("cell").to_numpy()
        names, starts = np.unique(cell, return_index=True)
        ends = np.append(starts[1:], len(cell))
        x, q = shape.unpack(rows.column("vec")), shape.unpack(visits.column("vec"))
        ids = rows.column("id")
        key = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        row, label = rows.column("row").to_numpy(), rows.column("label").to_numpy()
        anchor, anchor_label = visits.column("row").to_numpy(), visits.column("label").to_numpy()
        lists = [visits.column(c).to_pylist() for c in ("low", "high")]
        width = max(map(len, lists[0]))
        low, high = (np.array([v + [HIGHEST] * (width - len(v)) for v in y], np.int64) for y in lists)
        bound = np.full((len(q), len(names)), -np.inf)
        for n, (cells, bounds) in enumerate(zip(visits.column("cells").to_pylist(), visits.column("bounds").to_pylist())):
            bound[n, np.searchsorted(names, cells)] = bounds
        held = [[np.zeros(0, np.int64)] * 3 for _ in range(width)]  # visitor, place in the block, score
        for c in np.argsort(-bound.max(axis=0), kind="stable").tolist():
            who = np.flatnonzero(bound[:, c] >= low.min(axis=1))
            if not len(who):
                continue
            here = slice(starts[c], ends[c])
            scores = (q[who] @ x[here].T).astype(np.int64)
            ok = (anchor_label[who][:, None] == label[here]) == same
            ok &= anchor[who][:, None] != row[here]
            for w in range(width):
                a, r = np.nonzero(ok & (scores >= low[who, w, None]) & (scores <= high[who, w, None]))
                if not len(a):
                    continue
                new = [who[a], r + starts[c], scores[a, r]]
                both = [np.concatenate(y) for y in zip(held[w], new)]
                best = _best(both[0], both[2], key[both[1]], k)
                held[w] = [y[best] for y in both]
                # the floor of a full window is its k-th row
                n = np.bincount(held[w][0], minlength=len(q))
                full = np.flatnonzero(n == k)
                low[full, w] = held[w][2][np.cumsum(n)[full] - 1]
        out = []
        for w, (n, at, score) in enumerate(held):
            out.append(pa.table([anchor[n], high[n, w], row[at], ids.take(pa.array(at)), score], schema=schema))
        return pa.concat_tables(out)
    return run


def _round(index: Index, anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """The first k rows of every window of every anchor: anchor, high, rank, id, score."""
    visits = settle(anchors.mapInArrow(_visits(index, k, same), VISITS))
    load = (visits.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
            .select("block", F.ceil(F.col("n") / QUERY_ROWS).cast("long").alias("parts")))
    asked = visits.join(load, "block").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    there = rows.join(load, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    found = (there.select("block", "part", "row", "id", "label", "cell", "vec").groupBy("block", "part")
             .cogroup(asked.select(F.col("block").alias("to"), F.col("part").alias("to_part"), "row", "label", "vec", "low", "high", "cells", "bounds")
                      .groupBy("to", "to_part"))
             .applyInArrow(_search(index.shape, k, same), FOUND))
    order = Window.partitionBy("anchor", "high").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("row")


def build_index(valid: DataFrame, scale: int = SCALE) -> tuple[Index | None, DataFrame | None]:
    """The index and the assigned rows (row, id, label, anchor, block, cell, vec) of valid vectors."""
    size = valid.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims"),
                     F.max(F.array_max(F.transform("vec", F.abs)).cast("double")).alias("largest")).first()
    if not size["n"]:
        return None, None
    shape = Shape(size["dims"], size["largest"] or 0.0, scale)
    drawn = valid.orderBy(F.xxhash64("row", F.lit(7)), "row").limit(SAMPLE_ROWS).select("row", "label", "vec").toArrow()
    sample = shape.pack(drawn.column("vec").combine_chunks())
    words = max(1, min(MAX_WORDS, round(math.sqrt(size["n"] / CELL_ROWS))))
    index = Index(shape, tuple(codebook(h, words) for h in shape.halves(sample)), sample.astype(shape.work),
                  drawn.column("label").to_numpy(), drawn.column("row").to_numpy())
    assigned = settle(valid.mapInArrow(_assign(index), "row long, id long, label long, anchor boolean, i int, away_i double, "
                                                       "j int, away_j double, vec binary"))
    cells = assigned.groupBy("i", "j").agg(F.count(F.lit(1)), F.max("away_i"), F.max("away_j")).collect()
    index.place([tuple(c) for c in cells])
    where = valid.sparkSession.createDataFrame(
        [(c[0], c[1], int(index.first[c[0], c[1]]), int(index.subs[c[0], c[1]])) for c in cells], "i int, j int, first long, subs long")
    rows = (assigned.join(F.broadcast(where), ["i", "j"])  # a row per cell: MAX_WORDS squared at most
            .select("row", "id", "label", "anchor", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("subs"))).alias("block"),
                    (F.col("i") * len(index.words[1]) + F.col("j")).alias("cell"), "vec"))
    return index, rows


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = SCALE) -> DataFrame:
    """For the rows where ``anchor`` holds: their first ``positives`` rows of the same label, and for each of these the first ``negatives``
    rows of other labels with low * positive score <= 100 * score <= high * positive score."""
    spark = vectors.sparkSession
    valid = settle(vectors.withColumn("__anchor", F.coalesce(anchor, F.lit(False)))
                   .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                           F.col(f"`{vector_col}`").alias("vec"), F.col("__anchor").alias("anchor"))
                   .filter(F.col("label").isNotNull() & F.col("vec").isNotNull())
                   .filter(F.forall("vec", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))))
                   .select(F.monotonically_increasing_id().alias("row"), "*"))
    index, rows = build_index(valid, scale)
    if index is None:
        return spark.createDataFrame([], RESULT)
    anchors = rows.filter("anchor AND id IS NOT NULL").select("row", "id", "label", "vec")
    everything = anchors.select("row", "label", "vec", F.array(F.lit(LOWEST)).alias("low"), F.array(F.lit(HIGHEST)).alias("high"))
    found = settle(_round(index, everything, rows, positives, True)
                   .select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("p")))
    ends = F.expr(f"p * {high} div 100 - CAST(p * {high} % 100 < 0 AS BIGINT)"), F.expr(f"p * {low} div 100 + CAST(p * {low} % 100 > 0 AS BIGINT)")
    asked = found.select("anchor", "positive_id", "p", ends[0].alias("high"), ends[1].alias("low"))
    # windows with one high end have one low end: those of equal scores
    windows = (asked.filter("low <= high").groupBy("anchor").agg(F.sort_array(F.collect_set(F.struct("high", "low"))).alias("w"))
               .select(F.col("anchor").alias("row"), F.col("w.low").alias("low"), F.col("w.high").alias("high")))
    hard = (_round(index, anchors.join(windows, "row").select("row", "label", "vec", "low", "high"), rows, negatives, False)
            .select("anchor", "high", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    return (asked.join(hard, ["anchor", "high"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("p").alias("positive_score"), "negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding", label="label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT a, anchor_id, b, id AS positive_id, score AS p FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id, s.b) AS INTEGER) AS rank,
       s.id AS negative_id, p.p AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.a = p.a AND NOT s.same AND 80 * p.p <= 100 * s.score AND 100 * s.score <= 100 * p.p
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id, s.b) <= 5
"""
