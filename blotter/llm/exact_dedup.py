"""Exact dedup by a Golomb-coded fingerprint exchange.

1. One pass over the texts leaves a narrow row per document: id, length, SHA-256
   and a 64-bit fingerprint. It is checkpointed, so a lost executor costs files
   that are still there, and row numbers and source ids never change.
2. Each source (a partition, or a run of ``SOURCE_ROWS`` rows of a larger one) sends its sorted distinct fingerprints, Golomb coded,
   to the owners of equal hash ranges. Owners reply with one bit per value:
   seen in another source too.
3. Rows whose fingerprint is duplicate are suspects. A second pass over the
   texts lets through what a Bloom filter of fixed size (``BLOOM_BITS``) holds
   for the suspects, and groups those texts by their bytes; tasks combine equal
   texts before the shuffle, so a group with a third of all rows sends each
   task's copy once. Beyond some ten million suspects the filter lets more
   texts through; the result does not change.
4. Verdicts go back keyed by (source, SHA-256): a hot group is spread over all sources.

Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``; NULL
counts as empty, and empty texts form one group. The document with the most code
points stays, then the smallest id; a NULL id loses to any other; of identical
repeated rows one stays. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter.llm.common import SPACES, among, distinct, mix64, parts_for, pick, settle, table
from blotter.llm.exchange import decode, encode, owner_cuts, pack_mask, unpack_mask

SOURCE_BITS = 20          # a sender has 2 ** SOURCE_BITS rows of a partition at most
SOURCE_ROWS = 1 << SOURCE_BITS
OWNER_VALUES = 4_000_000  # fingerprints of one owner at scale
BLOOM_BITS = 1 << 25      # fixed size of the broadcast filter: 4 MB
BLOOM_HASHES = 4


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()


def _fingerprints(batches):
    for b in batches:
        sha = [_digest(t.translate(None, SPACES)) for t in b.column("raw").to_pylist()]
        fp = np.frombuffer(b"".join(sha), "<i8")[::4] if sha else np.zeros(0, "<i8")
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("n_points"), pa.array(sha, pa.binary()), pa.array(fp, pa.int64())],
            names=["doc_id", "n_points", "sha", "fp"])


def _send(owners: int):
    def blobs(src, held):
        values, _ = distinct(np.concatenate(held))
        cuts = owner_cuts(values, owners)
        sent = [(o, encode(values[a:z])) for o, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
        return pa.RecordBatch.from_pydict({
            "src": pa.array([src] * len(sent), pa.int64()), "owner": pa.array([o for o, _ in sent], pa.int32()),
            "blob": pa.array([x for _, x in sent], pa.binary())})

    def run(batches):
        src, held = None, []
        for b in batches:
            fp, of = b.column("fp").to_numpy().view(np.uint64), b.column("src").to_numpy()
            # a source's rows stand together
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, z in zip(cuts, cuts[1:]):
                if z > a:
                    if held and of[a] != src:
                        yield blobs(src, held)
                        held = []
                    src = int(of[a])
                    held.append(fp[a:z])
        if held:
            yield blobs(src, held)
    return run


def _reply(t: pa.Table) -> pa.Table:
    """One bit per received value: does another sender have it too?"""
    got = [decode(x) for x in t.column("blob").to_pylist()]
    values, counts = distinct(np.concatenate(got))
    shared = values[counts > 1]
    masks = [pack_mask(among(v, shared)) for v in got]
    return pa.table({"src": t.column("src"), "owner": t.column("owner"), "mask": pa.array(masks, pa.binary()),
                     "n": pa.array([len(v) for v in got], pa.int32())})


def _suspects(rows: pa.Table, masks: pa.Table) -> pa.Table:
    fp = rows.column("fp").to_numpy().view(np.uint64)
    values, counts = distinct(fp)
    order = np.argsort(masks.column("owner").to_numpy())
    blobs, ns = masks.column("mask").to_pylist(), masks.column("n").to_pylist()
    shared = np.concatenate([unpack_mask(blobs[i], ns[i]) for i in order])
    return rows.filter(pa.array(((counts > 1) | shared)[np.searchsorted(values, fp)]))


def _bloom_places(fp: np.ndarray) -> np.ndarray:
    h = mix64(fp)
    step = mix64(h) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(h + step * np.uint64(i)) % np.uint64(BLOOM_BITS) for i in range(BLOOM_HASHES)])


def _bloom_words(batches):
    words = np.zeros(BLOOM_BITS // 64, np.uint64)
    for b in batches:
        at = _bloom_places(b.column("fp").to_numpy().view(np.uint64)).ravel()
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    used = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(words[used].view(np.int64))],
                                     names=["word", "bits"])


def bloom_of(fps: DataFrame) -> np.ndarray:
    """Bloom filter of a long column ``fp``: its size is fixed, so it may be broadcast."""
    rows = (fps.mapInArrow(_bloom_words, "word int, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    words = np.zeros(BLOOM_BITS // 64, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return words


def in_bloom(words: np.ndarray, fp: np.ndarray) -> np.ndarray:
    at = _bloom_places(fp)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _suspect_texts(words: np.ndarray):
    def run(batches):
        for b in batches:
            norm = [t.translate(None, SPACES) for t in b.column("raw").to_pylist()]
            sha = [_digest(t) for t in norm]
            fp = np.frombuffer(b"".join(sha), "<u8")[::4] if sha else np.zeros(0, np.uint64)
            texts = {}  # of this batch, each text once
            for i in np.flatnonzero(in_bloom(words, fp)).tolist():
                texts[norm[i]] = sha[i]
            yield pa.RecordBatch.from_arrays([pa.array(texts.values(), pa.binary()), pa.array(texts.keys(), pa.binary())],
                                             names=["sha", "norm"])
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (see the module's text)."""
    spark = docs.sparkSession
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_points"),
        F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    id_type = texts.schema["doc_id"].dataType
    prints = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_points", T.LongType()),
                           T.StructField("sha", T.BinaryType()), T.StructField("fp", T.LongType())])
    source = F.shiftright(F.monotonically_increasing_id(), SOURCE_BITS)  # partition, and run of its rows
    first = settle(texts.mapInArrow(_fingerprints, prints)
                   .select("*", F.monotonically_increasing_id().alias("row"), source.alias("src")))
    size = first.agg(F.count(F.lit(1)).alias("rows"), F.max(F.shiftright("row", 33)).alias("last")).first()
    n = size["rows"]
    if (size["last"] or 0) + 1 > 2 * parts_for(spark, n, SOURCE_ROWS):
        # many small input splits: fewer, larger senders make longer, better coded lists
        first = settle(first.coalesce(parts_for(spark, n, SOURCE_ROWS)).withColumn("src", source))

    owners = parts_for(spark, n, OWNER_VALUES)
    masks = (first.mapInArrow(_send(owners), "src long, owner int, blob binary")
             .groupBy("owner").applyInArrow(_reply, "src long, owner int, mask binary, n int"))
    suspects = settle(first.groupBy("src").cogroup(masks.groupBy("src")).applyInArrow(_suspects, first.schema))

    words = bloom_of(suspects.select("fp"))
    verified = (texts.select("raw").mapInArrow(_suspect_texts(words), "sha binary, norm binary")
                .groupBy("sha", "norm").count()
                .groupBy("sha").agg(F.count(F.lit(1)).alias("texts")))
    best = F.min(F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "row"))
    groups = suspects.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = (groups.join(verified, "sha")
              .select("sha", "group_size", F.col("best.doc_id").alias("keep_id"),
                      F.when(F.col("texts") == 1, F.col("best.row"))
                      .otherwise(F.raise_error(F.lit("two texts share one SHA-256"))).alias("keep_row")))
    verdicts = suspects.select("src", "sha").distinct().join(groups, "sha")
    mine = F.col("keep_row").isNull()
    return (first.join(verdicts, ["src", "sha"], "left")
            .select("doc_id", F.when(mine, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (mine | (F.col("row") == F.col("keep_row"))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
