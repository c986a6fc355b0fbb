"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, repeated up to
``epochs`` times. A copy's virtual finish time is the words its source has
served up to and with it, divided by the source's weight. All copies are sorted
by finish time and the mix is the longest prefix within the word budget: at any
cut, every source that is not used up has served words in proportion to its
weight, which is what the targets ask for.

Running sums over a global order are taken in two levels (``prefix_sums``): Spark's range
partitioner cuts the order into parts of equal rows, sums of the parts are added up, and each part is sorted
by itself. So the cuts are quantiles of finish time, whatever the sources' sizes. A source's own queue is
summed in buckets of its shuffled order; a source that holds most rows is spread over all buckets. Sources are ranked and
filled to their targets in the same way, so there may be as many as there are hosts; windows without
a key run over one row per part.

A document's size is its number of ``[^\\x20\\x09-\\x0D]+`` words; NULL and empty
texts have size 0 and are never taken. Sources are ranked by code point, a NULL
source last; their weights repeat ``weights``. Targets share the budget by
weight, stop at ``epochs`` times the source's size, and what is left over goes
to the others by weight. The order depends on the seed, the id and the text
only, so reruns agree; rows equal in id and text are taken independently, next to each other. An empty
table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from blotter.llm.common import parts_for, pick, settle, table
from blotter.operators.keys import dense_key

BUCKET_ROWS = 200_000  # copies sorted together at scale
LEVELS = 1 << 20       # resolution of the shuffle order's buckets


def _count_words(batches):
    for b in batches:
        # bytes.split() without an argument splits at exactly the six separators
        sizes = [len(t.split()) for t in b.column("raw").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("key"), pa.array(sizes, pa.int64())],
                                         names=["doc_id", "source", "key", "size"])


def prefix_sums(df: DataFrame, order: list[str], columns: list[str], parts: int) -> DataFrame:
    """Adds ``before_<column>``: the sum over all rows that come before in ``order``, which must order the rows fully."""
    # the placement is checkpointed, so a lost task cannot move a row
    placed = settle(df.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (placed.groupBy("part").agg(*[F.sum(c).alias(c) for c in columns])
              .select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"first_{c}") for c in columns]))
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # a row per part, so it may be broadcast
    return (placed.join(F.broadcast(firsts), "part")
            .withColumns({f"before_{c}": F.col(f"first_{c}") + F.coalesce(F.sum(c).over(running), F.lit(0)) for c in columns})
            .drop("part", *[f"first_{c}" for c in columns]))


def _targets(sources: DataFrame, weights: tuple[int, ...], epochs: int, budget: float) -> DataFrame:
    """Weight and target of each source."""
    spark = sources.sparkSession
    all_of = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("words")).first()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int")).cast("long")
    ranked = (dense_key(sources, ["source"], "rank", nulls_last=["source"], start=0).withColumn("weight", weight)
              .withColumn("cap", epochs * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    weights_of_all = ranked.agg(F.sum("weight").alias("w")).first()["w"] or 0
    # sources in the order in which they are used up; the level is what each
    # unit of weight would get if all earlier ones had stopped at their caps
    level = ((F.lit(float((all_of["words"] or 0) * budget)) - F.col("before_cap")) / (F.lit(weights_of_all) - F.col("before_weight")))
    filled = settle(prefix_sums(ranked, ["ratio", "rank"], ["cap", "weight"], parts_for(spark, all_of["n"], BUCKET_ROWS))
                    .withColumn("level", level))
    open_level = (filled.filter(F.col("ratio") > F.col("level"))
                  .agg(F.min_by("level", F.struct("ratio", "rank")).alias("level")).first()["level"])
    cap = F.col("cap").cast("double")
    target = cap if open_level is None else F.least(cap, F.col("weight") * F.lit(open_level))
    return filled.select("source_key", "weight", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, budget: float = 1.0,
                seed: int = 20240501) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes) and copies
    (how often) of every document. ``budget`` is a share of all words."""
    spark = docs.sparkSession
    texts = pick(docs, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", "source", F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    schema = T.StructType([texts.schema["doc_id"], texts.schema["source"], texts.schema["key"], T.StructField("size", T.LongType())])
    sized = settle(texts.mapInArrow(_count_words, schema)
                   .select("*", F.monotonically_increasing_id().alias("row")))
    n = sized.count()
    buckets = parts_for(spark, n, BUCKET_ROWS)
    level = F.shiftright("key", 44) + LEVELS // 2
    # an equality key in place of the source, which may be NULL
    source_key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    queued = sized.withColumn("source_key", source_key).withColumn("bucket", F.floor(level * buckets / LEVELS))

    sums = settle(queued.groupBy("source_key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    sources = sums.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.join(_targets(sources, weights, epochs, budget), "source_key")
              .select("source_key", "bucket", "weight", "target",
                      F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"),
                      F.sum("words").over(Window.partitionBy("source_key")).alias("source_size")))

    running = (Window.partitionBy("source_key", "bucket").orderBy("key", "doc_id", "size", "row")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_pass = settle(queued.join(starts, ["source_key", "bucket"])
                        .withColumn("served", F.col("before") + F.sum("size").over(running))
                        .select("row", "doc_id", "key", "size", "source_size", "weight", "target", "served"))

    copies = (first_pass.filter("size > 0")
              .select("row", "doc_id", "key", "size",
                      F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e:
                                   (F.col("served") + e * F.col("source_size")) / F.col("weight"))).alias("copy", "finish")))
    total = first_pass.agg(F.sum("size").alias("t")).first()["t"] or 0
    by_finish = ["finish", "key", "doc_id", "size", "row", "copy"]
    taken = (prefix_sums(copies, by_finish, ["size"], parts_for(spark, epochs * n, BUCKET_ROWS))
             .filter(F.col("before_size") + F.col("size") <= int(total * budget))
             .groupBy("row").agg(F.count(F.lit(1)).alias("copies")))
    return (first_pass.join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.coalesce("copies", F.lit(0)) * F.col("size")).cast("long").alias("taken"),
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies")))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
