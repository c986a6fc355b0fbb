"""Quality rules with host-level verdicts, in DataFrame expressions only.

Every document gets its rule counts; documents that fail the base rules are
added up by host, the hosts' failure rates are shrunk with a beta prior fitted
to all hosts (method of moments), and a host whose shrunk rate is above
``host_limit`` takes all its documents with it. One pass over the texts; what
follows works on the narrow checkpointed counts. Hosts' verdicts are joined back
on (host, salt), so a host with a third of all rows is spread over ``SALTS`` keys.

Words are ``[^\\x20\\x09-\\x0D]+``. ``n_repeat_words`` counts the words covered by
5-word windows that occur twice or more in the text. NULL and empty texts have
no words and fail; a NULL host is a host of its own; repeated rows count each.
With no rows there is no prior and the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter.llm.common import pick, settle, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"  # fixed values: the contract's symbols
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
HOST_LIMIT = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6  # bounds of the prior's pseudo documents
SALTS = 32


def rule_counts(docs: DataFrame) -> DataFrame:
    """Adds word and rule counts to rows with a column ``text``."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(F.size("words") >= WINDOW,
                     F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                                 lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW)))))
    # windows with their starts, sorted: equal ones are neighbours
    ranked = F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                    F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    twice = F.filter("ranked", lambda x, k: (x["h"] == F.get("ranked", k - 1)["h"]).eqNullSafe(True)
                     | (x["h"] == F.get("ranked", k + 1)["h"]).eqNullSafe(True))
    starts = F.sort_array(F.transform("twice", lambda x: x["i"]))
    # each repeated window covers its words up to the next repeated window's start
    covered = F.aggregate(F.transform("starts", lambda s, k: F.coalesce(F.least(F.lit(WINDOW), F.get("starts", k + 1) - s), F.lit(WINDOW))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    return (docs.withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("words", words).withColumn("lines", lines)
            .withColumn("n_words", F.size("words").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
            .withColumn("n_symbols", (F.length("text") - F.length(F.regexp_replace("text", SYMBOL, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
            .withColumn("windows", windows).withColumn("ranked", ranked).withColumn("twice", twice)
            .withColumn("starts", starts).withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
            .drop("text", "words", "lines", "windows", "ranked", "twice", "starts")
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def host_verdicts(counted: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """host_key, host_rate (shrunk) and host_failed of rows with host_key and base_failed."""
    # partial sums per task: a hot host sends one row from each
    hosts = (counted.groupBy("host_key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("bad"))
             .withColumn("rate", F.col("bad") / F.col("n")).withColumn("one", F.lit(1)))
    moments = (hosts.groupBy("one").agg(F.avg("rate").alias("mean"), F.var_pop("rate").alias("var"),
                                        F.avg(1 / F.col("n")).alias("inverse_n")))
    spread = F.col("mean") * (1 - F.col("mean"))
    between = F.col("var") - spread * F.col("inverse_n")  # variance beyond that of counting
    strength = F.when(between > 0, F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), spread / between - 1))).otherwise(F.lit(MAX_STRENGTH))
    prior = moments.select("one", "mean", strength.alias("strength"))  # one row
    rate = (F.col("bad") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return (hosts.join(F.broadcast(prior), "one").withColumn("host_rate", rate)
            .select("host_key", "host_rate", (F.col("host_rate") > host_limit).alias("host_failed")))


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               host_limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate, host_failed, kept."""
    host_key = F.coalesce(F.concat(F.lit("h"), F.col("host").cast("string")), F.lit("n"))
    counted = settle(rule_counts(pick(docs, doc_id=id_col, host=host_col, text=text_col)
                                 .select("doc_id", host_key.alias("host_key"), "text"))
                     .withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")))
    verdicts = (host_verdicts(counted, host_limit)
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return (counted.join(verdicts, ["host_key", "salt"])
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "host_rate", "host_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept")))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(table(spark, sf_dir, "documents")).drop("host_rate")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), starts AS (
  SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 5
), again AS (
  SELECT r, i FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i + 4], ' ')) AS c FROM starts
  ) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2), (3), (4)) AS o(k) GROUP BY r
), c AS (
  SELECT w.doc_id, w.source, CAST(len(words) AS BIGINT) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         CAST(len(lines) - list_unique(lines) AS BIGINT) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
), hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS bad, sum(base_failed::INT) / count(*) AS rate FROM b GROUP BY source
), moments AS (
  SELECT avg(rate) AS mean, var_pop(rate) - avg(rate) * (1 - avg(rate)) * avg(1 / n) AS between_hosts FROM hosts
), prior AS (
  SELECT mean, CASE WHEN between_hosts > 0 THEN greatest(1.0, least(1e6, mean * (1 - mean) / between_hosts - 1)) ELSE 1e6 END AS strength
  FROM moments
), verdicts AS (
  SELECT source, (bad + mean * strength) / (n + strength) > 0.5 AS host_failed FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
       NOT base_failed AND NOT host_failed AS kept
FROM b JOIN verdicts ON b.source IS NOT DISTINCT FROM verdicts.source
"""
