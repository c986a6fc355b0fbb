"""Line dedup by a log-template tree, in DataFrame expressions only.

A line's leaf in the tree is given by its number of tokens and its first
``DEPTH`` tokens; tokens with a digit are variable fields and stand as ``<*>``
everywhere. In a leaf, the tokens behind the leading ones are cut into ``BLOCKS``
runs, and each template leaves one run open: lines that differ in that run only are
one template, and so are lines that do not differ once their digits are masked. A
leaf can hold any number of templates.

A template must say something: behind the leading tokens its literal tokens (neither
open nor ``<*>``) must be ``MIN_LITERALS`` or more, and at least ``SIMILAR`` of all tokens
there. A masked line with fewer than ``MIN_LITERALS`` literal tokens in all is no template; such a line
recurs by its exact text only. Lines of templates (or exact texts) that occur in ``min_docs``
documents or more are dropped, in every document.

The text is read once for the lines, of which only hashes are kept, and once,
with the result, for the output; no line's text is shuffled. Only lines in leaves that recur get their templates
counted, and a template that a third of all documents has is one row per task
there. A document's dropped lines come back as one array of positions. Every step is linear
in a line's and a token's length.

Lines are what ``\\n`` separates; tokens ``[^\\x20\\x09-\\x0D]+``; lines without a token
stay as they are. A NULL text stays NULL. Rows equal in id and text count as one
document. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter.llm.common import pick, salted_join, settle, table

DEPTH = 3
BLOCKS = 4
SIMILAR = 0.6
MIN_LITERALS = 3
MIN_DOCS = 3
SPACE = r"[\x20\x09-\x0D]+"
FIELD = "<*>"


def _literals(tokens: Column) -> Column:
    """Number of tokens that are no variable field."""
    return F.when(F.col("digits"), F.size(F.array_remove(tokens, FIELD))).otherwise(F.size(tokens))


def line_keys(docs: DataFrame) -> DataFrame:
    """doc, at, leaf, whole and open (an array) of every line with a token: hashes of the line's leaf, of the whole line, and of
    the templates with one open run. From columns doc and text."""
    lines = (docs.filter(F.col("text").isNotNull())
             .select("doc", F.posexplode(F.split("text", "\n")).alias("at", "line"))
             .withColumn("line", F.trim(F.when(F.col("line").rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace("line", SPACE, " "))
                                        .otherwise(F.col("line"))))
             .filter("line <> ''")
             .withColumn("digits", F.col("line").rlike("[0-9]"))
             .withColumn("exact", F.split("line", " ")))
    # token by token, so that a very long token costs its length
    masked = F.when(F.col("digits"), F.transform("exact", lambda t: F.when(t.rlike("[0-9]"), FIELD).otherwise(t))).otherwise(F.col("exact"))
    cut = lines.select("doc", "at", "digits", "line", masked.alias("tokens")).withColumn("n", F.size("tokens"))
    behind = F.greatest(F.col("n") - DEPTH, F.lit(0))
    bound = [(DEPTH + F.ceil(behind * b / BLOCKS)).cast("int") for b in range(BLOCKS + 1)]
    runs = [F.slice("tokens", bound[b] + 1, bound[b + 1] - bound[b]) for b in range(BLOCKS)]
    hashed = cut.select(
        "doc", "at", "n", F.xxhash64("n", F.slice("tokens", 1, DEPTH)).alias("leaf"), F.xxhash64("line").alias("exact"),
        _literals(F.slice("tokens", 1, DEPTH)).alias("lead"),
        F.array(*[F.struct(F.xxhash64(r).alias("h"), F.size(r).alias("n"), _literals(r).alias("literals")) for r in runs]).alias("runs"))
    hashes = [F.col("runs")[b]["h"] for b in range(BLOCKS)]
    literals = F.aggregate("runs", F.lit(0), lambda s, r: s + r["literals"])

    def template(b: int) -> Column:
        kept = F.col("literals") - F.col("runs")[b]["literals"]
        fits = (F.col("runs")[b]["n"] > 0) & (kept >= MIN_LITERALS) & (kept >= SIMILAR * (F.col("n") - DEPTH))
        return F.when(fits, F.xxhash64("leaf", F.lit(b), *[h for k, h in enumerate(hashes) if k != b]))

    whole = F.when(F.col("lead") + F.col("literals") >= MIN_LITERALS, F.xxhash64("leaf", *hashes)).otherwise(F.xxhash64("leaf", "exact"))
    return (hashed.withColumn("literals", literals)
            .select("doc", "at", "leaf", whole.alias("whole"), F.array_compact(F.array(*[template(b) for b in range(BLOCKS)])).alias("open")))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, dropped): positions of the lines to drop, from columns doc and text."""
    lines = settle(line_keys(docs))
    # a leaf with fewer lines has no template in min_docs documents
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") >= min_docs).select("leaf")
    keys = (salted_join(lines, leaves, ["leaf"], F.col("doc"))
            .select("doc", "at", F.explode(F.concat(F.array("whole"), "open")).alias("key")))
    keys = settle(keys)
    gone = (keys.select("key", "doc").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
            .filter(F.col("docs") >= min_docs).select("key"))
    return (salted_join(keys, gone, ["key"], F.xxhash64("doc", "at")).groupBy("doc").agg(F.collect_set("at").alias("dropped")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text (without the dropped lines), n_lines and n_dropped of every document."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc", F.xxhash64("doc_id", "text"))
    dropped = dropped_lines(rows.select("doc", "text"), min_docs)
    joined = (rows.join(dropped, "doc", "left").withColumn("lines", F.split("text", "\n"))
              .withColumn("n_lines", F.coalesce(F.size("lines"), F.lit(0))))
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "dropped")
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return joined.select(
        "doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.col("n_lines").cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL
), numbered AS (
  SELECT row_number() OVER () AS doc, doc_id, text FROM d
), cut AS (
  SELECT doc, unnest(string_split(text, chr(10))) AS raw, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i
  FROM numbered
), lines AS (
  SELECT doc, i, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM cut
), tokens AS (
  SELECT doc, i, line, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN string_split(line, ' ')] AS t
  FROM lines WHERE line <> ''
), leafed AS (
  SELECT doc, i, line, t, len(t) AS n, concat(len(t), ' ', array_to_string(t[1:3], ' ')) AS leaf, len([x FOR x IN t IF x <> '<*>']) AS literals
  FROM tokens
), templates AS (
  SELECT doc, i, leaf || ' = ' || CASE WHEN literals >= 3 THEN array_to_string(t, ' ') ELSE '"' || line || '"' END AS template FROM leafed
  UNION ALL
  SELECT doc, i, leaf || ' ' || b || ' = ' || array_to_string(said, ' ') FROM (
    SELECT doc, i, leaf, n, b, t[4:start] || ['...'] || t[stop + 1:] AS said, [x FOR x IN t[4:start] || t[stop + 1:] IF x <> '<*>'] AS sure, start, stop
    FROM (SELECT *, 3 + CAST(ceil((n - 3) * b / 4.0) AS INTEGER) AS start, 3 + CAST(ceil((n - 3) * (b + 1) / 4.0) AS INTEGER) AS stop
          FROM leafed, (VALUES (0), (1), (2), (3)) AS o(b) WHERE n > 3))
  WHERE stop > start AND len(sure) >= 3 AND len(sure) >= 0.6 * (n - 3)
), gone AS (
  SELECT template FROM templates GROUP BY template HAVING count(DISTINCT doc) >= 3
), dropped AS (
  SELECT DISTINCT doc, i FROM templates JOIN gone USING (template)
), kept AS (
  SELECT c.doc, string_agg(c.raw, chr(10) ORDER BY c.i) FILTER (g.i IS NULL) AS text, count(g.i) AS n_dropped
  FROM cut c LEFT JOIN dropped g ON c.doc = g.doc AND c.i = g.i GROUP BY c.doc
)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(string_split(o.text, chr(10))), 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents o
LEFT JOIN numbered n ON n.doc_id IS NOT DISTINCT FROM o.doc_id AND n.text = o.text
LEFT JOIN kept k ON k.doc = n.doc
"""
