"""License scan by ordered signature rules, in DataFrame expressions only.

A text's words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, written as
``<word><word>...``, so a rule (``license_rules``) is a regular expression over whole words.
One regular expression finds the rules' keywords that a text has; only rules with a
keyword among them are run, on the whole text. All this is one narrow pass without a shuffle,
whose result (a row per document, word counts between and inside matches) is checkpointed.

Detections are word intervals [start, stop). One is suppressed if a rule of a stronger priority
overlaps it, or if one of equal priority contains it (the longer one stays, of equal
intervals the earlier rule). Running maxima and minima over a document's detections by start
decide this without pairs, so a document with very many detections is a sorted
window, not a square. Base phrases are rules like the others, but their counts
and labels stay whatever happens to their detections.

The score is the confidence of the strongest detection that stays, 0 without one. A
NULL or empty text has no words and no detections; repeated rows count each; an empty table
gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotter.llm.common import pick, settle, table
from blotter.llm.license_rules import CONFIDENCE, Rule, all_rules

# The contract's separators of words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RULE = "array<struct<rule:int,label:string,priority:int,base:boolean,keywords:array<string>,pattern:string>>"


def word_text(text: Column) -> Column:
    """``<w1><w2>...`` of a text; '' without words."""
    # the two characters outside A-Z whose lower case has an ASCII letter become others
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ĸ"))
    marked = F.concat(F.lit("<"), F.regexp_replace(F.lower(plain), SEPARATORS, "><"), F.lit(">"))
    return F.replace(marked, F.lit("<>"), F.lit(""))


def _n_words(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit("<"), F.lit("")))


def detections(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """row, doc_id, n_words and hits of every document: for each rule with matches, the numbers of words before the
    first match, in it, up to the next match, and so on. From columns doc_id and text; checkpointed."""
    keywords = sorted({k for r in rules for k in r.keywords})
    table_ = F.from_json(F.lit(json.dumps([{"rule": n, "label": r.label, "priority": r.priority, "base": r.base, "keywords": r.keywords,
                                            "pattern": r.pattern} for n, r in enumerate(rules)])), RULE)
    gated = F.filter(table_, lambda r: F.arrays_overlap(r["keywords"], F.col("found")))
    parts = F.transform(gated, lambda r: F.struct(
        r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"), r["base"].alias("base"),
        F.split(F.regexp_replace(F.col("words"), r["pattern"], F.lit("\n$0\n")), "\n").alias("parts")))
    hits = F.transform(F.filter(parts, lambda h: F.size(h["parts"]) > 1), lambda h: F.struct(
        h["rule"].alias("rule"), h["label"].alias("label"), h["priority"].alias("priority"), h["base"].alias("base"),
        F.transform(h["parts"], lambda p: _n_words(p).cast("int")).alias("counts")))
    return settle(docs.select("doc_id", word_text(F.col("text")).alias("words"))
                  .withColumn("found", F.array_distinct(F.regexp_extract_all("words", F.lit(f"<({'|'.join(keywords)})(?=>)"), F.lit(1))))
                  .select(F.monotonically_increasing_id().alias("row"), "doc_id", _n_words(F.col("words")).cast("long").alias("n_words"),
                          F.when(F.size("found") > 0, hits).alias("hits")))


def resolve(scanned: DataFrame) -> DataFrame:
    """row, rule, label, priority, base, start, stop, kept: every detection, and whether it stays."""
    before = Window.partitionBy("row", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    found = (scanned.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("h"))
             .select("row", "h.rule", "h.label", "h.priority", "h.base", F.posexplode("h.counts").alias("pos", "n"))
             .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .filter(F.col("pos") % 2 == 1).withColumn("stop", F.col("start") + F.col("n")).drop("pos", "n"))
    by_start = Window.partitionBy("row").orderBy("start", F.desc("stop"), "priority", "rule")
    earlier, later = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    dropped = F.lit(False)
    for p in sorted(CONFIDENCE):
        stop = F.max(F.when(F.col("priority") <= p, F.col("stop"))).over(earlier)
        dropped |= (F.col("priority") == p) & (stop >= F.col("stop"))
        if p > min(CONFIDENCE):
            stop = F.max(F.when(F.col("priority") < p, F.col("stop"))).over(earlier)
            start = F.min(F.when(F.col("priority") < p, F.col("start"))).over(later)
            dropped |= (F.col("priority") == p) & (F.coalesce(stop > F.col("start"), F.lit(False)) | F.coalesce(start < F.col("stop"), F.lit(False)))
    return found.withColumn("kept", ~F.coalesce(dropped, F.lit(False)))


def _joined(label: Column) -> Column:
    return F.array_join(F.sort_array(label), ",")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    scanned = detections(pick(docs, doc_id=id_col, text=text_col), rules or all_rules())
    confidence = F.element_at(F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair]), F.col("priority"))
    per_doc = resolve(scanned).groupBy("row").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        _joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        _joined(F.collect_set(F.when(F.col("base") | F.col("kept"), F.col("label")))).alias("labels"),
        F.max(F.when(F.col("kept"), confidence)).alias("score"))
    return scanned.select("row", "doc_id", "n_words").join(per_doc, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, label, priority, rule, start, stop (words from 0) and kept of every detection."""
    scanned = detections(pick(docs, doc_id=id_col, text=text_col), rules or all_rules())
    return (resolve(scanned).join(scanned.select("row", "doc_id"), "row")
            .select("doc_id", "label", "priority", "rule", "start", "stop", "kept"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql(rules: list[Rule]) -> str:
    values = ",\n".join(f"({n}, '{r.label}', {r.priority}, {r.base}, [{', '.join(repr(k) for k in r.keywords)}], '{r.pattern}')"
                        for n, r in enumerate(rules))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH rules(rule, label, priority, base, keywords, pattern) AS (VALUES
{values}
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(trim(regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{SEPARATORS}', ' ', 'g'), ' '), ' ') AS split
  FROM documents
), w AS (
  SELECT r, doc_id, [x FOR x IN split IF x <> ''] AS words FROM d
), t AS (
  SELECT r, words, '<' || array_to_string(words, '><') || '>' AS said FROM w
), matched AS (
  SELECT r, rule, label, priority, base,
         string_split(regexp_replace(said, '(' || pattern || ')', chr(10) || '\1' || chr(10), 'g'), chr(10)) AS parts
  FROM t JOIN rules ON list_has_any(words, keywords) AND regexp_matches(said, pattern)
), counted AS (
  SELECT * EXCLUDE (parts), unnest([length(p) - length(replace(p, '<', '')) FOR p IN parts]) AS n,
         unnest(generate_series(1, len(parts))) AS pos
  FROM matched
), placed AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY r, rule ORDER BY pos) AS BIGINT) AS stop FROM counted
), hits AS (
  SELECT r, rule, label, priority, base, stop - n AS start, stop FROM placed WHERE pos % 2 = 0
), kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (
    SELECT 1 FROM hits e WHERE e.r = h.r AND (
      (e.priority < h.priority AND e.start < h.stop AND h.start < e.stop)
      OR (e.priority = h.priority AND e.start <= h.start AND e.stop >= h.stop
          AND (e.stop - e.start > h.stop - h.start OR e.rule < h.rule))))
), base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM hits WHERE base GROUP BY r
), named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM kept UNION SELECT r, label FROM hits WHERE base) GROUP BY r
), sure AS (
  SELECT r, max(CASE priority {' '.join(f'WHEN {p} THEN {c}' for p, c in CONFIDENCE.items())} END) AS score FROM kept GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN named USING (r) LEFT JOIN sure USING (r)
"""


SQL = _sql(all_rules())
