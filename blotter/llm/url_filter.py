"""URL filters against dated lists, in DataFrame expressions only.

A list is a feed of dated entries: from ``day`` on, ``pattern`` is on the list
(``action`` add) or off it (remove). The next entry of the same pattern ends the
validity interval in which the former holds. A capture is evaluated as of its fetch day:
it is blocked when an interval of its host or of a parent domain holds that day;
the most specific pattern decides, so an ``allow`` entry of a host wins over a
``block`` entry of its domain.

The join is an as-of lookup: a pattern's dated entries and the captures that ask for it are sorted
together by day, and a capture takes the last entry before it. A capture asks once for each parent
domain (of no more labels than the list's deepest pattern has), under a salt, so a host with a third of all
captures is spread over ``SALTS_PER_PARTITION`` times the shuffle partitions. An entry is one row under each salt under which
its pattern is asked for, however long it holds; patterns that nobody asks for go at once, and so do the captures'
domains that are not listed.

Several entries of a pattern on one day: remove loses to add, block to allow. Entries
with NULLs are ignored. A capture without a host or fetch day is kept, with NULL pattern.
Repeated captures get their result each; an empty list keeps all, and an empty
table of captures gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotter.llm.common import pick, settle, shuffle_partitions, table

SALTS_PER_PARTITION = 2
FIRST_DAY = "2024-01-01"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def timeline(entries: DataFrame) -> DataFrame:
    """pattern, day, verdict (NULL: off the list) from that day on, of entries
    (pattern, verdict block or allow, action add or remove, day)."""
    whole = entries.dropna(subset=["pattern", "verdict", "action", "day"])
    return whole.groupBy("pattern", "day").agg(
        F.min(F.when(F.col("action") == "add", F.col("verdict"))).alias("verdict"))  # allow < block


def list_side(asked: DataFrame, dated: DataFrame) -> DataFrame:
    """pattern, salt, day, verdict: the dated entries under each salt under which ``asked`` has their pattern."""
    # a hot pattern is one row per task and salt here
    return asked.select("pattern", "salt").distinct().join(dated, "pattern")


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                day_col: str = "fetched") -> DataFrame:
    """page_id, url, fetched, blocked, pattern (that decided) and since (its interval's start)."""
    rows = settle(pick(captures, page_id=id_col, url=url_col, fetched=day_col).select(
        "*", host_of(F.col("url")).alias("host"), F.monotonically_increasing_id().alias("row")))
    dated = settle(timeline(entries))
    # more labels than any pattern has meet none
    deepest = dated.agg(F.max(F.size(F.split("pattern", r"\.")))).first()[0] or 1
    labels = F.slice(F.reverse(F.split("host", r"\.")), 1, deepest)
    parents = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda n: F.array_join(F.reverse(F.slice("labels", F.lit(1), n)), "."))
    salts = SALTS_PER_PARTITION * shuffle_partitions(rows.sparkSession)
    asked = (rows.filter(F.col("host").isNotNull() & F.col("fetched").isNotNull()).withColumn("labels", labels)
             .select("row", "fetched", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), F.explode(parents).alias("pattern")))
    side = settle(list_side(asked, dated))
    probes = asked.join(side.select("pattern", "salt").distinct(), ["pattern", "salt"], "left_semi")
    entry = F.struct("verdict", F.col("day").alias("start"))
    events = (side.select("pattern", "salt", "day", F.lit(None).cast("long").alias("row"), entry.alias("entry"))
              .unionByName(probes.select("pattern", "salt", F.col("fetched").alias("day"), "row", F.lit(None).cast(side.select(entry.alias("e")).schema["e"].dataType).alias("entry"))))
    # of one day, the entry comes before the captures
    so_far = Window.partitionBy("pattern", "salt").orderBy("day", F.asc_nulls_first("row")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (events.withColumn("entry", F.last("entry", ignorenulls=True).over(so_far))
             .filter(F.col("row").isNotNull() & F.col("entry.verdict").isNotNull())
             .groupBy("row").agg(F.max_by(F.struct("pattern", "entry.verdict", "entry.start"), F.length("pattern")).alias("hit")))
    return (rows.join(found, "row", "left")
            .select("page_id", "url", "fetched", (F.col("hit.verdict") == "block").eqNullSafe(True).alias("blocked"),
                    F.col("hit.pattern").alias("pattern"), F.col("hit.start").alias("since")))


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages with a fetch day: the table has none, so the id gives one within a year."""
    return pick(pages, page_id="page_id", url="url").withColumn(
        "fetched", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int")))


def list_feed(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages' own hosts: hosts of names that sell or
    farm links are blocked in one or two spells; of other hosts with an even number of pages
    the parent domain is blocked for a while, and the host itself is allowed later on."""
    day = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))
    hosts = (pages.select(host_of(F.col("url")).alias("host"), "page_id").filter(F.col("host").isNotNull())
             .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("m"))
             .withColumn("m", F.coalesce("m", F.lit(0))))
    begin = F.pmod(F.col("m") * 53, F.lit(200))
    bad = F.col("host").rlike("spam|pills|bets|adult")
    entry = lambda pattern, verdict, action, at: F.struct(pattern.alias("pattern"), F.lit(verdict).alias("verdict"),
                                                          F.lit(action).alias("action"), day(at).alias("day"))
    host, parent = F.col("host"), F.regexp_replace("host", r"^[^.]*\.", "")
    listed = F.when(bad, F.array(entry(host, "block", "add", begin), entry(host, "block", "remove", begin + 60 + F.col("n") % 40),
                                 entry(host, "block", "add", begin + 120)))
    other = F.when(~bad & (F.col("n") % 2 == 0) & (F.size(F.split("host", r"\.")) > 3),
                   F.array(entry(parent, "block", "add", begin), entry(host, "allow", "add", begin + 30),
                           entry(parent, "block", "remove", begin + 90)))
    return hosts.select(F.explode(F.coalesce(listed, other, F.array())).alias("e")).select("e.*")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(captures_of(pages), list_feed(pages))


SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched,
         nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host
  FROM pages
), h AS (
  SELECT host, count(*) AS n, min(page_id) * 53 % 200 AS b, regexp_matches(host, 'spam|pills|bets|adult') AS bad,
         regexp_replace(host, '^[^.]*\.', '') AS parent
  FROM p WHERE host IS NOT NULL GROUP BY host
), other AS (
  SELECT * FROM h WHERE NOT bad AND n % 2 = 0 AND len(string_split(host, '.')) > 3
), feed AS (
  SELECT host AS pattern, 'block' AS verdict, 'add' AS action, b AS d FROM h WHERE bad
  UNION ALL SELECT host, 'block', 'remove', b + 60 + n % 40 FROM h WHERE bad
  UNION ALL SELECT host, 'block', 'add', b + 120 FROM h WHERE bad
  UNION ALL SELECT parent, 'block', 'add', b FROM other
  UNION ALL SELECT host, 'allow', 'add', b + 30 FROM other
  UNION ALL SELECT parent, 'block', 'remove', b + 90 FROM other
), daily AS (
  SELECT pattern, DATE '2024-01-01' + CAST(d AS INTEGER) AS start, min(CASE WHEN action = 'add' THEN verdict END) AS verdict
  FROM feed GROUP BY 1, 2
), spans AS (
  SELECT *, lead(start) OVER (PARTITION BY pattern ORDER BY start) AS stop FROM daily
), hits AS (
  SELECT r, s.pattern, s.verdict, s.start, row_number() OVER (PARTITION BY r ORDER BY length(s.pattern) DESC) AS k
  FROM p JOIN spans s ON (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern))
   AND s.start <= p.fetched AND (s.stop IS NULL OR p.fetched < s.stop) AND s.verdict IS NOT NULL
)
SELECT page_id, url, fetched, coalesce(verdict = 'block', false) AS blocked, pattern, start AS since
FROM p LEFT JOIN hits ON p.r = hits.r AND hits.k = 1
"""
