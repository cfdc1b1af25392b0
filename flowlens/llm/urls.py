"""URL filters by a temporal list join (DataFrame functions only).

Dated list entries (``add`` or ``remove`` of a pattern) become validity
intervals; every capture is judged by the entries active at its fetch date.

Pattern kinds: ``host`` (that host), ``domain`` (the host or any below it),
``path`` (a host and a path prefix that ends at a slash).  Lists: ``block`` and
``allow``.  Of the active entries that match, the most specific decides
(path, host, domain; then the longer pattern); at a tie ``allow`` wins.

Intervals: per list, kind and pattern the entries of a date count once (at a
date with both, ``remove`` wins), an ``add`` opens at its date and the next
``remove`` closes, exclusive.  Entries without pattern or date are void.

Plan: captures are first reduced to distinct (host, date), so a host with a
third of all captures is a handful of rows when its suffixes meet the list;
paths are looked at only on hosts with path rules.  The joins are equi-joins
on the pattern with the interval as a condition, plain inner joins that skew
handling may split; nothing is broadcast by hint.

Edge cases: a null or unparsable URL has an empty host and matches nothing; a
null date matches nothing; ids are not used, so null or repeated ids and rows
are judged row by row; host names are compared in lower case without port,
user or trailing dots; an empty list blocks nothing; an empty table gives no
rows; other columns pass through and must not start with ``__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

FIRST_DAY = "2024-01-01"
DAYS = 366
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)(?::[0-9]*)?([^?#]*)"


def with_host(df: DataFrame) -> DataFrame:
    """Adds ``__host`` and ``__path``."""
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r"\.+$", "")
    path = F.regexp_extract(url, _URL, 2)
    return df.withColumns({"__host": host, "__path": F.when(path == "", "/").otherwise(path)})


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, pattern, valid_from, valid_to`` (null: still open)."""
    day = (entries.where("pattern is not null and pattern <> '' and at is not null and list is not null")
           .groupBy("list", "kind", "pattern", "at").agg(F.min((F.col("action") == "add")).alias("add")))
    key = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    turn = day.withColumn("was", F.lag("add").over(key)).where("was is null or was <> add")
    return (turn.withColumn("valid_to", F.lead("at").over(key)).where("add")
            .select("list", "kind", "pattern", F.col("at").alias("valid_from"), "valid_to"))


def _rank() -> Column:
    place = F.when(F.col("kind") == "path", 3).when(F.col("kind") == "host", 2).otherwise(1)
    return F.struct(place.alias("place"), F.length("pattern").alias("size"),
                    (F.col("list") == "allow").alias("allow"), "pattern")


def _asof(keys: DataFrame, rules: DataFrame, by: list[str]) -> DataFrame:
    """The deciding entry and the number of active entries for each of ``by``."""
    on = ((F.col("__key") == F.col("pattern")) & (F.col("__kind") == F.col("kind"))
          & (F.col("valid_from") <= F.col("__at")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to"))))
    return (keys.join(rules, on).groupBy(*by)
            .agg(F.max(_rank()).alias("__best"), F.count(F.lit(1)).alias("__n")))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url`` and the date ``fetched``) plus ``host``,
    ``blocked``, ``entry`` (the deciding pattern) and ``n_active``."""
    rules = intervals(entries)
    own = captures.columns
    caps = with_host(captures).withColumn("__at", F.col("fetched"))
    hosts = caps.where("__host <> '' and __at is not null").select("__host", "__at").distinct()
    labels = F.split("__host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("k"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("v")))
    keys = hosts.withColumn("__s", F.explode(F.concat(
        suffixes, F.array(F.struct(F.lit("host").alias("k"), F.col("__host").alias("v"))))))
    by_host = _asof(keys.select("__host", "__at", F.col("__s.k").alias("__kind"), F.col("__s.v").alias("__key")),
                    rules.where("kind <> 'path'"), ["__host", "__at"])
    path_rules = rules.where("kind = 'path'")
    path_hosts = path_rules.select(F.substring_index("pattern", "/", 1).alias("__host")).distinct()
    paths = (caps.where("__host <> '' and __at is not null").select("__host", "__path", "__at").distinct()
             .join(path_hosts, "__host", "left_semi"))
    parts = F.split("__path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                           lambda i: F.concat("__host", F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    keyed = paths.where("contains(__path, '/')").select("__host", "__path", "__at", F.lit("path").alias("__kind"),
                                                         F.explode(prefixes).alias("__key"))
    by_path = _asof(keyed, path_rules, ["__host", "__path", "__at"]).withColumnsRenamed(
        {"__best": "__pbest", "__n": "__pn"})
    out = (caps.join(by_host, ["__host", "__at"], "left").join(by_path, ["__host", "__path", "__at"], "left"))
    best = F.greatest("__best", "__pbest")
    return out.select(*[f"`{c}`" for c in own], F.col("__host").alias("host"),
                      F.coalesce(~best["allow"], F.lit(False)).alias("blocked"), best["pattern"].alias("entry"),
                      (F.coalesce("__n", F.lit(0)) + F.coalesce("__pn", F.lit(0))).alias("n_active"))


def _number(c: str) -> Column:
    return F.conv(F.substring(F.md5(F.col(c).cast("binary")), 1, 6), 16, 10).cast("int")


def dated_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and parent domains of the pages: which
    patterns are listed and when follows from a digest of the name."""
    hosts = with_host(pages).select("__host").where("__host <> ''").distinct().withColumn("k", _number("__host"))
    start = F.to_date(F.lit(FIRST_DAY))

    def rows(df, cond, lst, kind, pattern, action, day):
        return df.where(cond).select(F.lit(lst).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"),
                                     F.lit(action).alias("action"), F.date_add(start, day).alias("at"))

    k = F.col("k")
    h = F.col("__host")
    parents = (hosts.select(F.regexp_replace("__host", r"^[^.]*\.", "").alias("__p")).where("contains(__p, '.')")
               .distinct().withColumn("k", _number("__p")))
    parts = [rows(hosts, k % 5 == 0, "block", "host", h, "add", k % 120),
             rows(hosts, k % 5 == 0, "block", "host", h, "remove", 150 + k % 100),
             rows(hosts, k % 10 == 0, "block", "host", h, "add", F.lit(300)),
             rows(hosts, k % 7 == 0, "allow", "host", h, "add", 100 + k % 50),
             rows(hosts, k % 4 == 1, "block", "path", F.concat(h, F.lit("/de/")), "add", F.lit(30)),
             rows(hosts, k % 4 == 1, "block", "path", F.concat(h, F.lit("/de/")), "remove", F.lit(330)),
             rows(hosts, h.contains("adult"), "block", "host", h, "add", F.lit(0)),
             rows(parents, k % 3 == 0, "block", "domain", F.col("__p"), "add", k % 200)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date: the first day plus the id modulo the days."""
    day = F.pmod("page_id", F.lit(DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.to_date(F.lit(FIRST_DAY)), day).alias("fetched"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge(captures(pages), dated_entries(pages))
    return out.withColumn("fetched", F.col("fetched").cast("string"))


SQL = rf"""
WITH cap AS (SELECT row_number() OVER () AS rid, page_id, url,
    CAST(DATE '{FIRST_DAY}' + CAST(((page_id % {DAYS}) + {DAYS}) % {DAYS} AS INT) AS DATE) AS fetched,
    regexp_replace(lower(regexp_extract(coalesce(url, ''), '{_URL}', 1)), '\.+$', '') AS host,
    CASE WHEN regexp_extract(coalesce(url, ''), '{_URL}', 2) = '' THEN '/'
         ELSE regexp_extract(coalesce(url, ''), '{_URL}', 2) END AS path FROM pages),
h AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::INT AS k FROM (SELECT DISTINCT host FROM cap WHERE host <> '')),
p AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::INT AS k FROM
    (SELECT DISTINCT regexp_replace(host, '^[^.]*\.', '') AS host FROM h) WHERE contains(host, '.')),
e AS (SELECT 'block' AS list, 'host' AS kind, host AS pattern, true AS a, k % 120 AS d FROM h WHERE k % 5 = 0
  UNION ALL SELECT 'block', 'host', host, false, 150 + k % 100 FROM h WHERE k % 5 = 0
  UNION ALL SELECT 'block', 'host', host, true, 300 FROM h WHERE k % 10 = 0
  UNION ALL SELECT 'allow', 'host', host, true, 100 + k % 50 FROM h WHERE k % 7 = 0
  UNION ALL SELECT 'block', 'path', host || '/de/', true, 30 FROM h WHERE k % 4 = 1
  UNION ALL SELECT 'block', 'path', host || '/de/', false, 330 FROM h WHERE k % 4 = 1
  UNION ALL SELECT 'block', 'host', host, true, 0 FROM h WHERE contains(host, 'adult')
  UNION ALL SELECT 'block', 'domain', host, true, k % 200 FROM p WHERE k % 3 = 0),
day AS (SELECT list, kind, pattern, d, bool_and(a) AS a FROM e GROUP BY ALL),
-- the state at a date is that of the latest entry at or before it
st AS (SELECT cap.rid, day.list, day.kind, day.pattern, arg_max(day.a, day.d) AS a FROM cap JOIN day
    ON DATE '{FIRST_DAY}' + day.d::INT <= cap.fetched AND (
      (kind = 'host' AND pattern = host) OR
      (kind = 'domain' AND (pattern = host OR ends_with(host, '.' || pattern))) OR
      (kind = 'path' AND starts_with(host || path, pattern))) WHERE host <> '' GROUP BY ALL),
act AS (SELECT rid, count(*) AS n, arg_max({{'l': list, 'p': pattern}}, {{'a': CASE kind WHEN 'path' THEN 3 WHEN 'host' THEN 2
    ELSE 1 END, 'b': length(pattern), 'c': list = 'allow', 'd': pattern}}) AS best FROM st WHERE a GROUP BY rid)
SELECT page_id, url, CAST(fetched AS VARCHAR) AS fetched, host, coalesce(best.l = 'block', false) AS blocked,
    best.p AS entry, coalesce(n, 0)::BIGINT AS n_active
FROM cap LEFT JOIN act USING (rid)
"""
