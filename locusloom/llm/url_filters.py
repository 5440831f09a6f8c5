"""URL lists with dates: every capture is judged by the entries that were active when it was fetched.

A list is a log of dated changes (``entry, day, action``; an action ``remove`` ends what an earlier one set). For each
entry the changes become validity intervals. An entry is a domain (it covers its subdomains), a host or a host with a
path prefix. A capture's URL gives a bounded number of candidate entries (host suffixes and path prefixes); these meet
the intervals in an equi-join on the entry with the fetch day inside the interval (the as-of condition). Each entry
has one active state a day, so a capture gains at most one row per candidate. The most specific match decides; of
equally specific ones ``allow`` wins.

Distinct (host and path, day) pairs are judged once, so a host with a third of all captures is folded before the join.

Cases: a null or hostless URL matches nothing and is allowed; a null day matches nothing; list rows with nulls are
ignored; repeated list rows are one; of changes of one entry on one day the alphabetically last action counts; rows
that repeat an id stay as they are; an empty list allows all; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import read


def host_of(url: str = "url") -> Column:
    """Lower-cased host without user, port and trailing dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(changes: DataFrame) -> DataFrame:
    """``entry, action, from_day, to_day`` (half-open; null: still active) of a log of changes."""
    c = changes.select(F.lower("entry").alias("entry"), "day", "action").where("entry IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
    c = c.groupBy("entry", "day").agg(F.max("action").alias("action"))
    w = Window.partitionBy("entry").orderBy("day")
    return c.select("entry", "action", F.col("day").alias("from_day"), F.lead("day").over(w).alias("to_day")).where("action <> 'remove'")


def candidates(host: str = "host", path: str = "path") -> Column:
    """Entries that would cover a URL, with their specificity: host suffixes of two labels or more by their number of
    labels (of addresses and of hosts of one label, the host alone), then the host with each path prefix (1000 and its
    depth). Their number grows with the labels and the depth of the path."""
    labels, parts = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda p: p != "")
    suffix = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda n: F.struct(F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".").alias("entry"), n.alias("rank")))
    prefix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(F.concat(F.col(host), F.lit("/"), F.lower(F.array_join(F.slice(parts, 1, n), "/"))).alias("entry"), (n + 1000).alias("rank")))
    none = F.array().cast("array<struct<entry:string,rank:int>>")
    whole = F.array(F.struct(F.col(host).alias("entry"), F.size(labels).alias("rank")))
    alone = (F.size(labels) == 1) | F.col(host).rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|^\[")
    return F.concat(F.when(alone, whole).when(F.size(labels) >= 2, suffix).otherwise(none), F.when(F.size(parts) >= 1, prefix).otherwise(none))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (``page_id, url, day``) with ``host``, ``n_active``, ``entry`` (the deciding one) and ``decision``."""
    c = captures.select("page_id", "url", "day").withColumn("host", host_of()).withColumn("path", path_of())
    asked = c.where("host IS NOT NULL AND day IS NOT NULL").select("host", "path", "day").distinct()
    rows = asked.select("host", "path", "day", F.explode(candidates()).alias("c")).select("host", "path", "day", "c.entry", "c.rank")
    met = rows.join(intervals(changes), "entry").where("day >= from_day AND (to_day IS NULL OR day < to_day)")
    best = F.max(F.struct("rank", (F.col("action") == "allow").alias("allow"), "entry", "action"))
    found = met.groupBy("host", "path", "day").agg(F.count(F.lit(1)).alias("n_active"), best.alias("best"))
    found = found.select("host", "path", "day", "n_active", F.col("best.entry").alias("entry"), F.col("best.action").alias("decision"))
    out = c.join(found, ["host", "path", "day"], "left")
    return out.select("page_id", "url", "day", "host", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), "entry", F.coalesce("decision", F.lit("allow")).alias("decision"))


def demo_captures(pages: DataFrame) -> DataFrame:
    """The test tables have no fetch times: a day of 2024's first 360 is made from the page id."""
    return pages.select("page_id", "url", (F.col("page_id") * 7919 % 360).cast("int").alias("day"))


def demo_changes(pages: DataFrame) -> DataFrame:
    """The test tables have no list: one is made from the hosts and first path parts that occur. Each domain is
    blocked for a while, some hosts are allowed again in it, and some sections are blocked."""
    p = pages.withColumn("host", host_of()).where("host IS NOT NULL").withColumn("section", F.element_at(F.split(path_of(), "/"), 2))
    hosts = p.groupBy("host").agg(F.min("page_id").alias("k"))
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    domains = p.withColumn("entry", domain).where("entry <> ''").groupBy("entry").agg(F.min("page_id").alias("k"))
    sections = p.where("section IS NOT NULL AND section <> ''").groupBy(F.concat("host", F.lit("/"), F.lower("section")).alias("entry")).agg(F.min("page_id").alias("k")).where("k % 5 = 0")

    def change(df: DataFrame, entry: str, day: str, action: str) -> DataFrame:
        return df.select(F.col(entry).alias("entry"), F.expr(day).cast("int").alias("day"), F.lit(action).alias("action"))

    log = change(domains, "entry", "k * 37 % 300", "block")
    for df, entry, day, action in (
        (domains, "entry", "k * 37 % 300 + 40", "remove"), (domains.where("k % 2 = 0"), "entry", "k * 37 % 300 + 70", "block"),
        (hosts.where("k % 3 = 0"), "host", "k * 53 % 320", "allow"), (hosts.where("k % 3 = 0"), "host", "k * 53 % 320 + 25", "remove"),
        (sections, "entry", "k * 11 % 200", "block"), (sections, "entry", "k * 11 % 200 + 90", "remove"),
    ):
        log = log.unionByName(change(df, entry, day, action))
    return log


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(demo_captures(pages), demo_changes(pages)).select("page_id", "host", "day", "n_active", "entry", "decision")


OP10_SQL = r"""
WITH p AS (SELECT page_id, (page_id * 7919 % 360)::INT AS day,
    nullif(lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), '\.?(:[0-9]*)?$', '')), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
h AS (SELECT host, min(page_id) AS k FROM p WHERE host IS NOT NULL GROUP BY 1),
dm AS (SELECT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS entry, min(page_id) AS k FROM p WHERE host IS NOT NULL GROUP BY 1 HAVING entry <> ''),
s AS (SELECT host || '/' || lower(split_part(path, '/', 2)) AS entry, min(page_id) AS k FROM p WHERE host IS NOT NULL AND split_part(path, '/', 2) <> '' GROUP BY 1 HAVING k % 5 = 0),
l AS (SELECT entry, k * 37 % 300 AS day, 'block' AS action FROM dm
  UNION ALL SELECT entry, k * 37 % 300 + 40, 'remove' FROM dm
  UNION ALL SELECT entry, k * 37 % 300 + 70, 'block' FROM dm WHERE k % 2 = 0
  UNION ALL SELECT host, k * 53 % 320, 'allow' FROM h WHERE k % 3 = 0
  UNION ALL SELECT host, k * 53 % 320 + 25, 'remove' FROM h WHERE k % 3 = 0
  UNION ALL SELECT entry, k * 11 % 200, 'block' FROM s
  UNION ALL SELECT entry, k * 11 % 200 + 90, 'remove' FROM s),
g AS (SELECT entry, day, max(action) AS action FROM l GROUP BY 1, 2),
state AS (SELECT p.page_id, g.entry, arg_max(g.action, g.day) AS action,
    CASE WHEN contains(g.entry, '/') THEN 1000 + len(string_split(g.entry, '/')) ELSE len(string_split(g.entry, '.')) END AS rank
  FROM p JOIN g ON g.day <= p.day AND (p.host = g.entry OR ends_with(p.host, '.' || g.entry)
    OR (contains(g.entry, '/') AND split_part(g.entry, '/', 1) = p.host AND starts_with(p.host || lower(regexp_replace(path, '/*$', '')) || '/', g.entry || '/')))
  GROUP BY p.page_id, g.entry),
live AS (SELECT * FROM state WHERE action <> 'remove'),
b AS (SELECT page_id, count(*) AS n, arg_max({'entry': entry, 'action': action}, {'r': rank, 'a': action = 'allow', 'e': entry}) AS best FROM live GROUP BY 1)
SELECT p.page_id, p.host, p.day, coalesce(b.n, 0) AS n_active, b.best.entry AS entry, coalesce(b.best.action, 'allow') AS decision
FROM p LEFT JOIN b ON b.page_id = p.page_id
"""
