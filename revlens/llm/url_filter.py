"""URL filters: temporal list join.

A list's dated entries (add or remove a domain, a host or a URL prefix)
become validity intervals; every capture is evaluated against the entries
that were active when it was fetched.

* A capture's URL gives its candidate keys: the host itself, each of its
  domain suffixes, and each directory prefix of host and path.
* Entries of one key are put in order of time; a run of equal states is one
  state, and an added state is valid from its date until the next removal.
* The as-of join is an equality join on (kind, key) with the fetch time in
  the interval.  A host that holds a third of all captures is a skewed join
  key, which adaptive execution splits; nothing is broadcast unless Spark
  itself finds it small.

Defined results: a null or unparsable URL and a null fetch time match no
entry; entries with a null in any column are no entries; of entries for one
key at one time, a removal wins; repeated captures are evaluated once and
counted in ``n_rows``; an empty list leaves every capture unlisted; an
empty capture table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(F.length(host) > 0, host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+([^?#]*)", 1)


def candidate_keys(url: Column) -> Column:
    """Array of (kind, key) under which a list can name this URL."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: F.length(p) > 0)
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i > 0), lambda i: F.struct(
        F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("key")))
    exact = F.array(F.struct(F.lit("host").alias("kind"), host.alias("key")))
    return F.when(host.isNotNull(), F.concat(exact, suffixes, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """``entries(kind, key, action add/remove, at)`` as (kind, key, valid_from, valid_to)."""
    e = entries.select("kind", "key", "action", "at").dropna()
    at_once = e.groupBy("kind", "key", "at").agg(F.max("action").alias("action"))  # 'remove' > 'add'
    order = Window.partitionBy("kind", "key").orderBy("at")
    turns = (at_once.withColumn("before", F.coalesce(F.lag("action").over(order), F.lit("remove")))
             .where(F.col("action") != F.col("before")))
    return (turns.withColumn("valid_to", F.lead("at").over(order)).where(F.col("action") == "add")
            .select("kind", "key", F.col("at").alias("valid_from"), "valid_to"))


def as_of(captures: DataFrame, entries: DataFrame, id_column: str = "page_id", url_column: str = "url",
          time_column: str = "fetched_at") -> DataFrame:
    """Evaluate every capture at its fetch time.

    Returns id, url, time, n_rows, listed (boolean), n_active, and the
    deciding entry: the active one with the longest key (kind, listed_key,
    listed_since)."""
    c = captures.select(captures[id_column].alias("id"), captures[url_column].alias("url"),
                        captures[time_column].alias("t"))
    c = c.groupBy("id", "url", "t").agg(F.count("*").alias("n_rows"))
    keys = c.withColumn("k", F.explode_outer(candidate_keys(F.col("url")))).select("id", "url", "t", "n_rows", "k.kind", "k.key")
    spans = intervals(entries).withColumnsRenamed({"kind": "e_kind", "key": "e_key"})
    hit = ((F.col("kind") == F.col("e_kind")) & (F.col("key") == F.col("e_key")) & (F.col("t") >= F.col("valid_from"))
           & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to"))))
    best = F.struct(F.length("e_key").alias("len"), "e_kind", "e_key", "valid_from")
    return (keys.join(spans, hit, "left").groupBy("id", "url", "t", "n_rows")
            .agg(F.count("e_key").alias("n_active"), F.max(F.when(F.col("e_key").isNotNull(), best)).alias("best"))
            .select(F.col("id").alias(id_column), F.col("url").alias(url_column), F.col("t").alias(time_column), "n_rows",
                    (F.col("n_active") > 0).alias("listed"), "n_active", F.col("best.e_kind").alias("listed_kind"),
                    F.col("best.e_key").alias("listed_key"), F.col("best.valid_from").alias("listed_since")))


# The query's list history, which the tables do not hold: fetch days and dated
# entries follow from md5 digits of the pages' own ids, hosts and prefixes.

def _digits(text: Column, salt: str, n: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 7), 16, 10).cast("long") % n


def _day(n: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))


def page_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _day(_digits(F.col("page_id").cast("string"), "fetch", 366)).alias("fetched_at"))


def page_list(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts, parent domains and first directories of ``pages``."""
    keys = (pages.select(F.explode(candidate_keys(F.col("url"))).alias("k")).select("k.kind", "k.key").distinct()
            .where((F.col("kind") != "domain") | (F.size(F.split("key", r"\.")) == 3))
            .where((F.col("kind") != "prefix") | (F.size(F.split("key", "/")) == 2)))
    name = F.concat_ws("|", "kind", "key")
    start = _digits(name, "add", 300)
    off = start + 20 + _digits(name, "remove", 100)
    again = off + 10 + _digits(name, "again", 60)
    one = lambda action, day: F.struct(F.lit(action).alias("action"), _day(day).alias("at"))
    events = F.when(_digits(name, "fate", 4) == 0, F.array(one("add", start))).when(
        _digits(name, "fate", 4) == 1, F.array(one("add", start), one("remove", off))).when(
        _digits(name, "fate", 4) == 2, F.array(one("add", start), one("add", start + 5), one("remove", off), one("add", again)))
    return keys.withColumn("e", F.explode(events)).select("kind", "key", "e.action", "e.at")


SQL = r"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(('0x' || substr(md5('fetch' || CAST(page_id AS VARCHAR)), 1, 7))::BIGINT % 366 AS INTEGER) AS fetched_at,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+([^?#]*)', 1), '/'), lambda p: length(p) > 0) AS parts
  FROM pages),
keys AS (
  SELECT page_id, url, fetched_at, 'host' AS kind, host AS key FROM cap WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, url, fetched_at, 'domain', array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
  FROM cap, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i) WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, url, fetched_at, 'prefix', host || '/' || array_to_string(list_slice(parts, 1, i), '/')
  FROM cap, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) WHERE host IS NOT NULL),
named AS (
  SELECT DISTINCT kind, key, kind || '|' || key AS name FROM keys
  WHERE (kind <> 'domain' OR len(string_split(key, '.')) = 3) AND (kind <> 'prefix' OR len(string_split(key, '/')) = 2)),
days AS (
  SELECT kind, key, ('0x' || substr(md5('fate' || name), 1, 7))::BIGINT % 4 AS fate,
         ('0x' || substr(md5('add' || name), 1, 7))::BIGINT % 300 AS a,
         ('0x' || substr(md5('remove' || name), 1, 7))::BIGINT % 100 + 20 AS r,
         ('0x' || substr(md5('again' || name), 1, 7))::BIGINT % 60 + 10 AS g FROM named),
spans AS (
  SELECT kind, key, DATE '2024-01-01' + CAST(a AS INTEGER) AS f, CASE WHEN fate > 0 THEN DATE '2024-01-01' + CAST(a + r AS INTEGER) END AS t
  FROM days WHERE fate < 3
  UNION ALL
  SELECT kind, key, DATE '2024-01-01' + CAST(a + r + g AS INTEGER), NULL FROM days WHERE fate = 2),
hits AS (
  SELECT k.page_id, k.url, k.fetched_at, s.kind, s.key, s.f,
         row_number() OVER (PARTITION BY k.page_id, k.url, k.fetched_at ORDER BY length(s.key) DESC, s.kind DESC, s.key DESC, s.f DESC) AS rn,
         count(*) OVER (PARTITION BY k.page_id, k.url, k.fetched_at) AS n
  FROM keys k JOIN spans s ON k.kind = s.kind AND k.key = s.key AND k.fetched_at >= s.f AND (s.t IS NULL OR k.fetched_at < s.t))
SELECT c.page_id, c.url, c.fetched_at, c.n_rows, h.n IS NOT NULL AS listed, coalesce(h.n, 0) AS n_active,
       h.kind AS listed_kind, h.key AS listed_key, h.f AS listed_since
FROM (SELECT page_id, url, fetched_at, count(*) AS n_rows FROM cap GROUP BY ALL) c
LEFT JOIN hits h ON h.rn = 1 AND h.page_id = c.page_id AND h.url = c.url AND h.fetched_at = c.fetched_at
"""
