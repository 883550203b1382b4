"""URL filters: a dated list joined as of each capture's fetch time.

The list's entries become validity intervals, cut at the borders of fixed time buckets.
A capture looks up its domain suffixes, its host and its path prefixes in the bucket of
its fetch time, and the most specific entry that was active then decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ACTIONS = ("block", "allow", "lift")
BUCKET_DAYS = 32
HOST_LEVEL = 1000  # above any number of labels of a host name
PREFIX_LEVEL = 2000
MOST_LABELS = 127  # fixed value: a host name has at most so many


def host(url: Column) -> Column:
    """The lower-case host of an absolute url without user, port and last dot; null if
    there is none."""
    authority = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    name = F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@", "")), r":[0-9]*$", "")
    return F.nullif(F.rtrim(name, F.lit(".")), F.lit(""))


def path(url: Column) -> Column:
    """The path of an absolute url without its first slash; empty if there is none."""
    return F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (``kind``, ``pattern``, ``action``, ``valid_from``, ``valid_to``) of a list.

    ``entries`` has ``kind`` (domain, host or prefix), ``pattern``, ``action`` (block,
    allow, or lift, which ends what is active) and ``dated``.  An entry holds until the
    next one of its pattern, the last for ever (``valid_to`` null).  Of several entries of
    a pattern on a day the last in the order block, allow, lift counts.  Entries with a
    null, an unknown kind or an unknown action are left out; neighbouring entries of the
    same action are one interval.  Patterns are written as captures are: kind and host in
    lower case, no last dot of the host and no last slash.
    """
    key = ["kind", "pattern"]
    name = F.rtrim(F.lower(F.regexp_extract("pattern", r"^([^/]*)", 1)), F.lit("."))
    rest = F.rtrim(F.regexp_extract("pattern", r"^[^/]*(.*)$", 1), F.lit("/"))
    entries = entries.withColumns({"kind": F.lower("kind"), "pattern": F.when(F.col("pattern").isNotNull(), F.concat(name, rest))})
    order = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    fit = entries.filter(
        F.col("kind").isin("domain", "host", "prefix") & F.col("action").isin(*ACTIONS)
        & F.col("pattern").isNotNull() & F.col("dated").isNotNull()
    )
    # one row per pattern and day, however often the list repeats it
    daily = fit.groupBy(*key, F.col("dated").cast("date").alias("dated")).agg(F.max(order).alias("at"))
    daily = daily.withColumn("action", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("at").cast("int")))
    by_day = Window.partitionBy(*key).orderBy("dated")
    before = F.lag("action").over(by_day)
    changes = daily.filter("action IS NOT NULL").withColumn("_before", before).filter(
        F.col("_before").isNull() | (F.col("_before") != F.col("action"))
    )
    return changes.withColumn("valid_to", F.lead("dated").over(by_day)).filter("action <> 'lift'").select(
        *key, "action", F.col("dated").alias("valid_from"), "valid_to"
    )


def _bucket(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / BUCKET_DAYS)


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url``, ``fetched``, others) plus ``verdict`` (block, allow, or pass
    if nothing active matches), ``kind``, ``pattern`` and ``valid_from`` of the entry.

    A domain entry matches the domain and all below it, a host entry that host alone, a
    prefix entry (``host/segment/segment``) that path and all below it.  Prefix beats
    host, host beats domain, longer beats shorter.  An entry is active from its day on
    and no longer on the day on which it ends.

    Captures with a null or relative url, or a null fetch time, pass.  Hosts of more than
    127 labels match host and prefix entries only.  Repeated rows are judged each; empty
    tables are fine on either side.  Input columns named like an added one are replaced;
    names that start with ``_`` are reserved.
    """
    added = ["verdict", "kind", "pattern", "valid_from"]
    own = [c for c in captures.columns if c not in added]
    intervals = validity(entries)
    # No capture is later than the last fetch, so open intervals end there; a path is cut
    # into no more prefixes than the list asks for.
    last = captures.agg(F.max(F.col("fetched").cast("date"))).first()[0]
    depth = intervals.filter("kind = 'prefix'").agg(F.max(F.size(F.split("pattern", "/")))).first()[0] or 1
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last).cast("date")), F.lit(last).cast("date"))
    spread = intervals.withColumn("_end", end).filter("valid_from <= _end").withColumn(
        "_bucket", F.explode(F.sequence(_bucket(F.col("valid_from")), _bucket(F.col("_end"))))
    )

    # the verdict depends on url and day alone, so copies of a capture are looked up once
    asked = captures.select("url", F.col("fetched").cast("date").alias("_day")).filter(
        "url IS NOT NULL AND _day IS NOT NULL"
    ).distinct()
    named = asked.withColumns({"_host": host(F.col("url")), "_path": path(F.col("url"))}).filter("_host IS NOT NULL")
    named = named.withColumns({"_labels": F.split("_host", r"\."), "_parts": F.split("_path", "/")})
    count = F.size("_labels")
    suffixes = F.when(count <= MOST_LABELS, F.transform(F.sequence(F.lit(1), count), lambda n: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice("_labels", count - n + 1, n), ".").alias("pattern"),
        n.alias("level"),
    ))).otherwise(F.array().cast("array<struct<kind:string,pattern:string,level:int>>"))
    prefixes = F.transform(
        F.filter(
            F.sequence(F.lit(1), F.least(F.size("_parts"), F.lit(max(depth - 1, 1)))),
            lambda n: F.get("_parts", n - 1) != "",
        ),
        lambda n: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat("_host", F.lit("/"), F.array_join(F.slice("_parts", F.lit(1), n), "/")).alias("pattern"),
            (n + PREFIX_LEVEL).alias("level"),
        ),
    )
    exact = F.array(F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern"), F.lit(HOST_LEVEL).alias("level")))
    keys = named.select("url", "_day", _bucket(F.col("_day")).alias("_bucket"), F.explode(F.concat(suffixes, exact, prefixes)).alias("_k"))
    keys = keys.select("url", "_day", "_bucket", "_k.*")
    active = keys.join(spread, ["kind", "pattern", "_bucket"]).filter("valid_from <= _day AND _day <= _end")
    best = active.groupBy("url", "_day").agg(
        F.max_by(F.struct(F.col("action").alias("verdict"), "kind", "pattern", "valid_from"), "level").alias("_best")
    ).withColumnRenamed("url", "_url").withColumnRenamed("_day", "_on")
    joined = captures.select(own).withColumn("_day", F.col("fetched").cast("date")).join(
        best, (F.col("url") == F.col("_url")) & (F.col("_day") == F.col("_on")), "left"
    )
    return joined.select(
        *own, F.coalesce("_best.verdict", F.lit("pass")).alias("verdict"),
        *(F.col(f"_best.{c}").alias(c) for c in ("kind", "pattern", "valid_from")),
    )


def _draw(text: Column, digit: int) -> Column:
    """0 to 65,535 by the text's MD5: four hex digits from ``digit`` on."""
    return F.conv(F.substring(F.md5(text), digit, 4), 16, 10).cast("int")


def derived_list(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts, for want of a given one: every domain of
    two or more labels, host and first path segment is listed, allowed or lifted on days
    that its MD5 draws."""
    at = pages.select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p")).filter("h IS NOT NULL").distinct()
    labels = F.split("h", r"\.")
    domain = F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), "."))
    segment = F.get(F.split("p", "/"), F.lit(0))
    kinds = F.array(
        F.struct(F.lit("domain").alias("kind"), domain.alias("pattern")),
        F.struct(F.lit("host").alias("kind"), F.col("h").alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"), F.when(segment != "", F.concat("h", F.lit("/"), segment)).alias("pattern")),
    )
    patterns = at.select(F.explode(kinds).alias("k")).select("k.*").filter("pattern IS NOT NULL").distinct()
    drawn = patterns.withColumn("id", F.concat_ws(":", "kind", "pattern"))
    events = F.array(*(
        F.struct(
            F.element_at(F.array(*map(F.lit, ACTIONS)), _draw(F.col("id"), start) % 3 + 1).alias("action"),
            F.date_add(F.lit("2024-01-01").cast("date"), _draw(F.col("id"), start + 4) % 365).alias("dated"),
        )
        for start in (1, 9, 17)
    ))
    return drawn.select("kind", "pattern", F.explode(events).alias("e")).select("kind", "pattern", "e.*")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(365)).cast("int"))
    return judge_captures(pages.withColumn("fetched", fetched), derived_list(pages))


OP6_SQL = r"""
WITH page AS (
    SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS DATE) AS fetched,
           nullif(rtrim(regexp_replace(lower(regexp_replace(regexp_extract(
               url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')), ':[0-9]*$', ''), '.'), '') AS host,
           regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1) AS path
    FROM pages),
part AS (SELECT *, string_split(host, '.') AS labels, string_split(path, '/') AS parts FROM page),
pattern AS (
    SELECT DISTINCT kind, pattern FROM (
        SELECT 'domain' AS kind, CASE WHEN len(labels) >= 2 THEN array_to_string(labels[-2:], '.') END AS pattern FROM part
        UNION ALL SELECT 'host', host FROM part
        UNION ALL SELECT 'prefix', CASE WHEN parts[1] <> '' THEN host || '/' || parts[1] END FROM part)
    WHERE pattern IS NOT NULL),
event AS (
    SELECT kind, pattern,
           CAST('0x' || substr(md5(kind || ':' || pattern), s, 4) AS INTEGER) % 3 AS act,
           CAST(DATE '2024-01-01' + CAST('0x' || substr(md5(kind || ':' || pattern), s + 4, 4) AS INTEGER) % 365 AS DATE) AS dated
    FROM pattern, (SELECT unnest([1, 9, 17]) AS s)),
daily AS (SELECT kind, pattern, dated, max(act) AS act FROM event GROUP BY ALL),
changed AS (
    SELECT * FROM (SELECT *, lag(act) OVER (PARTITION BY kind, pattern ORDER BY dated) AS before FROM daily)
    WHERE before IS NULL OR before <> act),
valid AS (
    SELECT * FROM (SELECT kind, pattern, act, dated AS valid_from,
                          lead(dated) OVER (PARTITION BY kind, pattern ORDER BY dated) AS valid_to FROM changed)
    WHERE act <> 2),
lookup AS (
    SELECT page_id, 'domain' AS kind, array_to_string(labels[len(labels) - n + 1:], '.') AS pattern, n AS level
    FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS n FROM part WHERE host IS NOT NULL)
    UNION ALL SELECT page_id, 'host', host, 1000 FROM part WHERE host IS NOT NULL
    UNION ALL SELECT page_id, 'prefix', host || '/' || parts[1], 2001 FROM part WHERE host IS NOT NULL),
best AS (
    SELECT page_id, arg_max(struct_pack(act := act, kind := v.kind, pattern := v.pattern, valid_from := valid_from), level) AS b
    FROM lookup l JOIN page p USING (page_id) JOIN valid v
      ON l.kind = v.kind AND l.pattern = v.pattern AND v.valid_from <= p.fetched
         AND (v.valid_to IS NULL OR p.fetched < v.valid_to)
    GROUP BY page_id)
SELECT page_id, url, fetched, CASE b.act WHEN 0 THEN 'block' WHEN 1 THEN 'allow' ELSE 'pass' END AS verdict,
       b.kind AS kind, b.pattern AS pattern, b.valid_from AS valid_from
FROM page LEFT JOIN best USING (page_id)
"""
