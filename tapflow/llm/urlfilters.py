"""URL filters as a temporal list join.

Lists change over time: an edit adds an entry to a list or removes it. Edits become validity intervals, from one edit of
an entry up to its next. A capture is judged by the entries that were active when it was fetched. An entry is a
domain (its subdomains included) or a domain with the beginning of a path, which may end within a segment. Of the
active entries that a capture meets the most specific decides, the longest one; of equally long ones a blocking one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.session import scratch_path

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, '' where there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def folded(entry: Column) -> Column:
    """An entry with its domain in lower case."""
    return F.concat(F.lower(F.regexp_extract(entry, "^[^/]*", 0)), F.regexp_extract(entry, "(?s)/.*$", 0))


def stem_of(entry: Column) -> Column:
    """An entry's domain and whole directories; what follows is the beginning of a segment."""
    return F.regexp_extract(entry, "(?s)^[^/]*(?:/.*/|/)?", 0)


def stems_of(url: Column, fewest: int, most: int, depth: int) -> Column:
    """Every stem of an entry that could meet a URL: suffixes of its host, alone and with the directories of its path.

    ``fewest`` and ``most``: labels that the entries' domains have, ``depth``: the most slashes of their stems. No URL has
    more stems than these allow, however long it is.
    """
    parts = F.split(host_of(url), r"\.")
    n = F.size(parts)
    high = F.least(F.lit(most), n)
    suffixes = F.when(high >= fewest, F.transform(F.sequence(F.lit(fewest), high), lambda i: F.array_join(F.slice(parts, n - i + 1, i), "."))).otherwise(F.array().cast("array<string>"))
    # "/a/b" has the directories "/" and "/a/". What exceeds the depth stays in the last piece, which is none.
    steps = F.split(F.regexp_extract(url, PATH, 1), "/", depth + 1)
    paths = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.when(i > 0, "/").otherwise("")))
    every = F.flatten(F.transform(suffixes, lambda s: F.transform(paths, lambda p: F.concat(s, p))))
    return F.when(host_of(url) != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def intervals(edits: DataFrame) -> DataFrame:
    """(list, action, entry, start, until) from edits (list, action, entry, at, added): until is the entry's next edit, null for none.

    Edits are numbered within a month of an entry and months are stitched by their first edit, so an entry with very
    many edits is dealt over many tasks. Of an entry's edits of one moment a removal counts.
    """
    own = ["list", "action", "entry"]
    plain = edits.where(F.col("entry").isNotNull() & F.col("at").isNotNull())
    moments = plain.groupBy(*own, "at").agg(F.min("added").alias("added")).withColumn("month", F.trunc("at", "month"))
    within = moments.withColumn("next", F.lead("at").over(Window.partitionBy(*own, "month").orderBy("at")))
    firsts = moments.groupBy(*own, "month").agg(F.min("at").alias("first"))
    later = firsts.withColumn("later", F.lead("first").over(Window.partitionBy(*own).orderBy("month"))).drop("first")
    joined = within.alias("w").join(later.alias("l"), [F.col(f"w.{c}").eqNullSafe(F.col(f"l.{c}")) for c in [*own, "month"]])
    return joined.where("added").select(*[F.col(f"w.{c}").alias(c) for c in own], F.col("at").alias("start"), F.coalesce("next", "later").alias("until"))


def judge(captures: DataFrame, edits: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """(id, url, fetched_at, verdict, list, entry, n_active), one row per row of ``captures``.

    ``edits``: (list, action 'block' or 'allow', entry, at, added). ``verdict`` is the deciding entry's action, 'none'
    without one; ``n_active`` counts the active entries met. Domains are compared in lower case. A null time, a null URL or one without a host meets nothing. Null
    ids and repeated rows keep their rows; other columns are ignored whatever their names; an empty table on either
    side gives no matches.

    The join is on the entry's domain and whole directories, and on the month; the rest of an entry is compared there. An
    interval stands once in each month that it shares with the captures, so one host with a third of all captures is
    dealt by months, and AQE may split these again. Only as many labels and directories of a URL are looked up as entries have.
    """
    spark = captures.sparkSession
    path = scratch_path(spark, "captures")
    captures.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(at_col).alias("at")).write.parquet(path)
    rows = spark.read.parquet(path)
    span = rows.agg(F.trunc(F.min("at"), "month").alias("low"), F.trunc(F.max("at"), "month").alias("high")).first()
    entries = edits.withColumn("entry", folded(F.col("entry"))).withColumn("stem", stem_of(F.col("entry")))
    n_labels = F.size(F.split(F.regexp_extract("stem", "^[^/]*", 0), r"\."))
    shape = entries.agg(F.min(n_labels).alias("low"), F.max(n_labels).alias("high"), F.max(F.size(F.split("stem", "/")) - 1).alias("depth")).first()
    valid = intervals(entries).withColumn("stem", stem_of(F.col("entry")))
    from_month = F.greatest(F.trunc("start", "month"), F.lit(span["low"]))
    to_month = F.least(F.trunc(F.coalesce("until", F.lit(span["high"]).cast("timestamp_ntz")), "month"), F.lit(span["high"]))
    months = F.when(from_month <= to_month, F.sequence(from_month, to_month, F.expr("interval 1 month")))
    valid = valid.withColumn("month", F.explode(months))
    stems = stems_of(F.col("url"), shape["low"] or 1, shape["high"] or 0, shape["depth"] or 0)
    path_of = F.regexp_extract("url", PATH, 1).alias("path")
    asked = rows.where(F.col("at").isNotNull()).select("row", "at", F.trunc("at", "month").alias("month"), path_of, F.explode(stems).alias("stem"))
    begins = F.startswith(F.col("path"), F.regexp_extract("entry", "(?s)/.*$", 0))
    met = asked.join(valid, ["stem", "month"]).where(begins & (F.col("at") >= F.col("start")) & (F.col("until").isNull() | (F.col("at") < F.col("until"))))
    rank = F.struct(F.length("entry").alias("n"), (F.col("action") == "block").alias("blocks"), F.col("entry"), F.col("list"), F.col("action"))
    decided = met.groupBy("row").agg(F.max(rank).alias("d"), F.count(F.lit(1)).alias("n_active"))
    out = rows.join(decided, "row", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(at_col),
        F.coalesce("d.action", F.lit("none")).alias("verdict"), F.col("d.list").alias("list"), F.col("d.entry").alias("entry"),
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
    )


# The tables have neither fetch times nor lists: both are derived from the pages, so that they grow with them.
START = "2023-01-01 00:00:00"
_MINUTES = 1_051_200


def pages_fetched(pages: DataFrame) -> DataFrame:
    """Pages as captures of two years."""
    minute = (F.col("page_id") * 7919 % _MINUTES).cast("int")
    return pages.select("page_id", "url", (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=minute)).alias("fetched_at"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Edits of two lists for the domains of the pages: which, and when, by a digest of the domain."""
    domain = F.regexp_replace(host_of(F.col("url")), r"^(www|m|blog)\.", "")
    d = pages.select(domain.alias("d")).where("d != ''").distinct().withColumn("h", F.conv(F.substring(F.md5(F.col("d").cast("binary")), 1, 7), 16, 10).cast("int"))
    start = F.lit(START).cast("timestamp_ntz")

    def edit(name: str, action: str, entry: Column, days: Column, added: bool, when: Column) -> DataFrame:
        at = start + F.make_dt_interval(days=days.cast("int"))
        return d.where(when).select(F.lit(name).alias("list"), F.lit(action).alias("action"), entry.alias("entry"), at.alias("at"), F.lit(added).alias("added"))

    h, blocked = F.col("h"), F.col("h") % 3 == 0
    edits = edit("unwanted", "block", F.col("d"), h % 500, True, blocked)
    edits = edits.union(edit("unwanted", "block", F.col("d"), h % 500 + 60, False, blocked & (h % 5 == 0)))
    edits = edits.union(edit("unwanted", "block", F.col("d"), h % 500 + 200, True, blocked & (h % 10 == 0)))
    edits = edits.union(edit("trusted", "allow", F.concat("d", F.lit("/en/")), h % 300, True, h % 4 == 0))
    # Written with capitals, and ending within a segment.
    return edits.union(edit("unwanted", "block", F.concat(F.upper("d"), F.lit("/en/1")), h % 400, True, h % 7 == 0))


def oracle() -> str:
    """Every capture against every interval."""
    return f"""
WITH captures AS (SELECT row_number() OVER () AS row, page_id, url, TIMESTAMP '{START}' + to_minutes(page_id * 7919 % {_MINUTES}) AS fetched_at,
  lower(regexp_extract(url, '{HOST}', 1)) AS host, regexp_extract(url, '{PATH}', 1) AS path FROM pages),
domains AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\\.', '') AS d FROM captures WHERE host != ''),
hashed AS (SELECT d, CAST('0x' || substr(md5(d), 1, 7) AS INTEGER) AS h FROM domains WHERE d != ''),
edits AS (
  SELECT 'unwanted' AS list, 'block' AS action, d AS domain, '' AS prefix, h % 500 AS day, true AS added FROM hashed WHERE h % 3 = 0
  UNION ALL SELECT 'unwanted', 'block', d, '', h % 500 + 60, false FROM hashed WHERE h % 3 = 0 AND h % 5 = 0
  UNION ALL SELECT 'unwanted', 'block', d, '', h % 500 + 200, true FROM hashed WHERE h % 3 = 0 AND h % 10 = 0
  UNION ALL SELECT 'trusted', 'allow', d, '/en/', h % 300, true FROM hashed WHERE h % 4 = 0
  UNION ALL SELECT 'unwanted', 'block', d, '/en/1', h % 400, true FROM hashed WHERE h % 7 = 0),
valid AS (SELECT *, TIMESTAMP '{START}' + to_days(CAST(day AS INTEGER)) AS start,
  lead(TIMESTAMP '{START}' + to_days(CAST(day AS INTEGER))) OVER (PARTITION BY list, domain, prefix ORDER BY day) AS until FROM edits),
met AS (SELECT row, list, action, domain || prefix AS entry FROM captures JOIN valid ON added AND fetched_at >= start AND (until IS NULL OR fetched_at < until)
  AND (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)),
best AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY length(entry) DESC, action = 'block' DESC, entry DESC, list DESC) AS r,
  count(*) OVER (PARTITION BY row) AS n FROM met)
SELECT page_id, url, fetched_at, coalesce(action, 'none') AS verdict, list, entry, coalesce(n, 0) AS n_active
FROM captures LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (row)"""
