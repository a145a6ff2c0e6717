"""Not-modified revisits of web captures, resolved to the full responses they stand for.

A revisit record says that a server answered "not modified". Its content is that of
the latest earlier full response of the same canonical URL, provided the validators
agree; its headers are those of that response, renewed by the ones that such an
answer is permitted to change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.session import stash

#: Headers that a 304 answer renews (fixed by the HTTP specification).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not name another page.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid")


def canonical_url(url: Column) -> Column:
    """``host/path?query`` with scheme, default port, ``www.``, fragment and tracking parameters gone.

    Hosts are lower-cased, parameters sorted, an empty path is ``/``. Null stays null;
    a URL without ``://`` is taken as host and path.
    """
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_extract(rest, r"(?s)^[^?]*", 0)
    query = F.split(F.regexp_replace(rest, r"(?s)^[^?]*\??", ""), "&")
    named = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    path = F.when(path == "", "/").otherwise(path)
    return F.concat(host, path, F.when(F.size(named) > 0, F.concat(F.lit("?"), F.array_join(named, "&"))).otherwise(""))


def _opaque(etag: Column) -> Column:
    """An entity tag without its weakness mark, as not-modified answers compare them."""
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row for each capture: (record_id, canonical, ts, kind, resolved_id, outcome, headers).

    ``captures`` has record_id (long), url, ts (orderable), kind (``response`` for a full
    response, ``revisit`` for a not-modified answer; other kinds are passed through) and
    headers (map of lower-case names). Other columns are left out, whatever their names.

    ``outcome``: ``full`` for a response, which stands for itself; for a revisit
    ``resolved``, ``no earlier response`` or ``validator mismatch`` (entity tags if both
    have one, else modification dates if both have one; without any common validator the
    response counts as the one meant); ``no url`` for a null URL; ``other`` for other
    kinds. ``resolved_id`` is null unless full or resolved. Headers of an unresolved
    record are its own; null headers are none. At equal times responses come before
    revisits, then smaller record ids first; repeated rows are kept.

    A URL may hold any part of all rows: captures are range-partitioned by URL and time,
    so a hot URL is shared by many tasks. Only the last response of a URL in a partition
    is handed on to the next ones, at most two rows for each partition.
    """
    empty = F.create_map().cast("map<string,string>")
    rows = captures.select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical"),
        "ts",
        "kind",
        F.coalesce("headers", empty).alias("headers"),
    )
    full = (F.col("kind") == "response") & F.col("canonical").isNotNull()
    order = ["ts", "late", "record_id"]
    placed = rows.withColumn("late", F.when(full, 0).otherwise(1)).repartitionByRange("canonical", *order)
    # the partition numbers must stay as they are, so the rows are stored with them
    placed = stash(placed.withColumn("part", F.spark_partition_id()), "warc-captures")

    response = F.when(full, F.struct("ts", "record_id", "headers"))
    here = Window.partitionBy("part", "canonical").orderBy(*order)
    local = placed.withColumn("response", F.last(response, ignorenulls=True).over(here))

    ends = placed.groupBy("part", "canonical").agg(
        F.max_by(F.when(full, F.struct("ts", "record_id", "headers")), F.when(full, F.struct("ts", "record_id"))).alias("own")
    )
    spread = ends.join(ends.groupBy("canonical").count().filter("count > 1").select("canonical"), "canonical")
    past = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select("part", "canonical", F.last("own", ignorenulls=True).over(past).alias("carried"))
    carried = carried.filter("carried IS NOT NULL")  # URLs that cross a boundary between partitions
    found = local.join(F.broadcast(carried), ["part", "canonical"], "left")
    found = found.withColumn("response", F.coalesce("response", "carried"))

    ours, theirs = F.col("headers"), F.col("response.headers")
    tags = [_opaque(F.try_element_at(h, F.lit("etag"))) for h in (ours, theirs)]
    dates = [F.try_element_at(h, F.lit("last-modified")) for h in (ours, theirs)]
    both_tags, both_dates = tags[0].isNotNull() & tags[1].isNotNull(), dates[0].isNotNull() & dates[1].isNotNull()
    valid = F.when(both_tags, tags[0] == tags[1]).when(both_dates, dates[0] == dates[1]).otherwise(F.lit(True))
    revisit = F.col("kind") == "revisit"
    outcome = (
        F.when(F.col("canonical").isNull(), "no url")
        .when(F.col("kind") == "response", "full")
        .when(~F.coalesce(revisit, F.lit(False)), "other")
        .when(F.col("response").isNull(), "no earlier response")
        .when(valid, "resolved")
        .otherwise("validator mismatch")
    )
    renewed = F.map_filter(ours, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(theirs, lambda k, _: ~F.array_contains(F.map_keys(renewed), k))
    done = found.withColumn("outcome", outcome)
    target = F.when(F.col("outcome") == "resolved", F.col("response.record_id")).when(
        F.col("outcome") == "full", F.col("record_id")
    )
    headers = F.when(F.col("outcome") == "resolved", F.map_concat(kept, renewed)).otherwise(ours)
    return done.select("record_id", "canonical", "ts", "kind", target.alias("resolved_id"), "outcome", headers.alias("headers"))


def page_captures(pages: DataFrame) -> DataFrame:
    """A crawl history made of pages: for every page a full response and up to two later or earlier revisits.

    Entity tags come from the content, so a page of the same URL and other content does not agree.
    """
    tag = F.md5(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    base = pages.select(
        F.col("page_id").alias("page_id"),
        "url",
        tag.alias("tag"),
        F.length(F.coalesce("html", F.lit(""))).cast("string").alias("size"),
        (F.col("page_id") * 7919 % 100003).alias("t0"),
    )
    no, weak = F.lit(None).cast("string"), F.concat(F.lit('W/"'), "tag", F.lit('"'))
    strong, other = F.concat(F.lit('"'), "tag", F.lit('"')), F.lit('"changed"')
    page = F.col("page_id")

    def record(step: int, on: Column, kind: str, shift: int, etag: Column, length: Column) -> Column:
        entries = [
            ("content-type", F.lit("text/html")),
            ("content-length", length),
            ("etag", etag),
            ("date", (F.col("t0") + shift).cast("string")),
            ("x-served-by", F.concat(F.lit("cache-"), (page % 5).cast("string"))),
        ]
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries])
        headers = F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))
        return F.struct(
            on.alias("on"),
            (page * 3 + step).alias("record_id"),
            (F.col("t0") + shift).alias("ts"),
            F.lit(kind).alias("kind"),
            headers.alias("headers"),
        )

    records = F.array(
        record(0, F.lit(True), "response", 0, strong, F.col("size")),
        record(1, page % 4 != 0, "revisit", 500, F.when(page % 5 == 0, other).when(page % 3 == 0, no).otherwise(weak), F.lit("0")),
        record(2, page % 3 == 0, "revisit", -300, strong, F.lit("0")),
    )
    return base.select("url", F.explode(records).alias("r")).filter("r.on").select(
        "r.record_id", "url", "r.ts", "r.kind", "r.headers"
    )


def page_captures_sql() -> str:
    """Resolved page captures in SQL: headers as sorted ``name: value`` lines."""
    tracking = ", ".join(f"'{t}'" for t in TRACKING)
    permitted = ", ".join(f"'{p}'" for p in PERMITTED)
    return f"""
WITH base AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS tag, length(coalesce(html, ''))::VARCHAR AS size, page_id * 7919 % 100003 AS t0 FROM pages),
cut AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM base),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\\.', '') AS host,
    regexp_extract(regexp_replace(bare, '^[^/?]*', ''), '^[^?]*', 0, 's') AS path,
    list_sort(list_filter(string_split(regexp_replace(regexp_replace(bare, '^[^/?]*', ''), '^[^?]*\\??', '', 's'), '&'),
      lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ({tracking}))) AS named FROM cut),
named AS (
  SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(named) > 0 THEN '?' || array_to_string(named, '&') ELSE '' END AS canonical FROM parts),
records AS (
  SELECT page_id * 3 AS record_id, canonical, t0 AS ts, 'response' AS kind, '"' || tag || '"' AS etag, size, page_id FROM named
  UNION ALL SELECT page_id * 3 + 1, canonical, t0 + 500, 'revisit',
    CASE WHEN page_id % 5 = 0 THEN '"changed"' WHEN page_id % 3 = 0 THEN NULL ELSE 'W/"' || tag || '"' END, '0', page_id
    FROM named WHERE page_id % 4 <> 0
  UNION ALL SELECT page_id * 3 + 2, canonical, t0 - 300, 'revisit', '"' || tag || '"', '0', page_id FROM named WHERE page_id % 3 = 0),
lines AS (
  SELECT record_id, unnest([('content-type', 'text/html'), ('content-length', size), ('etag', etag), ('date', ts::VARCHAR),
    ('x-served-by', 'cache-' || (page_id % 5))]) AS e FROM records),
headers AS (SELECT record_id, e[1] AS name, e[2] AS value FROM lines WHERE e[2] IS NOT NULL),
paired AS (
  SELECT r.*, f.record_id AS full_id, f.etag AS full_etag,
    row_number() OVER (PARTITION BY r.record_id ORDER BY f.ts DESC, f.record_id DESC) AS place
  FROM records r LEFT JOIN records f ON r.kind = 'revisit' AND f.kind = 'response' AND f.canonical = r.canonical AND f.ts <= r.ts),
judged AS (
  SELECT *, CASE WHEN canonical IS NULL THEN 'no url' WHEN kind = 'response' THEN 'full' WHEN full_id IS NULL THEN 'no earlier response'
    WHEN etag IS NULL OR regexp_replace(etag, '^W/', '') = regexp_replace(full_etag, '^W/', '') THEN 'resolved'
    ELSE 'validator mismatch' END AS outcome FROM paired WHERE place = 1),
shown AS (
  SELECT j.record_id, h.name, h.value FROM judged j JOIN headers h USING (record_id)
    WHERE j.outcome <> 'resolved' OR h.name IN ({permitted})
  UNION ALL SELECT j.record_id, h.name, h.value FROM judged j JOIN headers h ON h.record_id = j.full_id
    WHERE j.outcome = 'resolved' AND NOT EXISTS (
      SELECT 1 FROM headers o WHERE o.record_id = j.record_id AND o.name = h.name AND o.name IN ({permitted})))
SELECT j.record_id, j.canonical, j.ts, j.kind, CASE j.outcome WHEN 'resolved' THEN j.full_id WHEN 'full' THEN j.record_id END AS resolved_id,
  j.outcome, (SELECT string_agg(s.name || ': ' || s.value, chr(10) ORDER BY s.name) FROM shown s WHERE s.record_id = j.record_id) AS headers
FROM judged j"""
