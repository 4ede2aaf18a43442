"""WARC not-modified revisits: as-of join to the latest earlier full response.

Captures have a schema of their own (``CAPTURES``): full responses carry a payload,
revisits (status 304) only headers.

1. URLs get a canonical key (scheme and ``www.`` off, host in lower case, default
   port, fragment and ``utm_`` parameters off, other parameters sorted, no closing
   slash).
2. As-of join without one task per URL: captures are dealt to ranges of (key,
   time); inside a range a window finds the latest earlier response, and what
   precedes the range comes from a table with one row per key and range.  A URL
   with a third of all captures fills many ranges.
3. The response's validators are compared: entity tags (weak comparison), else
   last-modified, else payload digests.
4. A verified revisit takes the stored headers, overwritten by those headers a
   not-modified answer may update (``PERMITTED``).

Only ids, times and keys are sorted; headers join by capture id and payloads
never move (their digest is taken where they are read).

"Earlier" is a smaller time; of responses at one time the larger capture id counts
as later.  Cases: a null url, time or id cannot be matched and is reported as
``no_response``; null headers are empty; names that differ in case are one header
(the first in sorted order counts); repeated response rows count once; repeated
revisit rows are reported as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.llm import store

CAPTURES = "capture_id long, url string, ts timestamp, status int, headers map<string,string>, payload string"

#: Headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Key under which spellings of one address meet."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    pairs = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(pairs, lambda p: (p != "") & ~F.lower(p).startswith("utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def folded_headers(headers: Column) -> Column:
    """Names in lower case; of names equal then, the first in sorted order."""
    pairs = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.array_distinct(F.transform(pairs, lambda e: F.lower(e["key"])))
    value = lambda n: F.filter(pairs, lambda e: F.lower(e["key"]) == n)[0]["value"]
    return F.map_from_arrays(names, F.transform(names, value))


def merged_headers(stored: Column, fresh: Column, permitted=PERMITTED) -> Column:
    """Stored headers, with the permitted ones of the not-modified answer on top."""
    update = F.map_filter(fresh, lambda k, v: k.isin(*permitted) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(update, k)), update)


def as_of(events: DataFrame) -> DataFrame:
    """(key, ts, capture_id, full) -> (capture_id, row, refers_to) of the captures that
    are not full: the latest full capture of the key with a smaller time."""
    n = store.shuffle_partitions(events.sparkSession)
    rank = [F.col("key"), F.col("ts"), F.col("full"), F.col("capture_id")]      # at one time, revisits first
    dealt = store.staged(events.repartitionByRange(n, *rank)
                         .withColumn("part", F.spark_partition_id()), "captures")
    here = Window.partitionBy("part", "key").orderBy("ts", "full", "capture_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = dealt.withColumn("near", F.last(F.when(F.col("full"), F.col("capture_id")), ignorenulls=True).over(here))
    # one row per key and range: the last response of the ranges before
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = (dealt.groupBy("key", "part")
            .agg(F.max(F.when(F.col("full"), F.struct("ts", "capture_id"))).alias("l"))
            .withColumn("carry", F.last("l.capture_id", ignorenulls=True).over(before))
            .where("carry is not null").select(F.col("key").alias("k"), F.col("part").alias("p"), "carry"))
    return (seen.where("not full").join(last, (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")), "left")
            .select("capture_id", "row", F.coalesce("near", "carry").alias("refers_to")))


def resolve_revisits(captures: DataFrame, permitted=PERMITTED) -> DataFrame:
    """One row per revisit: capture_id, key, refers_to, outcome, headers (merged when
    verified, else its own), payload_sha256 of the response it stands for.

    outcome: verified, changed (validators differ), unverified (no common
    validator) or no_response.
    """
    base = captures.select(
        "capture_id", canonical_url(F.col("url")).alias("key"), "ts", "status",
        folded_headers(F.col("headers")).alias("headers"),
        F.sha2(F.coalesce("payload", F.lit("")), 256).alias("sha"), F.col("payload").isNotNull().alias("body"))
    full = (F.col("status") == 200) & F.col("body")
    read = store.staged(base.withColumn("full", F.coalesce(full, F.lit(False)))
                        .where(F.col("full") | (F.col("status") == 304))
                        .withColumn("row", F.monotonically_increasing_id()), "headers")
    usable = "key is not null and ts is not null and capture_id is not null"
    match = as_of(read.where(usable).select("key", "ts", "capture_id", "full", "row")).select("row", "refers_to")
    stored = (read.where("full").where(usable)
              .groupBy(F.col("capture_id").alias("of")).agg(F.min_by(F.struct("headers", "sha"), "row").alias("s"))
              .select(F.bitwise_not("of").alias("of"), F.col("s.headers").alias("stored"), F.col("s.sha").alias("stored_sha")))
    own = read.where("not full").join(match, "row", "left")
    both = own.withColumn("of", F.bitwise_not("refers_to")).join(stored, "of", "left")

    def pair(name):
        return F.col("headers")[name], F.col("stored")[name]

    weak = lambda c: F.regexp_replace(c, r"^W/", "")
    (e1, e2), (m1, m2) = pair("etag"), pair("last-modified")
    digest = F.regexp_replace(F.lower(F.col("headers")["warc-payload-digest"]), "^sha256:", "")
    outcome = (F.when(F.col("stored").isNull(), "no_response")
               .when(e1.isNotNull() & e2.isNotNull(), F.when(weak(e1) == weak(e2), "verified").otherwise("changed"))
               .when(m1.isNotNull() & m2.isNotNull(), F.when(m1 == m2, "verified").otherwise("changed"))
               .when(digest.isNotNull(), F.when(digest == F.col("stored_sha"), "verified").otherwise("changed"))
               .otherwise("unverified"))
    return (both.withColumn("outcome", outcome)
            .select("capture_id", "key", "refers_to", "outcome",
                    F.when(F.col("outcome") == "verified", merged_headers(F.col("stored"), F.col("headers"), permitted))
                    .otherwise(F.col("headers")).alias("headers"),
                    F.when(F.col("outcome") == "verified", F.col("stored_sha")).alias("payload_sha256")))
