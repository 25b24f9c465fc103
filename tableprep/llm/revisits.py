"""Web archive records: not-modified revisits resolved to the full response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 64
#: Query parameters that do not change what a URL names.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"
#: Fields that describe the stored payload or one connection; a not-modified answer may not change them.
KEPT_FIELDS = (
    "content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding",
    "connection", "keep-alive", "proxy-connection", "te", "trailer", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in small letters without ``www.`` and default port, path without closing slash, query without tracking
    parameters and sorted; scheme and fragment are dropped. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    pairs = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&", -1)
    kept = F.array_sort(F.filter(pairs, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    query = F.array_join(kept, "&")
    return F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def _same(left: Column, right: Column) -> Column:
    """Null where a side has none."""
    return F.when(left.isNotNull() & right.isNotNull(), left == right)


def as_of_responses(records: DataFrame) -> DataFrame:
    """For each revisit of ``records`` (``record_id``, ``kind``, ``key``, ``ts``, ``full``), ``source``: the record_id
    of the latest full response of its key at a strictly earlier time, the larger id among equals; else null.

    Time is cut at ``BUCKETS`` quantiles, so that a key with very many records is spread: windows run within a key and
    bucket, and what earlier buckets ended with is carried over by one row each."""
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = records.agg(F.percentile_approx("ts", F.lit(shares), F.lit(2000)).alias("cuts")).first()["cuts"] or []
    edges = F.array(*[F.lit(cut) for cut in sorted(set(cuts))]).cast("array<bigint>")
    place = records.withColumn("bucket", F.size(F.filter(edges, lambda e: e <= F.col("ts"))))
    full = F.when(F.col("full"), F.struct("ts", "record_id"))
    earlier = Window.partitionBy("key", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = place.withColumn("near", F.max(full).over(earlier)).where("kind = 'revisit'")
    ends = place.where("full").groupBy("key", "bucket").agg(F.max(F.struct("ts", "record_id")).alias("last"))
    slots = near.select("key", "bucket").distinct().join(ends, ["key", "bucket"], "full")
    carried = slots.withColumn("carried", F.max("last").over(
        Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("last")
    return near.join(carried, ["key", "bucket"]).withColumn(
        "source", F.coalesce(F.col("near"), F.col("carried"))["record_id"]).select("record_id", "source")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``record_id``, ``source`` (the response it stands for), ``outcome``, ``headers`` and ``payload`` for each revisit.

    ``records`` has record_id, kind (``response`` or ``revisit``), url, ts (a bigint), status, etag, last_modified,
    digest, headers (a map of names in small letters) and payload; other columns are ignored. A full response is one of
    status 200 with a payload. Entity tags are compared weakly. ``outcome`` is ``resolved`` (a validator agrees and none
    differs), ``unchecked`` (no validator on both sides), ``conflict`` (one differs) or ``missing`` (no earlier full
    response, or no URL or time). Only the first two get a payload, and headers: those stored, with fields of the
    revisit over them except ``KEPT_FIELDS``. Record ids are unique; a null map is empty; no rows give no rows."""
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()
    light = records.select(
        "record_id", "kind", "ts", F.coalesce(full, F.lit(False)).alias("full"), canonical_url(F.col("url")).alias("key"))
    found = as_of_responses(light.where(F.col("key").isNotNull() & F.col("ts").isNotNull()))
    stored_side = records.where(full).select(
        F.col("record_id").alias("source"), F.col("etag").alias("s_etag"), F.col("last_modified").alias("s_modified"),
        F.col("digest").alias("s_digest"), F.col("headers").alias("s_headers"), F.col("payload").alias("s_payload"))
    revisit = records.where("kind = 'revisit'").select("record_id", "etag", "last_modified", "digest", "headers")
    both = revisit.join(found, "record_id", "left").join(stored_side, "source", "left")
    tag = lambda c: F.regexp_replace(c, r"^W/", "")
    checks = F.array(
        _same(tag(F.col("etag")), tag(F.col("s_etag"))), _same(F.col("last_modified"), F.col("s_modified")),
        _same(F.col("digest"), F.col("s_digest")))
    outcome = (
        F.when(F.col("source").isNull(), "missing").when(F.exists(checks, lambda c: ~F.coalesce(c, F.lit(True))), "conflict")
        .when(F.exists(checks, lambda c: F.coalesce(c, F.lit(False))), "resolved").otherwise("unchecked"))
    empty = F.create_map().cast("map<string,string>")
    new = F.map_filter(F.coalesce("headers", empty), lambda k, _: ~k.isin(*KEPT_FIELDS))
    old = F.map_filter(F.coalesce("s_headers", empty), lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
    good = F.col("outcome").isin("resolved", "unchecked")
    return both.withColumn("outcome", outcome).select(
        "record_id", "source", "outcome", F.when(good, F.map_concat(old, new)).alias("headers"),
        F.when(good, F.col("s_payload")).alias("payload"))


def header_block(headers: str) -> Column:
    """``name: value`` lines in order of names."""
    return F.array_join(F.transform(
        F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
