"""Not-modified revisits of a web archive, resolved to the response that they confirm.

A 304 record ("server not modified" revisit) says that an earlier response is still
right. It is resolved to the latest full response (status 200) of the same canonical
URL that was captured strictly earlier; the two records' validators must agree (RFC
9110: entity tags by weak comparison; without a pair of tags, equal Last-Modified),
and the stored headers are updated by those the 304 may change (RFC 9111: not the
connection's own fields, nor those its Connection field names, nor the fields that
describe the stored body).

On Spark: an as-of join by window functions. Time is cut at ``TIME_RANGES`` quantiles,
computed once and put in the plan as literals; a window runs over one URL and one
range, and a second one carries the last response over a URL's ranges, at most
``TIME_RANGES`` rows. A URL that holds a third of all records is thereby many
windows. Payloads never travel: a resolved row names its response, and
``attach_payload`` joins the body where it is wanted.

Revisits of another sort (a status other than 304, or, where ``profile_col`` names the
record's WARC profile, one that is not server-not-modified: identical payload digests)
confirm nothing by validators and are only named as such.

Defined results (column ``resolution``): "resolved"; "other_profile"; "no_url" (null URL, or one
without scheme and host), "no_time" (null capture time), "no_response" (nothing
earlier), "etag_mismatch", "date_mismatch", "no_validator" (no pair to compare).
Only resolved rows have merged headers. Responses captured at the same instant are
ordered by record id, the larger one counting as later; repeated rows are resolved
each. Null header maps are empty, null and empty header values are dropped, names are
lower-cased and repeated names joined by ", " in the order of their values. Extra
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME_RANGES = 256

#: Fields of the connection (RFC 9110, 7.6.1) and of the stored body (RFC 9111, 3.2), which a 304 does not change.
KEPT_FIELDS = ["connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization",
               "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade", "content-encoding", "content-length",
               "content-range", "content-type"]
#: Query parameters that name a visit, not a page.
TRACKING = "^(utm_[^=]*|gclid|fbclid|msclkid|sessionid|phpsessid|jsessionid|sid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """host + path + sorted query: scheme, "www.", user, the scheme's own port, fragment, tracking and a trailing slash dropped.

    A host may be a bracketed IPv6 address.
    """
    u = F.trim(url)
    pattern = (r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:\[\]]+)(?::([0-9]*))?([^?#]*)"
               r"(?:\?([^#]*))?(?:#.*)?$")
    part = lambda i: F.regexp_extract(u, pattern, i)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), r"\.$", ""), r"^www\.", "")
    usual = F.when(F.lower(part(1)) == "http", "80").when(F.lower(part(1)) == "https", "443").otherwise("")
    port = F.when((part(3) == "") | (part(3) == usual), "").otherwise(F.concat(F.lit(":"), part(3)))
    path = F.regexp_replace(part(4), "/+$", "")
    params = F.array_sort(F.filter(F.split(part(5), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(part(2) != "", F.concat(host, port, F.when(path == "", "/").otherwise(path), query))


def header_list(headers: Column) -> Column:
    """Sorted (name, value) pairs of a header map: lower-case names, each once."""
    entries = F.filter(F.coalesce(F.map_entries(headers), F.expr("array()").cast("array<struct<key:string,value:string>>")),
                       lambda e: F.trim(e["value"]) != "")
    low = F.transform(entries, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), F.trim(e["value"]).alias("value")))
    names = F.array_sort(F.array_distinct(F.transform(low, lambda e: e["name"])))
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.array_join(F.array_sort(F.transform(
        F.filter(low, lambda e: e["name"] == n), lambda e: e["value"])), ", ").alias("value")))


def header(pairs: Column, name: str) -> Column:
    """A header's value in a list of pairs; null if absent."""
    return F.get(F.transform(F.filter(pairs, lambda e: e["name"] == name), lambda e: e["value"]), F.lit(0))


def merge_headers(stored: Column, update: Column) -> Column:
    """The stored pairs updated by the permitted ones of ``update``, sorted by name."""
    hop = F.coalesce(F.transform(F.split(F.lower(header(update, "connection")), ","), lambda x: F.trim(x)), F.expr("array()").cast("array<string>"))
    may = F.filter(update, lambda e: ~e["name"].isin(KEPT_FIELDS) & ~F.array_contains(hop, e["name"]))
    new = F.transform(may, lambda e: e["name"])
    return F.array_sort(F.concat(F.filter(stored, lambda e: ~F.array_contains(new, e["name"])), may))


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _validation(stored: Column, update: Column) -> Column:
    a, b = header(stored, "etag"), header(update, "etag")
    c, d = header(stored, "last-modified"), header(update, "last-modified")
    return (F.when(a.isNotNull() & b.isNotNull(), F.when(_opaque(a) == _opaque(b), "resolved").otherwise("etag_mismatch"))
            .when(c.isNotNull() & d.isNotNull(), F.when(c == d, "resolved").otherwise("date_mismatch"))
            .otherwise("no_validator"))


def resolve_revisits(records: DataFrame, id_col: str = "record_id", url_col: str = "target_uri",
                     time_col: str = "captured_at", type_col: str = "record_type", status_col: str = "status",
                     headers_col: str = "headers", ranges: int = TIME_RANGES, profile_col: str | None = None) -> DataFrame:
    """One row per revisit: (record_id, canonical_url, captured_at, response_id, response_at, resolution, headers).

    ``headers`` is the merged list of (name, value). ``time_col`` is a timestamp, ``type_col`` "response" or "revisit".
    """
    r = records.select(
        F.col(id_col).alias("record_id"), canonical_url(F.col(url_col)).alias("canonical_url"),
        F.col(time_col).alias("captured_at"), F.unix_micros(F.col(time_col).cast("timestamp")).alias("at"),
        F.lower(F.col(type_col)).alias("kind"), F.col(status_col).alias("status"), F.col(headers_col).alias("h"),
        (F.coalesce(F.col(status_col) != 304, F.lit(False))
         | (~F.coalesce(F.lower(F.col(profile_col)).rlike("server-not-modified/?$"), F.lit(True)) if profile_col else F.lit(False))).alias("other"))
    r = r.where((F.col("kind") == "revisit") | (F.col("kind") == "response") & (F.col("status") == 200))
    points = r.agg(F.percentile_approx("at", [i / ranges for i in range(1, ranges)], 10_000).alias("p")).first()["p"]
    bounds = sorted(set(points or []))
    # a URL that is null, or a time, cannot be joined on: spread these rows by their id, they meet nothing
    key = F.coalesce("canonical_url", F.concat(F.lit("\0"), F.col("record_id").cast("string")), F.lit("\0"))
    r = r.withColumn("url", key).withColumn("h", header_list(F.col("h"))).withColumn(
        "range", F.size(F.filter(F.lit(bounds) if bounds else F.expr("array()").cast("array<bigint>"),
                                 lambda b: b < F.col("at"))))
    response = F.when((F.col("kind") == "response") & F.col("canonical_url").isNotNull() & F.col("at").isNotNull(),
                      F.struct("at", "record_id", "captured_at", "h"))
    r = r.withColumn("response", response)

    own = Window.partitionBy("url", "range").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = r.withColumn("near", F.max("response").over(own)).where("kind = 'revisit'").drop("response")
    before = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (r.groupBy("url", "range").agg(F.max("response").alias("last"))  # at most `ranges` rows a URL
               .withColumn("far", F.max("last").over(before)).select("url", "range", "far").where("far IS NOT NULL"))
    found = near.join(carried, ["url", "range"], "left").withColumn(
        "hit", F.when(F.col("at").isNotNull(), F.coalesce("near", "far")))
    resolution = (F.when(F.col("other"), "other_profile").when(F.col("canonical_url").isNull(), "no_url").when(F.col("at").isNull(), "no_time")
                  .when(F.col("hit").isNull(), "no_response").otherwise(_validation(F.col("hit.h"), F.col("h"))))
    out = found.withColumn("resolution", resolution)
    return out.select("record_id", "canonical_url", "captured_at", F.col("hit.record_id").alias("response_id"),
                      F.col("hit.captured_at").alias("response_at"), "resolution",
                      F.when(F.col("resolution") == "resolved", merge_headers(F.col("hit.h"), F.col("h"))).alias("headers"))


def attach_payload(resolved: DataFrame, records: DataFrame, id_col: str = "record_id", payload_col: str = "payload") -> DataFrame:
    """``resolved`` with the confirmed response's payload; null where nothing was resolved."""
    body = records.where(F.lower("record_type") == "response").select(F.col(id_col).alias("__id"), F.col(payload_col))
    hit = F.when(F.col("resolution") == "resolved", F.col("response_id"))
    return resolved.join(body.dropDuplicates(["__id"]), hit == F.col("__id"), "left").drop("__id")
