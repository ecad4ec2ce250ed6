"""Not-modified revisits: as-of join by canonical url to the latest earlier full response.

The join is a running "latest response" per url over time, in two levels: the
time line of each url is cut into pieces; each piece's latest response is one
row, carried into the next pieces by a window over those rows; inside a piece
the window runs over its own records.  A url that holds a third of all records
is so spread over its pieces.  Bodies are not shuffled: a resolved revisit
names the record whose body it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlane.llm.common import LOWER, UPPER

#: Length of a time piece in seconds.
PIECE_SECONDS = 3600
#: Query parameters that don't name another page.
TRACKING = r"(?:utm_[^=&]*|ref|gclid|fbclid)(?:=[^&]*)?"
#: Headers that a 304 answer may update (the published HTTP caching rules leave out those that describe
#: the stored body or the connection).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "vary")


def canonical_url(url: Column) -> Column:
    """Host lower-cased without ``www.``, path without a trailing slash, query without tracking parameters and sorted.

    Scheme and fragment go.  A null url stays null; one without ``://`` is taken as it is, without its fragment.
    """
    bare = F.regexp_replace(url, "#.*$", "")
    rest = F.regexp_replace(bare, r"^[^:/?]*://", "")
    host = F.regexp_replace(F.translate(F.regexp_extract(rest, r"^([^/?]*)", 1), UPPER, LOWER), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    args = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
                    lambda a: (a != "") & ~a.rlike(f"^{TRACKING}$"))
    query = F.array_join(F.array_sort(args), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _header(headers: str, name: str) -> Column:
    return F.try_element_at(F.col(headers), F.lit(name))


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED,
                     piece_seconds: int = PIECE_SECONDS) -> DataFrame:
    """One row per revisit record: the response it stands for, the check of validators and the merged headers.

    records: record_id, url, ts (timestamp), kind (``response`` or
    ``revisit``; others are ignored), headers (map of lower-case names); other
    columns are not read.  Returns record_id, canonical, ts, origin_id,
    origin_ts, status and headers.

    The origin is the latest response of the same canonical url with an earlier
    ts; among equal ts the greatest record_id.  Status: ``etag`` or
    ``last-modified`` (the validator that agrees, entity tags compared weakly,
    the tag first), ``mismatch`` (the first validator that both sides carry
    differs), ``unchecked`` (no validator in common) or ``no-origin``.  Headers
    are the origin's, replaced or extended by the revisit's permitted ones where
    the status is neither ``mismatch`` nor ``no-origin``; else the revisit's own.
    A null url or ts finds no origin; null headers count as none; repeated
    revisit rows give a row each; an empty table gives an empty one.
    """
    none = F.create_map().cast("map<string,string>")
    r = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", "ts", canonical_url(F.col("url")).alias("canonical"),
        F.coalesce("headers", none).alias("headers"))
    r = r.withColumns({
        "piece": F.floor(F.unix_seconds("ts") / piece_seconds),
        "full": F.when((F.col("kind") == "response") & F.col("canonical").isNotNull() & F.col("ts").isNotNull(),
                       F.struct("ts", "record_id", "headers"))})
    # Maps can't be compared, so the latest is chosen by (ts, record_id).
    last = (r.filter(F.col("full").isNotNull()).groupBy("canonical", "piece")
            .agg(F.max_by("full", F.struct("ts", "record_id")).alias("last")))
    # Revisit-only pieces need a row too, to be given what earlier pieces carry.
    places = r.filter(F.col("canonical").isNotNull() & F.col("ts").isNotNull()).select("canonical", "piece").distinct()
    w = W.partitionBy("canonical").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    carried = places.join(last, ["canonical", "piece"], "left").select(
        "canonical", "piece", F.last("last", ignorenulls=True).over(w).alias("carried"))
    inside = W.partitionBy("canonical", "piece").orderBy("ts", F.col("kind").desc(), "record_id").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    # Revisits sort before responses of the same ts ("revisit" > "response"), so only earlier responses are seen.
    r = r.withColumn("here", F.last("full", ignorenulls=True).over(inside)).filter(F.col("kind") == "revisit")
    r = r.join(carried, ["canonical", "piece"], "left").withColumn("origin", F.coalesce("here", "carried"))

    tag = lambda c: F.regexp_replace(c, r"^W/", "")
    own_tag, own_date = tag(_header("headers", "etag")), _header("headers", "last-modified")
    full_tag, full_date = tag(_header("origin.headers", "etag")), _header("origin.headers", "last-modified")
    status = (F.when(F.col("origin").isNull(), "no-origin")
              .when(own_tag.isNotNull() & full_tag.isNotNull(), F.when(own_tag == full_tag, "etag").otherwise("mismatch"))
              .when(own_date.isNotNull() & full_date.isNotNull(),
                    F.when(own_date == full_date, "last-modified").otherwise("mismatch"))
              .otherwise("unchecked"))
    update = F.map_filter("headers", lambda k, _: k.isin(*permitted))
    keep = F.map_filter("origin.headers", lambda k, _: ~F.array_contains(F.map_keys(update), k))
    return (r.withColumn("status", status).select(
        "record_id", "canonical", "ts", F.col("origin.record_id").alias("origin_id"), F.col("origin.ts").alias("origin_ts"),
        "status", F.when(F.col("status").isin("mismatch", "no-origin"), F.col("headers"))
        .otherwise(F.map_concat(keep, update)).alias("headers")))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records of the pages table: every page row is a full response and a later revisit of its url.

    The tables hold no archive, so captures are derived from all page rows: row p is fetched p minutes after a fixed
    start, and revisited one day later.  A response carries an entity tag (its html's md5) where that begins with a digit
    and a date always; the revisit names the html that its own row holds, and a date only where its md5 ends in a digit.
    """
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.timestamp_seconds(F.unix_seconds(start) + F.coalesce("page_id", F.lit(0)) * 60)
    digest = F.md5(F.coalesce("html", F.lit("")))
    day = F.date_format(at, "yyyy-MM-dd")

    def headers(*pairs: tuple[str, Column]) -> Column:
        both = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]))
        return F.map_filter(both, lambda _, v: v.isNotNull())

    tagged = F.when(digest.rlike("^[0-9]"), F.concat(F.lit('"'), digest, F.lit('"')))
    base = pages.select("page_id", "url", at.alias("at"), digest.alias("digest"), day.alias("day"), tagged.alias("tag"))
    full = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("at").alias("ts"), F.lit("response").alias("kind"),
        headers(("etag", F.col("tag")), ("last-modified", F.col("day")), ("content-type", F.lit("text/html")),
                ("server", F.lit("a"))).alias("headers"))
    again = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("at") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        F.lit("revisit").alias("kind"),
        headers(("etag", F.when(F.col("tag").isNotNull(), F.concat(F.lit("W/"), "tag"))),
                ("last-modified", F.when(F.col("digest").rlike("[0-9]$"), F.col("day"))),
                ("content-type", F.lit("message/http")), ("server", F.lit("b"))).alias("headers"))
    return full.unionByName(again)
