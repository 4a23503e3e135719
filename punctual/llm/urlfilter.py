"""URL filter lists with dates: every capture is judged by the entries in force when it was fetched.

A list entry says from when on a host (with all below it) or a path of a host is blocked or allowed. ``intervals``
turns the dated entries of a key into validity intervals, each up to the key's next entry. ``evaluate`` is an as-of
join: the keys that a URL falls under meet the interval of each key that holds the fetch time, and the most specific
of them decides.

Intervals and captures meet by key and time bucket, so a key with a long history, or a host with a large part of all
captures, is spread over its buckets, and an equal-key join is left to adaptive execution to split further. Captures
are judged once per different (URL, time).

Results in edge cases: a null or unparsable URL, a null fetch time, and a URL under no active entry are kept, with null
match columns; entries with a null key, time or action are ignored; of several entries of a key at one time a blocking
one wins; an entry is in force from its time on, that moment included; repeated captures are judged alike and all
returned; empty tables give empty tables or unfiltered captures; columns of the captures keep their names, the added
ones replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
BUCKET_SECONDS = 30 * 86400
VERDICT = ["matched_key", "matched_from", "kept"]


def host_of(url: Column) -> Column:
    """The lower-case host without user, port and final dot; null where there is none."""
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(F.lower(found), r"\.$", "")
    return F.when(host != "", host)


def _path_of(url: Column) -> Column:
    """The path without query and fragment, and without slashes at its ends."""
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)", 1)
    return F.regexp_replace(found, r"/+$", "")


def keys_of(url: Column) -> Column:
    """The keys a URL falls under: its host and all parent domains, then ``host/path`` for every leading part of its path."""
    host = host_of(url)
    labels, segments = F.split(host, r"\."), F.split(_path_of(url), "/")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda at: F.array_join(F.slice(labels, at, F.size(labels)), ".")
    )
    paths = F.transform(
        F.sequence(F.lit(1), F.size(segments)),
        lambda at: F.concat_ws("/", host, F.array_join(F.slice(segments, F.lit(1), at), "/")),
    )
    return F.when(host.isNotNull(), F.concat(domains, F.when(_path_of(url) != "", paths).otherwise(F.array().cast("array<string>"))))


def intervals(entries: DataFrame, key: str = "key", action: str = "action", since: str = "since") -> DataFrame:
    """One row per entry: ``key``, ``action``, ``valid_from`` and ``valid_to`` (not included; null while it lasts).

    Hosts are lower-cased, as those of captures are; paths keep their case.
    """
    known = entries.filter(F.col(key).isNotNull() & F.col(action).isNotNull() & F.col(since).isNotNull())
    host = F.substring_index(key, "/", 1)
    as_asked = F.concat(F.lower(host), F.expr(f"substring(`{key}`, length(substring_index(`{key}`, '/', 1)) + 1)"))
    one = known.groupBy(as_asked.alias("key"), F.col(since).alias("valid_from")).agg(F.max(action).alias("action"))
    following = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))
    return one.withColumn("valid_to", following)


def evaluate(
    captures: DataFrame, valid: DataFrame, url: str = "url", fetched: str = "fetched", bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Add ``matched_key``, ``matched_from`` and ``kept`` (boolean) to the captures; ``valid`` comes from ``intervals``."""
    base = captures.drop(*VERDICT)
    distinct = (
        base.select(F.col(url).alias("_url"), F.col(fetched).alias("_at"))
        .filter(F.col("_url").isNotNull() & F.col("_at").isNotNull())
        .distinct()
    )

    def bucket(moment: Column) -> Column:
        return F.floor(F.unix_timestamp(moment) / bucket_seconds)

    last = distinct.agg(F.max("_at").alias("_last"))
    span = F.sequence(bucket(F.col("valid_from")), bucket(F.least(F.coalesce("valid_to", "_last"), F.col("_last"))))
    # One row joins here: the time of the last capture, up to which open intervals are laid out.
    reached = valid.join(F.broadcast(last)).filter(F.col("valid_from") <= F.col("_last"))
    laid_out = reached.select("key", "action", "valid_from", "valid_to", F.explode(span).alias("_bucket"))
    asked = distinct.withColumn("key", F.explode(keys_of(F.col("_url")))).withColumn("_bucket", bucket(F.col("_at")))
    active = asked.join(laid_out, ["key", "_bucket"]).filter(
        (F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    )
    # A path of a host is more specific than the host; a longer key than a shorter one.
    rank = F.struct(F.instr("key", "/") > 0, F.length("key"))
    judged = active.groupBy("_url", "_at").agg(F.max_by(F.struct("key", "valid_from", "action"), rank).alias("_hit"))
    matched = base.join(judged, (F.col(url) == F.col("_url")) & (F.col(fetched) == F.col("_at")), "left")
    return matched.select(
        *base.columns,
        F.col("_hit.key").alias("matched_key"),
        F.col("_hit.valid_from").alias("matched_from"),
        F.coalesce(F.col("_hit.action") != BLOCK, F.lit(True)).alias("kept"),
    )
