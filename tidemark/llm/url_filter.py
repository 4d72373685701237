"""URL filters as a temporal join: dated list entries become validity intervals,
and every capture is judged by the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def url_keys(url: Column) -> Column:
    """All patterns that cover a URL: its host, each parent domain, and the host with
    each leading run of path segments (``a.b.org``, ``b.org``, ``org``, ``a.b.org/x``, ``a.b.org/x/y``)."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    segments = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    prefixes = F.when(
        F.size(segments) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(segments)),
            lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(host, F.lit("")) == "", none).otherwise(F.concat(domains, prefixes))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list_name, pattern, valid_from, valid_to (exclusive; null: still active).

    ``entries`` has list_name ('block' or 'allow'), pattern, entry_date and active (true: added,
    false: taken off). Repeated entries are one; a day that holds both kinds for a pattern counts as
    taken off; an entry that does not change the state is ignored. Rows with a
    null in any column are left out. States are first reduced to one per list, pattern and day,
    so the window over a pattern has at most one row per calendar day.
    """
    days = entries.dropna(subset=["list_name", "pattern", "entry_date", "active"])
    days = days.groupBy("list_name", "pattern", "entry_date").agg(F.min("active").alias("active"))
    w = Window.partitionBy("list_name", "pattern").orderBy("entry_date")
    changes = days.withColumn("was", F.coalesce(F.lag("active").over(w), F.lit(False))).filter("active <> was")
    return (
        changes.withColumn("valid_to", F.lead("entry_date").over(w))
        .filter("active")
        .select("list_name", "pattern", F.col("entry_date").alias("valid_from"), "valid_to")
    )


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_on") -> DataFrame:
    """id, url, fetch time, host, kept, list_name, pattern, valid_from, valid_to per capture.

    Among the entries that cover the URL and were active at the fetch time the
    longest pattern decides, at equal length (the same pattern on both lists) the allow
    list; without any the capture is kept and the last four are null. A null or
    unparsable URL and a null fetch time match nothing. Repeated captures each give a row.

    The join is an equality join on the pattern with the interval as a further condition.
    Both sides are shuffled from stored rows, so skewed patterns (a host with a third of all
    captures) are split by adaptive execution.
    """
    spans = materialize(validity_intervals(entries), "url-intervals").withColumnRenamed("pattern", "k_pattern")
    url = F.col(f"`{url_col}`")
    caps = captures.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(f"`{id_col}`").alias("c_id"),
        url.alias("c_url"),
        F.col(f"`{time_col}`").alias("c_time"),
    )
    keyed = caps.select("*", F.explode_outer(url_keys(F.col("c_url"))).alias("key"))
    hits = keyed.join(
        spans,
        (F.col("key") == F.col("k_pattern"))
        & (F.col("valid_from") <= F.col("c_time"))
        & (F.col("valid_to").isNull() | (F.col("c_time") < F.col("valid_to"))),
        "left",
    )
    best = F.max(
        F.when(
            F.col("k_pattern").isNotNull(),
            F.struct(
                F.char_length("k_pattern").alias("len"),
                (F.col("list_name") == "allow").alias("allow"),
                F.col("list_name"),
                F.col("k_pattern"),
                F.col("valid_from"),
                F.col("valid_to"),
            ),
        )
    )
    judged = hits.groupBy("rid", "c_id", "c_url", "c_time").agg(best.alias("hit"))
    return judged.select(
        F.col("c_id").alias(id_col),
        F.col("c_url").alias(url_col),
        F.col("c_time").alias(time_col),
        url_host(F.col("c_url")).alias("host"),
        F.coalesce(F.col("hit.allow"), F.lit(True)).alias("kept"),
        F.col("hit.list_name").alias("list_name"),
        F.col("hit.k_pattern").alias("pattern"),
        F.col("hit.valid_from").alias("valid_from"),
        F.col("hit.valid_to").alias("valid_to"),
    )
