"""URL filters: a temporal list join.

List entries are dated: a pattern (a domain, or a domain with the first parts of a path) is added to a list or removed from it at some
date. They become validity intervals, and every capture is joined as of its fetch date with the entries of its own domain, the domains
above it and the beginnings of its path. The most specific entry that was active decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import picked


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)[.]?(?::[0-9]*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def intervals(events: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_until) from (list, kind, pattern, action, at).

    Patterns are compared in lower case. An addition is valid until the next event of its list and pattern, or without end (null). Of events at one time an addition wins,
    and of additions the kind that comes first by name. Events without pattern, action or time are ignored.
    """
    cased = events.withColumn("pattern", F.lower("pattern"))
    known = cased.where("pattern is not null and at is not null and action in ('add', 'remove')").groupBy("list", "pattern", "at").agg(F.min(F.struct("action", "kind")).alias("e"))
    order = Window.partitionBy("list", "pattern").orderBy("at")
    return (known.withColumn("valid_until", F.lead("at").over(order)).where("e.action = 'add'")
            .select("list", F.col("e.kind").alias("kind"), "pattern", F.col("at").alias("valid_from"), "valid_until"))


def patterns(host: Column, path: Column, depth: int) -> Column:
    """The host, the domains above it, and the host with the first 1 to ``depth`` parts of the path."""
    labels, parts = F.split(host, "[.]"), F.filter(F.split(F.lower(path), "/"), lambda p: p != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    most = F.least(F.lit(depth), F.size(parts))
    paths = F.when(most > 0, F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def temporal_filter(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched") -> DataFrame:
    """Every capture with the entry that decides on it.

    Result, one row per capture: page_id, url, fetched, host, pattern, list, kind, valid_from, valid_until (null where no entry was active)
    and blocked. Longer patterns come before shorter ones; of equally long ones ``allow`` before ``block``, then the first list by name.
    An entry is active from its addition, included, to its end, excluded. A capture without url, host or time is never blocked. Repeated
    captures are judged each; empty tables on either side are fine; other columns are ignored. Paths are compared in lower case, to the
    depth of the deepest entry. A host with most captures is no problem: its entries are few, and adaptive execution splits the
    captures' side of the join.
    """
    valid = intervals(events)
    depth = valid.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    rows = (picked(captures, page_id=id_col, url=url_col, fetched=at_col).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
            .withColumn("wanted", patterns(F.col("host"), path_of(F.col("url")), depth)))
    keyed = rows.withColumn("pattern", F.explode_outer("wanted")).withColumn("row", F.struct("page_id", "url", "fetched", "host")).select("row", "pattern")
    # Equal captures are judged once and repeated at the end.
    active = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col("fetched_at") < F.col("valid_until")))
    counted = keyed.groupBy("row", "pattern").agg(F.count("*").alias("copies")).withColumn("fetched_at", F.col("row.fetched"))
    joined = counted.join(valid.withColumnRenamed("pattern", "listed"), (F.col("pattern") == F.col("listed")) & active, "left")
    rank = F.struct((-F.length("listed")).alias("length"), "kind", "list", "valid_from", F.col("listed").alias("pattern"), "valid_until")
    decided = joined.groupBy("row").agg(F.max("copies").alias("copies"), F.min(F.when(F.col("listed").isNotNull(), rank)).alias("entry"))
    return decided.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*", "entry.pattern", "entry.list", "entry.kind", "entry.valid_from", "entry.valid_until",
                                                                                              F.coalesce(F.col("entry.kind") == "block", F.lit(False)).alias("blocked"))
