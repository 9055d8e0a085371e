"""Page-rank / visit queries and the join, aggregation and row-operation probes over integer key tables."""

from __future__ import annotations

import decimal
import functools
import itertools

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.verbs import mean, on, total
from tallyframe.plans.registry import Book
from tallyframe.plans.tpcds.shared import D

BOOK = Book()

# --- rankings and visits --------------------------------------------------------------------------


def ranked_pages(t, p):
    return t.rankings.where(f"pageRank > {p.least}").select("pageURL", "pageRank")


def revenue_by_prefix(t, p):
    return t.uservisits.groupBy(F.substring("sourceIP", 1, p.length).alias("prefix")).agg(total("adRevenue", "revenue"))


def best_source(t, p):
    visits = t.uservisits.where((F.col("visitDate") > p.after) & (F.col("visitDate") < p.before))
    return on(visits, t.rankings, "destURL = pageURL").groupBy("sourceIP").agg(mean("pageRank", "avgPageRank"), total("adRevenue", "totalRevenue"))


for _letter, _least, _length, _before in (("A", 1000, 8, D(1980, 4, 1)), ("B", 100, 10, D(1983, 1, 1)), ("C", 10, 12, D(2010, 1, 1))):
    BOOK.add(f"big.q1{_letter}", ranked_pages, "pageURL:s pageRank:i", "SELECT pageURL, pageRank FROM rankings WHERE pageRank > {least}", suite="misc", params={"least": _least})
    BOOK.add(f"big.q2{_letter}", revenue_by_prefix, "prefix:s revenue:d", "SELECT left(sourceIP, {length}) AS prefix, sum(adRevenue) AS revenue FROM uservisits GROUP BY 1", suite="misc", params={"length": _length})
    BOOK.add(f"big.q3{_letter}", best_source, "sourceIP:s totalRevenue:d avgPageRank:d", """
SELECT sourceIP, sum(adRevenue) AS totalRevenue, sum(pageRank)::DOUBLE / count(pageRank) AS avgPageRank
FROM uservisits JOIN rankings ON pageURL = destURL WHERE visitDate > {after} AND visitDate < {before} GROUP BY sourceIP""", suite="misc", order="totalRevenue desc", limit=1, params={"after": D(1980, 1, 1), "before": _before})

# --- integer keys ---------------------------------------------------------------------------------
# The probes want unique integer ids in a small, a middle and a large table; here these are the keys of
# customers, orders and order lines. ``tallyframe.operators.generators.ints`` makes them from a range.

SIZES = {"small": ("customer", "c_custkey"), "mid": ("orders", "o_orderkey"), "large": ("lineitem", "l_orderkey * 8 + l_linenumber")}
_IDS_SQL = ", ".join(f"{n} AS (SELECT {e} AS id FROM {t})" for n, (t, e) in SIZES.items())


def wide(column: str = "id"):
    """A key as a decimal: 64-bit sums of keys end at large scale."""
    return F.col(column).cast("decimal(28,0)")


def ids(t, size: str) -> DataFrame:
    table, key = SIZES[size]
    return t.table(table).select(F.expr(key).alias("id"))


def _all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def counted_ids(t) -> DataFrame:
    """How often each id is in each of the three tables: one pass over each, one shuffle for all."""
    tagged = _all([ids(t, size).select("id", *[F.lit(int(size == s)).alias(s) for s in SIZES]) for size in SIZES])
    return tagged.groupBy("id").agg(*[F.sum(s).alias(s) for s in SIZES])


def pair_counts(counts: DataFrame, how: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """COUNT(*) of the pairs of tables joined one way, from the counts of each id: repeated ids multiply numbers instead of rows. NULL matches nothing."""
    rows = []
    for a, b in pairs:
        x, y = (F.col(c).cast("decimal(19,0)") for c in (a, b))
        matches = F.when(F.col("id").isNotNull() & (x > 0) & (y > 0), x * y).otherwise({"inner": F.lit(0), "left": x, "right": y, "full": x + y}[how])
        rows.append(F.struct(F.lit(a).alias("left_table"), F.lit(b).alias("right_table"), F.coalesce(F.sum(matches), F.lit(0)).alias("cnt")))
    return counts.agg(F.array(*rows).alias("pairs")).select(F.inline("pairs"))


def joined_pair_counts(frames: dict[str, DataFrame], how: str) -> DataFrame:
    """The same from a table for each size, joined two by two: where the tables are bucketed by id, nothing is shuffled below a join."""
    counts = {size: df.groupBy("id").agg(F.count("*").alias(size)) for size, df in frames.items()}
    rows = [pair_counts(df, how, [(size, size)]) for size, df in counts.items()]
    for a, b in itertools.combinations(frames, 2):
        rows.append(pair_counts(counts[a].join(counts[b], "id", "full").fillna(0, [a, b]), how, [(a, b), (b, a)]))
    return _all(rows)


def join_counts(t, p):
    """COUNT(*) of two id tables joined one way, for all nine size pairs."""
    return pair_counts(counted_ids(t), p.how, [(a, b) for a in SIZES for b in SIZES])


for _how, _words in (("inner", "JOIN"), ("right", "RIGHT JOIN"), ("left", "LEFT JOIN"), ("full", "FULL JOIN")):
    BOOK.add(f"join.single_key.{_how}", join_counts, "left_table:s right_table:s cnt:l", f"WITH {_IDS_SQL}\n" + "\nUNION ALL ".join(
        f"SELECT '{a}' AS left_table, '{b}' AS right_table, count(*) AS cnt FROM {a} x {_words} {b} y ON x.id = y.id" for a in SIZES for b in SIZES), suite="given", params={"how": _how})


def join_payload(t, p):
    rows = []
    for size in p.sizes:
        keyed = ids(t, "mid").select("id", F.rpad(F.col("id").cast("string"), size, "*").alias("data"))
        # Planned from the sizes of keys, a side passes for small and would be broadcast with all its data: sorted and merged instead, at any size.
        both = keyed.alias("a").join(keyed.alias("b").hint("merge"), F.col("a.id") == F.col("b.id"))
        # The digest needs every byte of both sides behind the join.
        rows.append(both.agg(F.count("*").alias("rows"), F.sum(F.length("a.data") + F.length("b.data")).alias("bytes"), F.min(F.md5(F.concat("a.data", "b.data"))).alias("digest")).select(F.lit(size).alias("size"), "rows", "bytes", "digest"))
    return _all(rows)


BOOK.add("join.data_size", join_payload, "size:i rows:l bytes:l digest:s", """
SELECT s AS size, count(*) AS rows, sum(length(a.data) + length(b.data)) AS bytes, min(md5(a.data || b.data)) AS digest
FROM (SELECT o_orderkey, s, rpad(o_orderkey::VARCHAR, s, '*') AS data FROM orders, unnest([{sizes}]) AS sizes(s)) a
     JOIN (SELECT o_orderkey, s, rpad(o_orderkey::VARCHAR, s, '*') AS data FROM orders, unnest([{sizes}]) AS sizes(s)) b USING (o_orderkey, s) GROUP BY s""",
         suite="given", params={"sizes": [1, 128, 256, 512, 1024]})


def join_key_types(t, p):
    rows = []
    for kind in p.kinds:
        keyed = ids(t, "mid").select(F.col("id").cast(kind).alias("id"))
        rows.append(keyed.alias("a").join(keyed.alias("b"), F.col("a.id") == F.col("b.id")).agg(F.count("*").alias("rows")).select(F.lit(kind).alias("kind"), "rows"))
    return _all(rows)


BOOK.add("join.key_type", join_key_types, "kind:s rows:l", "SELECT k AS kind, count(*) AS rows FROM orders a JOIN orders b USING (o_orderkey), unnest([{kinds}]) AS kinds(k) GROUP BY k",
         suite="given", params={"kinds": ["string", "int", "long", "double"]})


def join_matches(t, p):
    rows = []
    for copies in p.copies:
        copied = functools.reduce(DataFrame.union, [ids(t, "mid")] * copies)
        rows.append(copied.alias("a").join(ids(t, "mid").alias("b"), F.col("a.id") == F.col("b.id")).agg(F.count("*").alias("rows")).select(F.lit(copies).alias("copies"), "rows"))
    return _all(rows)


BOOK.add("join.num_matches", join_matches, "copies:i rows:l", "SELECT n AS copies, n * (SELECT count(*) FROM orders a JOIN orders b USING (o_orderkey)) AS rows FROM unnest([{copies}]) AS c(n)", suite="given", params={"copies": [1, 2, 4, 8, 16]})


def averages_by_groups(t, p):
    """AVG per group for growing numbers of groups; one summary row per number."""
    lines = ids(t, "large")
    rows = []
    for size in p.sizes:
        groups = lines.groupBy((F.col("id") % size).alias("a")).agg(mean(wide(), "average"))
        rows.append(groups.agg(F.count("*").alias("groups"), F.min("average").alias("lowest"), F.max("average").alias("highest")).select(F.lit(size).alias("size"), "groups", "lowest", "highest"))
    return _all(rows)


_GROUP_SIZES = [10, 100, 1000, 10000, 100000, 1000000]
BOOK.add("agg.num_groups", averages_by_groups, "size:l groups:l lowest:d highest:d", f"WITH {_IDS_SQL}, averages AS (SELECT s, id % s AS a, sum(id)::DOUBLE / count(*) AS v FROM large, unnest([{{sizes}}]) AS sizes(s) GROUP BY 1, 2)\n"
         "SELECT s AS size, count(*) AS groups, min(v) AS lowest, max(v) AS highest FROM averages GROUP BY s", suite="given", params={"sizes": _GROUP_SIZES})


def two_groups(t, p):
    return _all([ids(t, s).groupBy((F.col("id") % 2).alias("a")).agg(mean(wide(), "average")).select(F.lit(s).alias("size"), "a", "average") for s in SIZES])


_EACH_SQL = " UNION ALL ".join(f"SELECT '{s}' AS size, id FROM {s}" for s in SIZES)
BOOK.add("agg.two_groups", two_groups, "size:s a:l average:d", f"WITH {_IDS_SQL}\nSELECT size, id % 2 AS a, sum(id)::DOUBLE / count(*) AS average FROM ({_EACH_SQL}) GROUP BY ALL", suite="given")


def complex_input(t, p):
    return _all([ids(t, s).agg(F.sum(functools.reduce(lambda a, b: a + b, [wide()] * 10)).alias("total")).select(F.lit(s).alias("size"), "total") for s in SIZES])


BOOK.add("agg.complex_input", complex_input, "size:s total:l", f"WITH {_IDS_SQL}\nSELECT size, 10 * sum(id) AS total FROM ({_EACH_SQL}) GROUP BY size", suite="given")


def single_aggregates(t, p):
    return _all([ids(t, s).agg(total(wide(), "total"), mean(wide(), "average"), F.count("id").alias("cnt"), F.stddev("id").alias("deviation")).select(F.lit(s).alias("size"), "*") for s in SIZES])


BOOK.add("agg.single", single_aggregates, "size:s total:l average:d cnt:l deviation:d3", f"WITH {_IDS_SQL}\nSELECT size, sum(id) AS total, sum(id)::DOUBLE / count(*) AS average, count(*) AS cnt, stddev_samp(id) AS deviation FROM ({_EACH_SQL}) GROUP BY size", suite="given")

# --- row operations -------------------------------------------------------------------------------


def key_range(t, p):
    return ids(t, "mid")


def four_filters(t, p):
    return functools.reduce(lambda df, m: df.where(F.col("id") % m != 0), p.divisors, ids(t, "mid"))


def four_maps(t, p):
    return functools.reduce(lambda df, _: df.select((F.col("id") + 1).alias("id")), range(4), ids(t, "mid"))


def key_average(t, p):
    return ids(t, "mid").agg(mean(wide(), "average"))


def key_average_udaf(t, p):
    """Average by a user aggregate in two steps: per partition (sum, count), then the merge; no task sees all rows."""
    def partial(batches):
        rows, amount = 0, 0
        for batch in batches:
            rows, amount = rows + len(batch), amount + sum(map(int, batch["id"]))
        yield pd.DataFrame({"amount": [decimal.Decimal(amount)], "rows": [rows]})

    parts = ids(t, "mid").mapInPandas(partial, "amount decimal(38,0), rows long")
    return parts.agg(F.try_divide(F.sum("amount").cast("double"), F.sum("rows")).alias("average"))


BOOK.add("ds.range", key_range, "id:l", "SELECT o_orderkey AS id FROM orders", suite="given")
BOOK.add("ds.filters", four_filters, "id:l", "SELECT o_orderkey AS id FROM orders WHERE NOT list_contains([o_orderkey % 100, o_orderkey % 101, o_orderkey % 102, o_orderkey % 103], 0)", suite="given", params={"divisors": [100, 101, 102, 103]})
BOOK.add("ds.maps", four_maps, "id:l", "SELECT o_orderkey + 4 AS id FROM orders", suite="given")
_AVERAGE_SQL = "SELECT sum(o_orderkey)::DOUBLE / count(*) AS average FROM orders"
BOOK.add("ds.average", key_average, "average:d", _AVERAGE_SQL, suite="given")
BOOK.add("udf.typed_average", key_average_udaf, "average:d", _AVERAGE_SQL, suite="given")
