"""Pieces that many retail reports have in common."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.verbs import mean, on, semi

D = datetime.date
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
SHORT_DAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Sales side, returns side and their order key, per channel.
CHANNELS = {"store": ("store_sales", "ss", "store_returns", "sr", "ticket_number"),
            "catalog": ("catalog_sales", "cs", "catalog_returns", "cr", "order_number"),
            "web": ("web_sales", "ws", "web_returns", "wr", "order_number")}
BUYER = {"store": "ss_customer_sk", "catalog": "cs_bill_customer_sk", "web": "ws_bill_customer_sk"}
PLACE = {"store": "ss_addr_sk", "catalog": "cs_bill_addr_sk", "web": "ws_bill_addr_sk"}


def take(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def sold(t, channel: str, /, **columns: str) -> DataFrame:
    """Sales of one channel under common names; ``~`` stands for the channel's column prefix."""
    table, prefix, *_ = CHANNELS[channel]
    return take(t.table(table), **{n: e.replace("~", prefix) for n, e in columns.items()})


def sent_back(t, channel: str, /, **columns: str) -> DataFrame:
    _, _, table, prefix, _ = CHANNELS[channel]
    return take(t.table(table), **{n: e.replace("~", prefix) for n, e in columns.items()})


def on_days(df: DataFrame, t, key: str, condition) -> DataFrame:
    """Rows whose day meets a condition, when no column of the day is needed."""
    return semi(df, t.date_dim.where(condition), f"{key} = d_date_sk")


def dated(df: DataFrame, t, key: str, condition=None) -> DataFrame:
    days = t.date_dim if condition is None else t.date_dim.where(condition)
    return on(df, days, f"{key} = d_date_sk")


def day_window(day: datetime.date, after: int, before: int = 0) -> Column:
    return F.col("d_date").between(day - datetime.timedelta(days=before), day + datetime.timedelta(days=after))


def weekday_sums(value: str) -> list[Column]:
    return [F.sum(F.when(F.col("d_day_name") == full, F.expr(value))).alias(f"{short}_sales") for full, short in zip(WEEKDAYS, SHORT_DAYS)]


def weekday_sums_sql(value: str) -> str:
    return ", ".join(f"sum({value}) FILTER (WHERE d_dow = {i}) AS {s}_sales" for i, s in enumerate(SHORT_DAYS))


def above_peers(totals: DataFrame, group: str, factor: float = 1.2) -> DataFrame:
    """Rows whose ``total`` exceeds ``factor`` times the average of their group: a small aggregate joined back."""
    peers = totals.groupBy(F.col(group).alias("peer_group")).agg(mean("total", "peer_average"))
    return on(totals, peers, f"{group} = peer_group").where(f"total > peer_average * {factor}")


def share_of_class(items: DataFrame) -> DataFrame:
    """Revenue of each item as percentage of its class; the class totals are a small side."""
    classes = items.groupBy(F.col("i_class").alias("of_class")).agg(F.sum("itemrevenue").alias("class_revenue"))
    return on(items, classes, "i_class <=> of_class").withColumn(
        "revenueratio", F.try_divide(F.col("itemrevenue").cast("double") * 100, F.col("class_revenue").cast("double")))


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
