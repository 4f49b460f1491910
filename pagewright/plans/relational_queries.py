"""Queries on the event stream (extensions: the windows a processing service needs) and generic relational plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.plans.registry import query
from pagewright.sources import views as V
from pagewright.streaming import jobs as J


def _events(spark, d):
    return V.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _second(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("event_tumbling_windows", "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark, d):
    w = J.event_windows(_events(spark, d), "1 day")
    return w.select(_second("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("event_sliding_windows", "SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY ALL")
def _(spark, d):
    w = J.event_windows(_events(spark, d), "12 hours", "6 hours")
    return w.select(_second("start").alias("start"), "event_type", "n")


@query("event_sessions", "e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k")
def _(spark, d):
    s = J.sessions(_events(spark, d), "30 minutes")
    return s.select("user_id", _second("start").alias("start"), "n")


@query("job_latest_status", "SELECT user_id AS job_id, arg_max(event_type, CAST(epoch_us(ts) AS HUGEINT) * 10000 + event_id % 10000) AS status FROM events GROUP BY user_id")
def _(spark, d):
    e = _events(spark, d).select(F.col("user_id").alias("job_id"), F.col("event_type").alias("status"), F.struct("ts", (F.col("event_id") % 10000).alias("k")).alias("ts"))
    return J.latest_status(e).select("job_id", "status")


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def _(spark, d):
    l = V.table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")  # noqa: E741
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("revenue_by_nation", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus = 'F' GROUP BY n_name")
def _(spark, d):
    t = lambda n: V.table(spark, d, n)
    j = t("lineitem").join(t("orders").filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
