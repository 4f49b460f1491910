"""Model calls as tables: requests out, responses in, validated; nothing here reaches a network."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import exprs as X

Provider = Callable[[DataFrame], DataFrame]
ATTEMPTS, REPAIRS = 3, 3


def replay(requests: DataFrame, responses: DataFrame, task: str, schema: str) -> DataFrame:
    """requests with `parsed`, the first response of each request_key (by attempt) that fits the schema, else null."""
    r = responses.filter((F.col("task") == task) & (F.col("attempt") <= ATTEMPTS))
    p = r.withColumn("p", F.from_json(X.de_fence(F.col("response")), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})).filter("p._bad is null")
    best = p.groupBy("request_key").agg(F.min_by("p", "attempt").alias("parsed"))
    return requests.join(best, "request_key", "left")


def route(requests: DataFrame, routes: DataFrame, key: str) -> DataFrame:
    """A model for each request of its group, in proportion to weights, by a hash that other engines share."""
    w = Window.partitionBy("grp").orderBy("model")
    r = routes.withColumn("hi", F.sum("weight").over(w)).withColumn("lo", F.col("hi") - F.col("weight")).withColumn("w", F.sum("weight").over(Window.partitionBy("grp")))
    h = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    q = requests.withColumn("h", h)
    return q.join(r, "grp").filter((F.col("h") % F.col("w") >= F.col("lo")) & (F.col("h") % F.col("w") < F.col("hi"))).drop("h", "hi", "lo", "w", "weight")


def approval_step(state: DataFrame) -> DataFrame:
    """One step of the approval of a document: approved once the checks pass and, before the third attempt, no critical feedback is left."""
    ok = F.col("checks_pass") & ((F.col("attempt") >= 2) | (F.col("n_critical") == 0))
    return state.withColumn("approved", ok).withColumn("attempt", F.when(ok, F.col("attempt")).otherwise(F.col("attempt") + 1).cast("int"))


def approval_loop(state: DataFrame, check: Provider, repair: Provider) -> DataFrame:
    """check fills checks_pass and n_critical, repair changes html; at most REPAIRS repairs, the last one is not checked again."""
    done = None
    for _ in range(REPAIRS):
        stepped = approval_step(check(state))
        over = stepped.filter("approved")
        done = over if done is None else done.unionByName(over)
        state = repair(stepped.filter("not approved"))
    return done.unionByName(state.select(done.columns))


def embed(rows: DataFrame, call: Callable[[list[str]], list[list[float]]], key: str, text: str, size: int = 32) -> DataFrame:
    """key, vector: texts sent in batches inside each task; a failed batch yields no rows. Vectors join by key."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames):
        import pandas as pd

        for f in frames:
            f = f[f[text].notna() & (f[text] != "")]
            for a in range(0, len(f), size):
                part = f.iloc[a : a + size]
                try:
                    vectors = call(part[text].tolist())
                except Exception:  # a provider may fail in any way; the rest of the rows goes on
                    continue
                yield pd.DataFrame({key: part[key].to_numpy(), "vector": vectors})

    return rows.select(key, text).mapInPandas(run, f"{key} {kind}, vector array<float>")
