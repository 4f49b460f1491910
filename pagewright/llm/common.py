"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Words of 64 bits in the table of wanted ids that texts are filtered by before they are shuffled.
FILTER = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It comes from spark.checkpoint.dir. Where that is unset a session on one machine gets a temporary
    folder, recorded in the session; on a cluster it is an error, as no folder is known to be shared.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pagewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_homes: dict[str, SparkSession] = {}


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _delete_all() -> None:
    """What is still there of this driver's tables when it ends; its JVM may have ended before."""
    for home, spark in _homes.items():
        with contextlib.suppress(Exception):
            delete(spark, home)


def home(spark: SparkSession) -> str:
    """This application's own folder in the shared one; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/pagewright-{spark.sparkContext.applicationId}"
    _homes[path] = spark
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: a lost executor costs no recomputation of its lineage."""
    path = f"{home(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop_cut(*frames: DataFrame) -> None:
    """Deletes tables made by cut() that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "cut_path", None):
            delete(df.sparkSession, path)


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else kept; null as the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def let(value: Column, f) -> Column:
    """f(value) with value computed once for a row, also where f uses it inside higher-order functions."""
    return F.transform(F.array(value), f)[0]


def words(text: Column) -> Column:
    """Array of the lower-cased words of a text."""
    return F.filter(F.split(ascii_lower(text), SPACES), lambda w: w != F.lit(""))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right on equal keys, null equal to null; the keys come from left."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"__r_{k}"])
    return left.join(right, cond, how).drop(*[f"__r_{k}" for k in keys])


def by_bit(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs with __maybe: whether the hash bit of doc_id is set in a table of the bits of ids.

    The table has FILTER rows at most at any number of ids, so it can be broadcast; the more ids, the
    less it holds back.
    """
    word = lambda c: F.pmod(F.shiftright(F.xxhash64(c), 6), F.lit(FILTER))
    bit = lambda c: F.expr(f"shiftleft(1L, cast(xxhash64({c}) & 63 as int))")
    table = ids.select(word("doc_id").alias("__w"), bit("doc_id").alias("__b")).groupBy("__w").agg(F.bit_or("__b").alias("__bits"))
    j = docs.withColumn("__w", word("doc_id")).join(F.broadcast(table), "__w", "left")
    return j.select(*docs.columns, F.coalesce(F.col("__bits").bitwiseAND(bit("doc_id")) != 0, F.lit(False)).alias("__maybe"))


def maybe_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without most of the rows whose doc_id is not in ids."""
    return by_bit(docs, ids).filter("__maybe").drop("__maybe")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in ids; of the others, few texts are shuffled."""
    rows = by_bit(docs, ids)
    rest = rows.filter("__maybe").join(ids, "doc_id", "left_anti")
    return rows.filter("not __maybe").select(docs.columns).union(rest.select(docs.columns))


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], spread: Column, buckets: int, name: str) -> DataFrame:
    """df with a column `name`: 0, 1, 2 ... within each group of `keys`.

    A group is ranked in `buckets` hash pieces: each piece is ranked on its own and starts where the
    pieces before it end, so that one task never sorts a whole group. Pieces are counted before the
    shuffle; the table of starts has at most (number of groups x buckets) rows.
    """
    df = df.withColumn("__piece", F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = df.groupBy(*keys, "__piece").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__piece").orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(inside))
    out = join_on(ranked, starts, [*keys, "__piece"], "left")
    return out.withColumn(name, (F.col("__rank") - 1 + F.col("__start")).cast("long")).drop("__piece", "__rank", "__start")
