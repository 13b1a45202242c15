"""What is new, what was first, and what was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def resolve_lines(lines: DataFrame, column: str, space: str) -> DataFrame:
    """(key): the distinct keys of a name space in a checkpoint file; bare lines count, lines of other name spaces and blank ones do not."""
    line = F.trim(F.regexp_replace(column, r"[\t\r\n]", " "))
    key = F.trim(F.when(F.contains(line, F.lit(":")), F.when(F.substring_index(line, ":", 1) == space, F.expr(f"substring({column}, instr({column}, ':') + 1)"))).otherwise(line))
    return lines.select(key.alias("key")).filter("key <> ''").distinct()


def not_done(rows: DataFrame, key: Column, done: DataFrame) -> DataFrame:
    """The rows whose key is not among `done` (key). Null keys are never done. Catalyst broadcasts `done` only if it is small."""
    return rows.withColumn("_key", key).join(done.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key")


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row that comes first of each key; rows with a blank or null key are all kept.

    Only (key, order) is shuffled to find the first, with partial minima, so a hot key costs one row for each task; ties
    in order are kept.
    """
    blank = F.col(key).isNull() | (F.trim(F.col(key)) == "")
    first = rows.filter(~blank).groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    kept = rows.filter(~blank).join(first, (F.col(key) == F.col("_key")) & (F.col(order) == F.col("_first")), "left_semi")
    return kept.unionByName(rows.filter(blank))


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as an upsert would leave it."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_last"))
    return rows.join(last, F.col(key).eqNullSafe(F.col("_key")) & (F.col(order) == F.col("_last")), "left_semi")


def since(rows: DataFrame, when: str, cutoff: Column) -> DataFrame:
    return rows.filter(F.col(when) > cutoff)


def batches(rows: DataFrame, order: str, size: int, block: int = 100_000) -> DataFrame:
    """rows with batch_no: runs of `size` rows in the order of a dense integer column, numbered without a global sort."""
    low = rows.agg(F.min(order)).first()[0] or 0
    part = rows.withColumn("_block", F.floor((F.col(order) - F.lit(low)) / block).cast("long"))
    counts = part.groupBy("_block").count().orderBy("_block").collect()  # one row for each `block` places in the order
    at, starts = 0, []
    for r in counts:
        starts.append((r[0], at))
        at += r[1]
    base = rows.sparkSession.createDataFrame(starts, "_block long, _base long")
    number = F.col("_base") + F.row_number().over(Window.partitionBy("_block").orderBy(order)) - 1
    return part.join(base, "_block").withColumn("row_no", number).withColumn("batch_no", F.floor(F.col("row_no") / size).cast("long")).drop("_block", "_base")


def split_by_reason(rows: DataFrame, reason: Column, key: Column, stage: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, dead letters (key, stage, reason)); white space in reasons is made single blanks."""
    told = rows.withColumn("_reason", reason)
    dead = told.filter("_reason is not null").select(key.alias("key"), F.lit(stage).alias("stage"), F.trim(F.regexp_replace("_reason", r"\s+", " ")).alias("reason"))
    return told.filter("_reason is null").drop("_reason"), dead


def verified_output(rows: DataFrame, order: str, kinds: list[str], every: int = 1000) -> DataFrame:
    """(kind, value, estimated): the number of all rows, and by each column of `kinds` how many there are, from every `every`-th row in order.

    The sample is the feature: the counts are what it gives times `every`, the total (kind 'all') is exact. Null values are 'unknown'.
    """
    numbered = batches(rows.select(order, *kinds), order, every)
    sampled = numbered.filter(F.col("row_no") % every == 0)
    each = sampled.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(k).cast("string"), F.lit("unknown")).alias("value")) for k in kinds))).alias("x")).select("x.kind", "x.value")
    total = rows.agg(F.count("*").alias("estimated")).select(F.lit("all").alias("kind"), F.lit("").alias("value"), "estimated")
    return total.unionByName(each.groupBy("kind", "value").agg((F.count("*") * every).alias("estimated")))
