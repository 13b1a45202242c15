"""Session, table and lineage helpers shared by all operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Every code point that counts as white space in Unicode text handling. Fixed values.
WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x85   -     　]+"

_written: list[tuple[SparkSession, str]] = []
_local_dir: str | None = None


def session(app: str = "litloom", cores: str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one if the master is local."""
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="litloom-")
        atexit.register(__import__("shutil").rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def materialize(df: DataFrame, name: str, by: list[str] | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write df once as a Parquet table in the shared folder and read it back: lineage is cut, and the copy outlives executors.

    With `by` the table is laid out in one folder per value, so that later filters on these columns prune files. `options` go to the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/litloom/{name}-{uuid.uuid4().hex}"
    writer = df.write.options(**(options or {}))
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    if not _written:
        atexit.register(release)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit
        pass


def drop(*tables: DataFrame) -> None:
    """Delete tables that materialize() has written and nothing reads any more."""
    gone = {t.written_at for t in tables}
    for spark, path in [x for x in _written if x[1] in gone]:
        _delete(spark, path)
        _written.remove((spark, path))


def release() -> None:
    """Delete what materialize() has written in this process."""
    while _written:
        _delete(*_written.pop())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clean(c: Column | str) -> Column:
    """Outer white space off, inner runs one blank, lower case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(F.regexp_replace(c, WHITESPACE, " ")))


def words(c: Column | str) -> Column:
    """Maximal runs of a-z and 0-9 in the lower-cased text; null gives an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)), F.array().cast("array<string>"))




def bounded_sample(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n rows with the smallest values of `by`, a column of hashes. Only some 2 n rows are ever sorted, however many there are."""
    total, steps = df.count(), 1_000_003
    if total > 4 * n:
        df = df.filter(F.pmod(F.xxhash64(by), F.lit(steps)) < -(-2 * n * steps // total))
    return df.orderBy(by).limit(n)


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for Python stages over few small files; larger inputs stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
