"""Listings, checked gzip files, ZIP members and logs as DataFrames."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, folder: str, glob: str = "*", since: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of the files in a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return (reader.option("modifiedAfter", since) if since else reader).load(folder).drop("content")


def pick(files: DataFrame, name: str, most: int, oldest_first: bool = False) -> DataFrame:
    """The last, or first, `most` files by name."""
    return files.orderBy(F.col(name).asc() if oldest_first else F.col(name).desc()).limit(most)


def modified(c: Column) -> Column:
    """A time of an FTP listing (YYYYMMDDHHMMSS with or without fraction); null if it is none."""
    return F.try_to_timestamp(F.substring_index(c, ".", 1), F.lit("yyyyMMddHHmmss"))


def verified(files: DataFrame, sums: DataFrame) -> DataFrame:
    """files (path, content) with `valid`: whether the MD5 of the content is the one in the text of `path`.md5 (sums: path, content).

    Contents come as binaryFile reads them, so a file has at most 2 GB.
    """
    told = sums.select(F.regexp_replace("path", r"\.md5$", "").alias("path"), F.lower(F.regexp_extract(F.decode("content", "UTF-8"), r"\b([0-9a-fA-F]{32})\b", 1)).alias("expected"))
    # only paths and hashes are joined, then the few paths of the verdict meet the contents
    verdict = files.select("path", F.md5("content").alias("md5")).join(told, "path", "left").select("path", "expected", F.col("md5").eqNullSafe(F.col("expected")).alias("valid"))
    return files.join(verdict, "path")


MEMBER_BYTES = 16 << 20  # members are handed on whenever they are together larger than this


def members(content: bytes) -> Iterator[tuple[str, bytes]]:
    """(lower-case stem, bytes) of the XML files of a ZIP: its own, or, if it has none, those of the ZIPs inside."""
    with zipfile.ZipFile(io.BytesIO(content)) as outer:
        names = [n for n in outer.namelist() if not n.endswith("/")]
        plain = [n for n in names if n.lower().endswith(".xml")]
        for n in plain:
            yield n.rpartition("/")[2].rpartition(".")[0].lower(), outer.read(n)
        for n in [] if plain else [n for n in names if n.lower().endswith(".zip")]:
            with zipfile.ZipFile(io.BytesIO(outer.read(n))) as inner:
                for m in inner.namelist():
                    if m.lower().endswith(".xml"):
                        yield m.rpartition("/")[2].rpartition(".")[0].lower(), inner.read(m)


def unzipped(archives: DataFrame) -> DataFrame:
    """(path, archive_id, content) of every XML member of binary ZIP files; a broken archive gives no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                held, size = [], 0
                try:
                    for stem, own in members(bytes(content)):
                        held.append((path, stem, own))
                        size += len(own)
                        if size > MEMBER_BYTES:
                            yield pd.DataFrame(held, columns=["path", "archive_id", "content"])
                            held, size = [], 0
                except zipfile.BadZipFile:
                    pass
                if held:
                    yield pd.DataFrame(held, columns=["path", "archive_id", "content"])

    return archives.select("path", "content").mapInPandas(run, "path string, archive_id string, content binary")


def daily_names(spark: SparkSession, start: str, end: str, prefix: str = "dm_spl_daily_update_") -> DataFrame:
    """(day, name): the archive of each day from start to end; none if end comes before start."""
    days = spark.range(1).select(F.explode(F.when(F.lit(end) >= F.lit(start), F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end))))).alias("day"))
    return days.withColumn("name", F.concat(F.lit(prefix), F.date_format("day", "MMddyyyy"), F.lit(".zip")))


def published(names: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of names (name, ...) that a listing (path, ...) has, with their path."""
    there = listed.select(F.substring_index("path", "/", -1).alias("name"), "path")
    return names.join(there, "name")


def member_root(c: Column) -> Column:
    """The first folder of a member's path, in lower case; '' if there is none."""
    return F.when(F.contains(c, F.lit("/")), F.lower(F.substring_index(c, "/", 1))).otherwise("")


def allowed_members(rows: DataFrame, path: str, roots: list[str]) -> DataFrame:
    """Rows in one of the folders, or all rows if none is."""
    inside = member_root(F.col(path)).isin(roots)
    found = rows.filter(inside).limit(1).count() > 0
    return rows.filter(inside) if found else rows
