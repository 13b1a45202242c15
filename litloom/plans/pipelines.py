"""From files to vectors: compositions of sources, filters, chunks, embedding and an upsert table.

Cheap column filters and anti-joins come before every Python stage. A run that is repeated takes only what is not done.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.config import Config
from litloom.functions import classify, ids
from litloom.operators import chunks, incremental
from litloom.operators.embed import Provider, embedded, hash_embedding
from litloom.runtime import drop, materialize
from litloom.sources import files, jats, pubmed, spl
from litloom.sources.checkpoint import Checkpoint
from litloom.sources.sink import Table
from litloom.streaming.ingest import run_available


def wanted_articles(articles: DataFrame, config: Config) -> DataFrame:
    """Articles of the wanted years, with title and abstract and of a wanted type unless config lets others through, with evidence and agencies."""
    kept = articles.filter(F.col("year") >= config.min_year)
    if config.need_title:
        kept = kept.filter(F.col("title") != "")
    if config.need_abstract:
        kept = kept.filter(F.length("abstract") >= config.min_abstract)
    if config.only_target_types:
        kept = kept.filter(classify.is_target(F.col("publication_types_flat")))
    agencies = classify.agencies(F.col("affiliations"), F.col("grant_agencies"))
    kind = F.coalesce(classify.publication_type(F.col("publication_types_flat")), F.lit("journal_article"))
    return kept.withColumns({"article_type": kind, "evidence": classify.evidence(kind, F.col("publication_types_flat"), F.col("abstract")), "gov_agencies": agencies, "is_gov_affiliated": F.size(agencies) > 0})


def pubmed_points(articles: DataFrame, config: Config, provider: Provider) -> DataFrame:
    rows = chunks.abstract_chunks(articles.withColumn("record_no", F.xxhash64("pmid")), config.lean_payload, config.chunk_words, config.stride_words)
    return embedded(rows, "page_content", "vector", provider, config.embed_batch)


def pubmed_update(spark: SparkSession, folder: str, table: Table, checkpoint: str, config: Config | None = None, provider: Provider | None = None) -> None:
    """Files of PubMed XML that have come since the last run: parsed, filtered, cut, embedded, upserted; a file counts as done after its batch is written."""
    config, provider = config or Config.of(), provider or hash_embedding()
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.xml*").option("maxFilesPerTrigger", 64).load(folder)

    def each(batch: DataFrame, _: int) -> None:
        found = pubmed.read(batch.repartition(max(1, batch.sparkSession.sparkContext.defaultParallelism)))
        table.upsert(pubmed_points(wanted_articles(found, config), config, provider))

    run_available(stream, checkpoint, each)


def pmc_articles(inventory: DataFrame, done: DataFrame, fetched: DataFrame, config: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles, dead letters): inventory rows that are open and not done, joined with their fetched files (metadata_key, path, content), then parsed. Only the key tells whether a row is done, not its etag."""
    config = config or Config.of()
    source = F.when(F.col("is_pmc_openaccess"), "pmc_oa").when(F.col("is_manuscript"), "pmc_manuscript")
    key = ids.checkpoint_key_of(source, F.col("metadata_key"), F.col("etag"))
    new = incremental.not_done(inventory.filter(source.isNotNull()), F.col("metadata_key"), done)
    kept, dead = incremental.split_by_reason(new, classify.skip_reason(F.col("is_pmc_openaccess"), F.col("license"), source), key, "metadata filter")
    # several deliveries of a key are one article, told by the last etag
    named = kept.withColumn("key", key).groupBy("metadata_key").agg(F.max("key").alias("key"))
    parsed = jats.read(fetched.join(named, "metadata_key"), carry="key", need_pmid=config.need_pmid, need_open=config.need_open_access, need_commercial=config.need_commercial)
    good, bad = incremental.split_by_reason(parsed, F.col("skip_reason"), F.col("key"), "parse")
    lost = kept.select("metadata_key").distinct().join(fetched.select("metadata_key"), "metadata_key", "left_anti").select(F.col("metadata_key").alias("key"), F.lit("xml download").alias("stage"), F.lit("no file was fetched").alias("reason"))
    return good.drop("skip_reason"), dead.unionByName(bad).unionByName(lost)


def article_points(articles: DataFrame, config: Config, provider: Provider) -> DataFrame:
    rows = chunks.article_chunks(articles.withColumn("journal", F.col("journal")["title"]), config.chunk_words, config.stride_words)
    return embedded(rows, "page_content", "vector", provider, config.embed_batch)


#: Stages after which trying again gives the same.
FINAL = ["metadata filter", "parse"]


def pmc_update(inventory: DataFrame, fetched: DataFrame, table: Table, checkpoint: Checkpoint, config: Config | None = None, provider: Provider | None = None) -> dict[str, int]:
    """A run over full text: inventory (metadata_key, etag, last_modified, is_pmc_openaccess, is_manuscript, license) and fetched files to chunks, vectors and the table.

    Keys count as done, and the high-watermark moves, only after the table is written; what was dropped is logged with its
    stage, and not tried again if its stage is final. A run that dies in between is simply made again.
    """
    config, provider = config or Config.of(), provider or hash_embedding()
    new = inventory
    if "last_modified" in inventory.columns:
        high = checkpoint.high("pmc")
        new = inventory.filter(high.isNull() | (F.col("last_modified").cast("timestamp") > high))
    done = checkpoint.done().unionByName(checkpoint.final(FINAL)).filter(F.col("key").startswith("pmc_")).select(F.split_part("key", F.lit(":"), F.lit(2)).alias("key"))
    good, dead = pmc_articles(new, done, fetched, config)
    good = materialize(good, "articles")
    written = table.upsert(article_points(good, config, provider))
    checkpoint.log(dead)
    checkpoint.add(good, "key")
    if "last_modified" in inventory.columns:
        checkpoint.advance("pmc", inventory.agg(F.max("last_modified")))
    out = {"articles": good.count(), "points": written}
    drop(good)
    return out


def label_points(archives: DataFrame, done: DataFrame, config: Config | None = None, provider: Provider | None = None) -> DataFrame:
    """Vectors of the labels in ZIP archives: members done already are left out before they are parsed, labels done already after."""
    config, provider = config or Config.of(), provider or hash_embedding()
    members = incremental.not_done(files.unzipped(archives), F.col("archive_id"), done)
    labels = spl.read(members).filter("status = 'ok'")
    new = incremental.not_done(labels, F.col("set_id"), done).withColumn("record_no", F.xxhash64("set_id"))
    return embedded(chunks.label_chunks(new, config.chunk_words, config.stride_words), "page_content", "vector", provider, config.embed_batch)


def label_update(archives: DataFrame, table: Table, checkpoint: Checkpoint, config: Config | None = None, provider: Provider | None = None) -> int:
    """A run over label archives: what is new goes to the table, then its members and set ids count as done. Gives the points written."""
    config, provider = config or Config.of(), provider or hash_embedding()
    members = incremental.not_done(files.unzipped(archives), F.col("archive_id"), checkpoint.done())
    labels = materialize(incremental.not_done(spl.read(members, carry="archive_id"), F.col("set_id"), checkpoint.done()), "labels")
    good = labels.filter("status = 'ok'").withColumn("record_no", F.xxhash64("set_id"))
    points = embedded(chunks.label_chunks(good, config.chunk_words, config.stride_words), "page_content", "vector", provider, config.embed_batch)
    written = table.upsert(points)
    checkpoint.log(labels.filter("status <> 'ok'").select(F.col("archive_id").alias("key"), F.lit("parse").alias("stage"), F.col("status").alias("reason")))
    checkpoint.add(good.select(F.explode(F.array("archive_id", "set_id")).alias("key")), "key")
    drop(labels)
    return written


def weekly_update(runs: dict[str, Callable[[], object]], skip: Sequence[str] = ()) -> dict[str, dict[str, object]]:
    """Run the updates one after the other: for each its result, its seconds, or the error that ended it. One that fails doesn't keep the others from running."""
    out: dict[str, dict[str, object]] = {}
    for name, run in runs.items():
        if name in skip:
            out[name] = {"state": "skipped"}
            continue
        began = time.monotonic()
        try:
            out[name] = {"state": "done", "result": run()}
        except Exception as e:
            out[name] = {"state": "failed", "error": f"{type(e).__name__}: {e}"}
        out[name]["seconds"] = round(time.monotonic() - began, 3)
    return out
