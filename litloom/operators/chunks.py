"""Chunk payloads of abstracts and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.functions import classify, ids, tables
from litloom.functions.text import chunked

LEAN_DROPS = ["token_count", "source_family", "full_section_text", "full_text", "text_preview"]


def abstract_chunks(articles: DataFrame, lean: bool = False, size: int = 1536, stride: int = 1344) -> DataFrame:
    """One row for each chunk of title and abstract; texts under 50 characters give none, list columns stay on the first chunk.

    White space is collapsed by the chunker, so the abstract of a chunk is its whole text.
    """
    text = F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")), F.lit("\n\nAbstract: "), F.coalesce("abstract", F.lit("")))
    rows = chunked(articles.select("record_no", "pmid", "title", "journal", "year", "mesh_terms_flat", "keywords_flat", "publication_types_flat", text.alias("_text")).filter(F.length("_text") >= 50), "_text", size, stride)
    pmid = F.trim("pmid")
    first = F.col("chunk_index") == 0
    chunk = F.when(F.col("total_chunks") == 1, F.concat(pmid, F.lit("_abstract"))).otherwise(F.concat(pmid, F.lit("_abstract_chunk_"), F.col("chunk_index").cast("string")))
    out = rows.select(
        "record_no", ids.uuid5(F.concat(F.lit("pubmed:"), chunk)).alias("id"), pmid.alias("doc_id"), chunk.alias("chunk_id"), "chunk_index", "total_chunks",
        F.when(first, F.col("title")).otherwise(F.concat(F.coalesce("title", F.lit("")), F.lit(" (cont.)"))).alias("title"), F.col("chunk_text").alias("page_content"), F.col("chunk_text").alias("abstract"),
        F.substring("chunk_text", 1, 500).alias("text_preview"), "token_count", ids.section_id(pmid, F.lit("abstract")).alias("section_id"), F.greatest(F.lit(0.0), F.round(F.lit(1.0) - F.col("chunk_index") * F.lit(0.05), 4)).alias("section_weight"),
        *(F.when(first, F.col(c)).alias(c) for c in ("mesh_terms_flat", "keywords_flat", "publication_types_flat")), "journal", "year",
    )
    return out.drop(*LEAN_DROPS) if lean else out


def label_chunks(labels: DataFrame, size: int = 1536, stride: int = 1344) -> DataFrame:
    """One row for each chunk of a label's sections, all prose before all tables; sections under 50 characters without tables give none."""
    each = labels.select("record_no", "set_id", "drug_name", F.posexplode("sections").alias("section_pos", "s")).filter("s is not null")
    text, found = F.coalesce(F.col("s.text"), F.lit("")), F.coalesce(F.col("s.tables"), F.array().cast("array<struct<index:int,content:string,type:string>>"))
    kept = each.filter((F.length(text) >= 50) | (F.size(found) > 0)).withColumn("label", F.coalesce("s.title", "s.key"))
    head = lambda tail: F.concat(F.lit("# "), F.coalesce("drug_name", F.lit("")), F.lit(" - "), F.coalesce("label", F.lit("")), tail)
    columns = ["record_no", "set_id", "section_pos", "table_pos", F.col("s.key").alias("section"), "_text", "_weight"]
    prose = kept.filter(F.length(text) > 0).withColumns({"table_pos": F.lit(-1), "_text": head(F.concat(F.lit("\n\n"), text)), "_weight": classify.weight(F.col("s.key"), tables.LABEL_WEIGHTS, 0.7)}).select(*columns)
    tabular = kept.select("*", F.posexplode(found).alias("table_pos", "t")).filter("t.content is not null").withColumns({"_text": head(F.concat(F.lit(" Table\n\n"), F.col("t.content"))), "_weight": F.lit(0.75)}).select(*columns)
    rows = chunked(prose.unionByName(tabular), "_text", size, stride)
    where = F.concat_ws("_", "set_id", "section", F.when(F.col("table_pos") >= 0, F.concat(F.lit("table_"), F.col("table_pos").cast("string"))), F.concat(F.lit("part"), F.col("chunk_index").cast("string")))
    return rows.select("record_no", where.alias("chunk_id"), ids.uuid5(F.concat(F.lit("dailymed:"), where)).alias("id"), "section", "section_pos", "table_pos", (F.col("table_pos") >= 0).cast("int").alias("is_table"), "chunk_index", "total_chunks", F.col("chunk_text").alias("page_content"), "token_count", F.col("_weight").alias("section_weight"))


def article_chunks(articles: DataFrame, size: int = 1536, stride: int = 1344) -> DataFrame:
    """One row for each chunk of a full-text article (document_id, title, abstract, journal, year, sections, tables).

    The abstract comes first, then the sections that are not left out (see classify.is_left_out), then the tables with their
    captions; texts under 50 characters give none. An article without any of these gives no rows.
    """
    head = lambda *tail: F.concat(F.lit("# "), F.coalesce("title", F.lit("")), *tail)
    part = lambda kind, title, ident, text, table: F.struct(kind.alias("kind"), F.coalesce(title, F.lit("")).alias("section_title"), ident.alias("ident"), text.alias("text"), F.lit(table).alias("is_table"))
    abstract = F.array(part(F.lit("abstract"), F.lit("Abstract"), F.lit("abstract"), F.coalesce("abstract", F.lit("")), 0))
    none = F.array().cast("array<struct<kind:string,section_title:string,ident:string,text:string,is_table:int>>")
    prose = F.transform(F.filter("sections", lambda s: s.isNotNull() & ~F.coalesce(classify.is_left_out(s["type"], s["title"]), F.lit(False))), lambda s: part(s["type"], s["title"], s["id"], F.coalesce(s["content"], F.lit("")), 0))
    caption = lambda t: F.concat_ws(" ", F.nullif(t["label"], F.lit("")), F.nullif(t["caption_title"], F.lit("")), F.nullif(t["caption_text"], F.lit("")))
    tabular = F.transform(F.filter("tables", lambda t: t.isNotNull() & (F.length(t["content"]) > 0)), lambda t: part(F.lit("table"), caption(t), t["id"], F.concat(caption(t), F.lit("\n\n"), t["content"]), 1))
    parts = F.concat(abstract, F.coalesce(prose, none), F.coalesce(tabular, none))
    each = articles.select("document_id", "title", "journal", "year", F.posexplode(parts).alias("section_pos", "p")).filter(F.length("p.text") >= 50)
    rows = chunked(each.withColumn("_text", head(F.lit(" - "), F.col("p.section_title"), F.lit("\n\n"), F.col("p.text"))), "_text", size, stride)
    where = F.concat_ws("_", "document_id", F.col("section_pos").cast("string"), F.coalesce("p.ident", F.lit("")), F.concat(F.lit("part"), F.col("chunk_index").cast("string")))
    return rows.select(
        ids.uuid5(F.concat(F.lit("pmc:"), where)).alias("id"), F.col("document_id").alias("doc_id"), where.alias("chunk_id"), "title", "journal", "year", F.col("p.kind").alias("section_type"), F.col("p.section_title").alias("section_title"),
        ids.section_id(F.col("document_id"), F.col("p.section_title")).alias("section_id"), (F.col("p.is_table") == 1).alias("is_table"), "chunk_index", "total_chunks", F.col("chunk_text").alias("page_content"), "token_count",
        F.when(F.col("p.is_table") == 1, F.lit(0.75)).otherwise(classify.weight(F.col("p.kind"))).alias("section_weight"),
    )
