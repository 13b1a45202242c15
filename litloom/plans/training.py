"""The queries of the general training-data operators: schema drift and nested records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import drift, nested
from litloom.runtime import materialize, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# 4. Schemas that drift between files


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each change of a feed's schema, with the file where it takes effect."""
    return drift.changes(table(spark, folder, "feed_records"))


@query
def p4_canonical_names(spark: SparkSession, folder: str) -> DataFrame:
    """The column of the one table that each file's field goes to."""
    return drift.canonical_names(table(spark, folder, "feed_records"))


@query
def p4_table(spark: SparkSession, folder: str) -> DataFrame:
    """All records of all files in one consistent table."""
    records = table(spark, folder, "feed_records")
    return drift.consistent_table(records, "rec_no", materialize(drift.canonical_names(records), "names"))


# 7. Deeply nested records


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each non-null child of the array levels that its SQL names, with the places that lead back to its parent; the other level of the JSON text is p7_parser_steps."""
    pmc, pubmed = table(spark, folder, "pmc_articles"), table(spark, folder, "pubmed_articles")
    content, mesh = nested.child_tables(pmc, "record_no", "content"), nested.child_tables(pubmed, "record_no", "mesh_terms")
    named = [("section", content["content.sections"]), ("table", content["content.tables"]), ("footnote", content["content.tables.footnotes"]), ("mesh_term", mesh["mesh_terms"]), ("qualifier", mesh["mesh_terms.qualifiers"]), ("warning", _metadata(spark, folder, "extraction_metadata.warnings"))]
    return reduce(DataFrame.unionByName, [nested.links(rows, kind) for kind, rows in named])


@query
def p7_sections(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_tables(table(spark, folder, "pmc_articles"), "record_no", "content")["content.sections"]


@query
def p7_tables(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_tables(table(spark, folder, "pmc_articles"), "record_no", "content")["content.tables"]


@query
def p7_footnotes(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_tables(table(spark, folder, "pmc_articles"), "record_no", "content")["content.tables.footnotes"]


@query
def p7_mesh_terms(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_tables(table(spark, folder, "pubmed_articles"), "record_no", "mesh_terms")["mesh_terms"]


@query
def p7_qualifiers(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_tables(table(spark, folder, "pubmed_articles"), "record_no", "mesh_terms")["mesh_terms.qualifiers"]


def _metadata(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """One table of extraction_metadata; a level that no record has is an empty table of links."""
    pmc = table(spark, folder, "pmc_articles")
    found = nested.json_tables(pmc, "record_no", "extraction_metadata")
    return found[path] if path in found else nested.child_table(pmc, "record_no", F.lit(None).cast("array<string>"), path).drop("item")


@query
def p7_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The members of extraction_metadata that are not lists, one row for each record."""
    return _metadata(spark, folder, "extraction_metadata")


@query
def p7_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """extraction_metadata.warnings, one row each, the members as columns."""
    return _metadata(spark, folder, "extraction_metadata.warnings")


@query
def p7_parser_steps(spark: SparkSession, folder: str) -> DataFrame:
    """extraction_metadata.parser.steps, one row each."""
    return _metadata(spark, folder, "extraction_metadata.parser.steps")


@query
def p7_json_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The merged schema of extraction_metadata."""
    return table(spark, folder, "pmc_articles").select(F.schema_of_variant_agg(F.try_parse_json("extraction_metadata")).alias("merged_schema"))


def _level(table_name: str, lists: str, path: str, fields: str) -> str:
    cols = "".join(f", x.{f} as {f}" for f in fields.split())
    return f"""select record_no, record_no::varchar as parent_key, concat(record_no, '/{path}/', p) as row_key, -1 as parent_pos, p::int as child_pos{cols}
from (select record_no, unnest({lists}) as x, unnest(range(len({lists}))) as p from {table_name}) where x is not null"""


def _inner(table_name: str, lists: str, path: str, inner: str, cols: str) -> str:
    return f"""select record_no, concat(record_no, '/{path}/', p) as parent_key, concat(record_no, '/{path}/', p, '/{path}.{inner}/', q) as row_key, p::int as parent_pos, q::int as child_pos{cols}
from (select record_no, p, unnest(x.{inner}) as y, unnest(range(len(x.{inner}))) as q from (select record_no, unnest({lists}) as x, unnest(range(len({lists}))) as p from {table_name})) where y is not null"""


SQL["p7_sections"] = _level("pmc_articles", "content.sections", "content.sections", "type id title content")
SQL["p7_tables"] = _level("pmc_articles", "content.tables", "content.tables", "id location label caption_title caption_text content")
SQL["p7_footnotes"] = _inner("pmc_articles", "content.tables", "content.tables", "footnotes", ", y as value")
SQL["p7_mesh_terms"] = _level("pubmed_articles", "mesh_terms", "mesh_terms", "descriptor descriptor_ui major_topic type")
SQL["p7_qualifiers"] = _inner("pubmed_articles", "mesh_terms", "mesh_terms", "qualifiers", ", y.name as name, y.ui as ui, y.major_topic as major_topic")
_WARNING = """select record_no, json_extract(w, '$[' || q || ']') as x, q as p from (
  select record_no, w, unnest(range(json_array_length(w)::bigint)) as q from (
    select record_no, case json_type(try_cast(extraction_metadata as json), '$.warnings') when 'ARRAY' then json_extract(try_cast(extraction_metadata as json), '$.warnings')
      when 'OBJECT' then json_array(json_extract(try_cast(extraction_metadata as json), '$.warnings')) end as w from pmc_articles) where w is not null)"""
SQL["p7_found"] = " union all ".join(
    [f"select '{k}' as child_kind, record_no, parent_pos, child_pos from ({SQL[q]})" for k, q in (("section", "p7_sections"), ("table", "p7_tables"), ("footnote", "p7_footnotes"), ("mesh_term", "p7_mesh_terms"), ("qualifier", "p7_qualifiers"))]
    + [f"select 'warning', record_no, -1, p::int from ({_WARNING}) where json_type(x) <> 'NULL'"]
)

_LINKED = "record_no, record_no::varchar as parent_key, concat(record_no, '/extraction_metadata.{path}/', p) as row_key, -1 as parent_pos, p::int as child_pos"
SQL["p7_warnings"] = f"""select {_LINKED.format(path='warnings')}, x->>'$.code' as code, try_cast(x->>'$.where.section' as bigint) as where_section,
  try_cast(x->>'$.where.table.col' as bigint) as where_table_col, try_cast(x->>'$.where.table.row' as bigint) as where_table_row from ({_WARNING}) where json_type(x) <> 'NULL'"""
SQL["p7_parser_steps"] = f"""select {_LINKED.format(path='parser.steps')}, try_cast(x->>'$.ms' as bigint) as ms, x->>'$.step' as step from (
  {_WARNING.replace('$.warnings', '$.parser.steps')}) where json_type(x) <> 'NULL'"""
