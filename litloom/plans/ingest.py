"""The ingestion queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from litloom.functions import classify, ids, tables
from litloom.functions import text as texts
from litloom.operators import batching, chunks, incremental
from litloom.operators.embed import embedded, hash_embedding
from litloom.runtime import WHITESPACE, table
from litloom.sources import files, sink

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _literal(v) -> str:
    return "null" if v is None else "[" + ", ".join(map(_literal, v)) + "]" if isinstance(v, list) else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def _sql_values(rows: list[tuple], names: str) -> str:
    return "(select * from (values " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + f") v({names}))"


def _sql_map(column: str, pairs: dict, default: str) -> str:
    return f"case {column} " + " ".join(f"when {_literal(k)} then {_literal(v)}" for k, v in pairs.items()) + f" else {default} end"


WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{WS}'), lambda x: x <> '')"


def _sql_uuid5(c: str) -> str:
    h = f"sha1(from_hex('{ids.DNS}') || ({c})::blob)"
    return f"lower(concat(substr({h},1,8),'-',substr({h},9,4),'-5',substr({h},14,3),'-',substr('89ab',(('0x'||substr({h},17,1))::int % 4)+1,1),substr({h},18,3),'-',substr({h},21,12)))"


# Chunks, tokens, identifiers


def _sql_chunks(source: str, size: int, stride: int, extra: str) -> str:
    return f"""with s as ({source}), w as (select *, {_words("_text")} as w from s), k as (select *, unnest(range(0, len(w), {stride})) as o from w where len(w) > 0)
select {extra}, (o // {stride})::int as chunk_index, ((len(w) + {stride - 1}) // {stride})::int as total_chunks, array_to_string(w[o + 1:o + {size}], ' ') as chunk_text, ((4 * len(w[o + 1:o + {size}])) // 3)::int as token_count from k"""


@query(_sql_chunks("select doc_id, text as _text from documents", 1536, 1344, "doc_id"))
def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    return texts.chunked(table(spark, folder, "documents").select("doc_id", "text"), "text").drop("text")


@query(_sql_chunks("select doc_id, text as _text from documents", 48, 36, "doc_id"))
def chunk_small_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return texts.chunked(table(spark, folder, "documents").select("doc_id", "text"), "text", 48, 36).drop("text")


_ABSTRACT = "concat(trim(pmid), case when total_chunks = 1 then '_abstract' else '_abstract_chunk_' || chunk_index end)"


@query(f"""with a as ({_sql_chunks("select record_no, pmid, concat('Title: ', coalesce(title, ''), chr(10), chr(10), 'Abstract: ', coalesce(abstract, '')) as _text from pubmed_articles where pmid is not null and length(concat('Title: ', coalesce(title, ''), '  Abstract: ', coalesce(abstract, ''))) >= 50", 96, 84, "record_no, pmid")})
select record_no, {_ABSTRACT} as chunk_id, {_sql_uuid5(f"'pubmed:' || {_ABSTRACT}")} as id, chunk_index, total_chunks, chunk_text as page_content, left(chunk_text, 500) as text_preview, token_count, left(sha256(concat(trim(pmid), ':abstract')), 16) as section_id, greatest(0, round(1 - chunk_index * 0.05::double, 4)) as section_weight from a""")
def abstract_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = chunks.abstract_chunks(table(spark, folder, "pubmed_articles").filter("pmid is not null"), size=96, stride=84)
    return rows.select("record_no", "chunk_id", "id", "chunk_index", "total_chunks", "page_content", "text_preview", "token_count", "section_id", "section_weight")


_LEAN = _sql_chunks("select record_no, pmid, title as own_title, journal, year, mesh_terms_flat as m, keywords_flat as k, publication_types_flat as p, concat('Title: ', coalesce(title, ''), chr(10), chr(10), 'Abstract: ', coalesce(abstract, '')) as _text from pubmed_articles where length(concat('Title: ', coalesce(title, ''), '  Abstract: ', coalesce(abstract, ''))) >= 50", 1536, 1344, "record_no, pmid, own_title, journal, year, m, k, p")
_LEAN_ID = "trim(pmid) || case when total_chunks = 1 then '_abstract' else '_abstract_chunk_' || chunk_index end"


@query(f"""with a as ({_LEAN})
select record_no, case when pmid is not null then {_sql_uuid5(f"'pubmed:' || {_LEAN_ID}")} end as id, trim(pmid) as doc_id, {_LEAN_ID} as chunk_id, chunk_index, total_chunks, case when chunk_index = 0 then own_title else coalesce(own_title, '') || ' (cont.)' end as title, chunk_text as page_content, chunk_text as abstract,
left(sha256(trim(pmid) || ':abstract'), 16) as section_id, greatest(0, round(1 - chunk_index * 0.05::double, 4)) as section_weight, case when chunk_index = 0 then m end as mesh_terms_flat, case when chunk_index = 0 then k end as keywords_flat, case when chunk_index = 0 then p end as publication_types_flat, journal, year from a""")
def lean_projection(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.abstract_chunks(table(spark, folder, "pubmed_articles"), lean=True)


_LABEL = """select record_no, set_id, section_pos, -1 as table_pos, s.key as section, concat('# ', coalesce(drug_name, ''), ' - ', coalesce(s.title, s.key, ''), chr(10), chr(10), s.text) as _text from e where s is not null and length(s.text) > 0 and (length(s.text) >= 50 or len(s.tables) > 0)
union all select record_no, set_id, section_pos, p::int, key, concat('# ', coalesce(drug_name, ''), ' - ', coalesce(title, key, ''), ' Table', chr(10), chr(10), t.content) from (select record_no, set_id, drug_name, section_pos, s.key as key, s.title as title, unnest(s.tables) as t, unnest(range(len(s.tables))) as p from e where s is not null and (length(s.text) >= 50 or len(s.tables) > 0)) where t.content is not null"""


@query(f"""with e as (select record_no, set_id, drug_name, unnest(sections) as s, unnest(range(len(sections)))::int as section_pos from dailymed_labels),
c as ({_sql_chunks(_LABEL, 256, 224, "record_no, set_id, section_pos, table_pos, section")}),
n as (select *, concat_ws('_', set_id, section, case when table_pos >= 0 then 'table_' || table_pos end, 'part' || chunk_index) as chunk_id from c)
select record_no, chunk_id, {_sql_uuid5("'dailymed:' || chunk_id")} as id, section, section_pos, table_pos, (table_pos >= 0)::int as is_table, chunk_index, total_chunks, chunk_text as page_content, token_count,
case when table_pos >= 0 then 0.75 else {_sql_map("lower(section)", tables.LABEL_WEIGHTS, "0.7")} end::double as section_weight from n""")
def label_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.label_chunks(table(spark, folder, "dailymed_labels"), 256, 224)


@query(f"select doc_id, ((4 * len({_words('text')})) // 3)::int as tokens from documents")
def token_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", texts.token_estimate(texts.tokens_of("text")).alias("tokens"))


@query(f"""with c as (select doc_id, left(text, 2000) as t, {_words("left(text, 2000)")} as w from documents)
select doc_id, case when greatest(1, (4 * len(w)) // 3) > 250 then array_to_string(w[1:180], ' ') else t end as shaped from c""")
def shape_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", texts.shaped(F.col("text"), 2000, 250, 180).alias("shaped"))


@query(f"select doc_id, {_sql_uuid5("'pubmed:' || doc_id || '_abstract'")} as point_id from documents")
def point_ids_uuid5(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", ids.uuid5(F.concat(F.lit("pubmed:"), F.col("doc_id").cast("string"), F.lit("_abstract"))).alias("point_id"))


@query("select doc_id, left(sha256(concat(doc_id, ':', lower(trim(title)))), 16) as section_id from documents where title is not null")
def section_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("title is not null").select("doc_id", ids.section_id(F.col("doc_id").cast("string"), F.col("title")).alias("section_id"))


@query()
def shard_route(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of each inventory row, by the digest of its key."""
    rows = table(spark, folder, "pmc_inventory")
    token = ids.routing_token(F.col("metadata_key"), F.col("etag"), F.col("record_no"))
    return rows.select("record_no", ids.shard(token, 4).alias("shard"))


@query(f"""with recursive d as (select doc_id, doc_id // 10000 as block_no, coalesce((4 * len({_words('text')})) // 3, 0) as t, row_number() over (partition by doc_id // 10000 order by doc_id) as n from documents where doc_id is not null),
g as (select doc_id, block_no, n, 0 as batch_no, 1 as held, t as used from d where n = 1
  union all select d.doc_id, d.block_no, d.n, case when g.held >= 64 or g.used + d.t > 24000 then g.batch_no + 1 else g.batch_no end, case when g.held >= 64 or g.used + d.t > 24000 then 1 else g.held + 1 end, case when g.held >= 64 or g.used + d.t > 24000 then d.t else g.used + d.t end
  from g join d on d.block_no = g.block_no and d.n = g.n + 1)
select doc_id, block_no, batch_no from g""")
def greedy_token_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", texts.token_estimate(texts.tokens_of("text")).alias("tokens"))
    return batching.greedy_batches(rows, "doc_id", "tokens")


@query("select record_no, row_number() over (order by record_no) - 1 as row_no, (row_number() over (order by record_no) - 1) // 250 as batch_no from pmc_inventory")
def super_batches(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.batches(table(spark, folder, "pmc_inventory").select("record_no"), "record_no", 250)


# Classifiers

_TYPES = "list_transform(list_filter(coalesce(publication_types_flat, []), lambda t: t is not null and t <> ''), lambda t: trim(lower(t)))"


@query(f"select record_no, case {' '.join(f'when list_contains({_TYPES}, {_literal(k)}) then {_literal(v)}' for k, v in tables.PUBLICATION_TYPES.items())} end as article_type from pubmed_articles")
def publication_type_map(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pubmed_articles").select("record_no", classify.publication_type(F.col("publication_types_flat")).alias("article_type"))


@query(f"select record_no, year from pubmed_articles where list_has_any({_TYPES}, {_literal(list(tables.PUBLICATION_TYPES))}) and year >= 2015 and length(abstract) >= 50")
def article_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted type, recent enough, with an abstract: the year goes down to the scan."""
    rows = table(spark, folder, "pubmed_articles").filter("year >= 2015 and length(abstract) >= 50")
    return rows.filter(classify.is_target(F.col("publication_types_flat"))).select("record_no", "year")


def _sql_evidence(kind: str, types: str, text: str, rows: str) -> str:
    t = f"lower(coalesce({text}, ''))"
    term = lambda c: f"case {' '.join(f'when contains({c}, {_literal(p)}) then {_literal(g + p)}' for p, g in tables.EVIDENCE_TERMS)} end"
    has = lambda *p: "(" + " or ".join(f"contains({t}, '{x}')" for x in p) + ")"
    return f"""with k as (select *, replace(replace(lower(coalesce({kind}, '')), '_', '-'), ' ', '-') as k from {rows}),
e as (select *, {term("k")} as a, list_filter(list_transform(coalesce({types}, []), lambda p: {term("lower(p)")}), lambda x: x is not null)[1] as b,
 case when {has("systematic review", "meta-analysis", "meta analysis")} then 'Asystematic review' when {has("guideline")} then 'Aguideline' when {has("randomized controlled trial", "randomised controlled trial")} then 'Brandomized controlled trial'
 when {has("rct")} then 'Brct' when {has("randomized trial")} and {has("phase")} then 'Brandomized trial + phase' when {has("cohort study", "prospective study", "observational study")} then 'Ccohort study' end as c from k),
f as (select *, coalesce(a, b, c, case when k = 'news' then 'Dnews' else 'C' || k end) as m, case when a is not null then 'article_type' when b is not null then 'publication_type' when c is not null then 'abstract' else 'fallback' end as matched_from from e)
select record_no, left(m, 1) as grade, case left(m, 1) when 'A' then 1 when 'B' then 2 when 'C' then 3 else 4 end::int as level, nullif(substr(m, 2), '') as matched_term, matched_from from f"""


@query(_sql_evidence("null::varchar", "publication_types_flat", "abstract", "pubmed_articles"))
def evidence_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pubmed_articles")
    return rows.select("record_no", classify.evidence(F.lit(None).cast("string"), F.col("publication_types_flat"), F.col("abstract")).alias("e")).select("record_no", "e.*")


@query(_sql_evidence("article_type", "null::varchar[]", "abstract", "pmc_articles"))
def evidence_full_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pmc_articles")
    return rows.select("record_no", classify.evidence(F.col("article_type"), F.lit(None).cast("array<string>"), F.col("abstract")).alias("e")).select("record_no", "e.*")


@query(f"select grade, string_agg(term, '; ' order by term) as terms, count(*) as n from {_sql_values(tables.EVIDENCE_TERMS, 'term, grade')} group by grade")
def evidence_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    rows = _values(spark, tables.EVIDENCE_TERMS, "term string, grade string")
    return rows.groupBy("grade").agg(F.array_join(F.array_sort(F.collect_list("term")), "; ").alias("terms"), F.count("*").alias("n"))



_PHRASE = "case " + " ".join(f"when contains(lower(text), {_literal(p)}) then {_literal(a)}" for p, a in tables.AGENCY_PHRASES) + " end"
_GRANT = " or ".join(f"contains(lower(source), {_literal(t)})" for t in tables.GRANT_TOKENS)


@query(f"select doc_id, coalesce(array_to_string(list_sort(list_distinct(list_filter([{_PHRASE}, case when {_GRANT} then trim(source) end], lambda x: x is not null))), '; '), '') as agencies from documents")
def gov_affiliation(spark: SparkSession, folder: str) -> DataFrame:
    """Agencies named in any text, and sources that read like grants."""
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", F.array_join(classify.agencies(F.array("text"), F.array("source")), "; ").alias("agencies"))


_LICENSE = "case when contains(l, 'cc0') then 'cc0' when contains(l, 'by-nc') then 'cc-by-nc' when contains(l, 'by-sa') then 'cc-by-sa' when contains(l, 'by-nd') then 'cc-by-nd' when contains(l, 'cc by') or contains(l, 'cc-by') then 'cc-by' when contains(l, 'public domain') then 'cc0' else 'unknown' end"


@query(f"with r as (select record_no, lower(coalesce(license, '')) as l from pmc_inventory), n as (select record_no, {_LICENSE} as license_type from r) select *, not contains(license_type, 'nc') as commercial from n")
def license_types(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pmc_inventory").select("record_no", classify.license_type(F.col("license")).alias("license_type"))
    return rows.withColumn("commercial", classify.is_commercial(F.col("license_type")))


_MARKED = " or ".join(f"contains(lower(trim(license)), '{m}')" for m in tables.NON_COMMERCIAL)


@query(f"""with r as (select *, case when is_pmc_openaccess then 'pmc_oa' when is_manuscript then 'pmc_manuscript' end as source from pmc_inventory)
select record_no, source, case when source is null then 'source filter' when source = 'pmc_oa' and ({_MARKED}) then concat('metadata field license marks a non-commercial license (', license, ')') end as reason from r""")
def inventory_skip_reason(spark: SparkSession, folder: str) -> DataFrame:
    """Where a row comes from, and why it is not fetched."""
    source = F.when(F.col("is_pmc_openaccess"), "pmc_oa").when(F.col("is_manuscript"), "pmc_manuscript")
    rows = table(spark, folder, "pmc_inventory").select("record_no", source.alias("source"), "is_pmc_openaccess", "license")
    return rows.select("record_no", "source", F.when(F.col("source").isNull(), "source filter").otherwise(classify.skip_reason(F.col("is_pmc_openaccess"), F.col("license"), F.col("source"))).alias("reason"))


_SECTION = f"""with s as (select record_no, p::int as section_pos, x.type as type, x.title as title from (select record_no, unnest(structured_sections) as x, unnest(range(len(structured_sections))) as p from pmc_articles) where x is not null),
n as (select *, {_sql_map("lower(type)", tables.SECTION_TYPES, "'other'")} as m, lower(coalesce(title, '')) as t from s),
k as (select *, case when m <> 'other' then m {" ".join(f"when contains(t, '{p}') then '{v}'" for p, v in tables.TITLE_HINTS)} else 'other' end as section_type from n)
select record_no, section_pos, section_type, {_sql_map("section_type", tables.SECTION_WEIGHTS, "0.5")}::double as weight,
 lower(coalesce(type, '')) in ({", ".join(map(_literal, tables.EXCLUDED_SECTION_TYPES))}) or {" or ".join(f"contains(t, '{x}')" for x in tables.EXCLUDED_SECTION_TITLES)} as left_out from k"""


@query(_SECTION)
def section_types(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pmc_articles").select("record_no", F.posexplode(F.transform("structured_sections", lambda s: F.when(s.isNotNull(), F.struct(s["type"].alias("type"), s["title"].alias("title"))))).alias("section_pos", "s")).filter("s is not null")
    own = rows.withColumn("section_type", classify.section_type(F.col("s.type"), F.col("s.title")))
    return own.select("record_no", "section_pos", "section_type", classify.weight(F.col("section_type")).alias("weight"), classify.is_left_out(F.col("s.type"), F.col("s.title")).alias("left_out"))


@query(f"select record_no, trim(regexp_replace(coalesce(label_type_code, ''), '{WS}', ' ', 'g')) = '34391-3' or contains(lower(trim(regexp_replace(coalesce(label_type_display, ''), '{WS}', ' ', 'g'))), 'human prescription drug label') as is_rx from dailymed_labels")
def prescription_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "dailymed_labels").select("record_no", classify.is_prescription(F.col("label_type_code"), F.col("label_type_display")).alias("is_rx"))


ERRORS = [(1, 429, "slow down", "HTTPError", None), (2, None, "Error code: 503", "APIError", "2.5"), (3, None, "read timed out", "ReadTimeout", None), (4, 400, "bad request", "HTTPError", None), (5, None, "Too many requests", "X", "-1"), (6, None, None, "ConnectionError", "soon")]


@query("select * from (values (1, 'rate_limit', 4.0::double), (2, 'transient', 2.5), (3, 'transient', 2.0), (4, 'fatal', null), (5, 'rate_limit', 0.0), (6, 'transient', 2.0)) v(id, kind, wait)")
def retry_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = _values(spark, ERRORS, "id int, status int, message string, type string, retry_after string").withColumn("kind", classify.retry_kind(F.col("status"), F.col("message"), F.col("type")))
    return rows.select("id", "kind", classify.retry_wait(F.col("kind"), F.lit(2), F.col("retry_after")).alias("wait"))


# Incremental runs

_DONE = "select distinct trim(case when contains(line, ':') then case when split_part(trim(regexp_replace(line, '[\\t\\r\\n]', ' ', 'g')), ':', 1) = '{s}' then substr(line, instr(line, ':') + 1) end else trim(regexp_replace(line, '[\\t\\r\\n]', ' ', 'g')) end) as key from checkpoint_lines"


def _done(space: str) -> str:
    return f"select key from ({_DONE.format(s=space)}) where key <> ''"


@query(_done("pubmed"))
def checkpoint_keys(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.resolve_lines(table(spark, folder, "checkpoint_lines"), "line", "pubmed")


@query(f"select record_no, pmid from pubmed_articles a where not exists (select 1 from ({_done('pubmed')}) d where d.key = trim(a.pmid))")
def checkpoint_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    done = incremental.resolve_lines(table(spark, folder, "checkpoint_lines"), "line", "pubmed")
    return incremental.not_done(table(spark, folder, "pubmed_articles").select("record_no", "pmid"), F.trim("pmid"), done)


@query("select record_no, metadata_key from pmc_inventory where metadata_key not in (select distinct split_part(line, ':', 2) from checkpoint_lines where split_part(line, ':', 1) in ('pmc_oa', 'pmc_manuscript'))")
def completed_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Rows not yet done. Only the key counts: a new etag of a done key does not bring it back."""
    lines = table(spark, folder, "checkpoint_lines")
    done = lines.filter(F.split_part("line", F.lit(":"), F.lit(1)).isin("pmc_oa", "pmc_manuscript")).select(F.split_part("line", F.lit(":"), F.lit(2)).alias("key")).distinct()
    return incremental.not_done(table(spark, folder, "pmc_inventory").filter("metadata_key is not null").select("record_no", "metadata_key"), F.col("metadata_key"), done)


@query("select record_no, pmid from (select *, row_number() over (partition by pmid order by record_no) as n from pubmed_articles) where n = 1 or pmid is null or trim(pmid) = ''")
def keep_first_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.keep_first(table(spark, folder, "pubmed_articles").select("record_no", "pmid"), "pmid", "record_no")


@query("select set_id, max(record_no) as record_no from dailymed_labels group by set_id")
def newest_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.newest(table(spark, folder, "dailymed_labels").select("set_id", "record_no"), "set_id", "record_no")


@query("select record_no from pmc_inventory where last_modified > timestamp '2026-01-01 00:00:00'")
def incremental_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    """What changed after the last run; the comparison goes down to the scan."""
    return incremental.since(table(spark, folder, "pmc_inventory"), "last_modified", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")).select("record_no")


@query("select is_pmc_openaccess, count(*) as n, max(last_modified) as high_watermark from pmc_inventory group by is_pmc_openaccess")
def running_max_state(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pmc_inventory").groupBy("is_pmc_openaccess").agg(F.count("*").alias("n"), F.max("last_modified").alias("high_watermark"))


@query("select distinct file_name from feed_records order by file_name desc limit 20")
def newest_n_files(spark: SparkSession, folder: str) -> DataFrame:
    return files.pick(table(spark, folder, "feed_records").select("file_name").distinct(), "file_name", 20)


@query("select d::date as day, 'dm_spl_daily_update_' || strftime(d, '%m%d%Y') || '.zip' as name from generate_series(timestamp '2026-02-26', timestamp '2026-03-03', interval 1 day) t(d)")
def date_range_expand(spark: SparkSession, folder: str) -> DataFrame:
    return files.daily_names(spark, "2026-02-26", "2026-03-03")


@query("select case when contains(xml_url, '/') then lower(split_part(xml_url, '/', 1)) else '' end as root, count(*) as n from pmc_inventory where xml_url is not null group by all")
def member_root_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pmc_inventory").filter("xml_url is not null").groupBy(files.member_root(F.col("xml_url")).alias("root")).agg(F.count("*").alias("n"))


@query("select record_no from pmc_inventory where xml_url is not null")
def member_root_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """No member lies in the wanted folder, so all are taken."""
    return files.allowed_members(table(spark, folder, "pmc_inventory").filter("xml_url is not null").select("record_no", "xml_url"), "xml_url", ["prescription"]).select("record_no")


@query("select year, count(*) * 1000 as estimated from (select year, row_number() over (order by record_no) as n from pubmed_articles) where n % 1000 = 1 group by year")
def systematic_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Every thousandth record, scaled up, by year: the feature is the sample."""
    rows = incremental.batches(table(spark, folder, "pubmed_articles").select("record_no", "year"), "record_no", 1000)
    return rows.filter("row_no % 1000 = 0").groupBy("year").agg((F.count("*") * 1000).alias("estimated"))


_SAMPLED = "select *, row_number() over (order by record_no) as n from pubmed_articles"


@query(f"""with s as ({_SAMPLED})
select 'all' as kind, '' as value, count(*) as estimated from pubmed_articles
union all select 'year', coalesce(year::varchar, 'unknown'), count(*) * 1000 from s where n % 1000 = 1 group by 2
union all select 'source', coalesce(source, 'unknown'), count(*) * 1000 from s where n % 1000 = 1 group by 2""")
def verify_output(spark: SparkSession, folder: str) -> DataFrame:
    """Total, and estimates by year and source from every thousandth record: the feature is the sample."""
    return incremental.verified_output(table(spark, folder, "pubmed_articles"), "record_no", ["year", "source"])


@query("select event_id, count(*) over (order by ts range between interval 10 seconds preceding and current row) as requests from events where ts is not null")
def request_rate_10s(spark: SparkSession, folder: str) -> DataFrame:
    """Requests in the last ten seconds at each event, without one window over all: each event also counts for the next frame."""
    rows = table(spark, folder, "events").filter("ts is not null").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    frame = F.floor(F.col("t") / 10_000_000)
    both = rows.withColumn("own", F.lit(True)).withColumn("frame", F.explode(F.array(frame, frame + 1))).withColumn("own", F.col("frame") == frame)
    seen = both.withColumn("requests", F.count("*").over(Window.partitionBy("frame").orderBy("t").rangeBetween(-10_000_000, 0)))
    return seen.filter("own").select("event_id", "requests")


@query("select date_trunc('second', ts) as second, count(*) as requests from events where ts is not null group by 1")
def request_rate_1s(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").filter("ts is not null").groupBy(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("second")).agg(F.count("*").alias("requests"))


# Sinks


@query("select c_acctbal as acctbal, c_custkey as custkey, null::bigint as suppkey, c_name as name from customer union all select s_acctbal, null, s_suppkey, s_name from supplier")
def union_of_keys(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    b = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return sink.union_of_keys(a, b)


@query("""select record_no, case when len(gov_agencies) > 0 then array_to_string(list_transform(gov_agencies, lambda x: coalesce(x, '~')), '|') end as agencies, year, case when journal_full is not null then journal_full.title end as journal_title,
  case when len(mesh_terms) > 0 then len(mesh_terms)::int end as mesh_n, case when len(mesh_terms) > 0 then mesh_terms[1].descriptor end as first_mesh from pubmed_articles""")
def coerce_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads as the sink stores them; what became JSON text is read again."""
    rows = sink.coerced(table(spark, folder, "pubmed_articles").select("record_no", "gov_agencies", "mesh_terms", "journal_full", "year"))
    return rows.select(
        "record_no", F.array_join("gov_agencies", "|", "~").alias("agencies"), "year", F.get_json_object("journal_full", "$.title").alias("journal_title"),
        F.json_array_length("mesh_terms").alias("mesh_n"), F.get_json_object("mesh_terms", "$[0].descriptor").alias("first_mesh"),
    )


KINDS = [("a", ["bool"]), ("b", ["int"]), ("c", ["int", "float"]), ("d", ["list"]), ("e", []), ("f", ["int", "list"]), ("g", ["float"])]


@query("select * from (values ('a', 'bool'), ('b', 'int'), ('c', 'float'), ('d', '[]string'), ('e', 'string'), ('f', 'string'), ('g', 'float')) v(name, type)")
def infer_schema_type(spark: SparkSession, folder: str) -> DataFrame:
    return _values(spark, KINDS, "name string, kinds array<string>").select("name", sink.inferred_type(F.col("kinds")).alias("type"))


@query("select vec_id, len(embedding) = 64 as vector_ok from embeddings")
def vector_schema_check(spark: SparkSession, folder: str) -> DataFrame:
    return sink.checked_vectors(table(spark, folder, "embeddings"), "embedding", 64).select("vec_id", "vector_ok")


@query()
def embed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts mapped to vectors by the offline provider."""
    return embedded(table(spark, folder, "documents").select("doc_id", "text"), "text", "vector", hash_embedding()).select("doc_id", "vector")


@query(f"""with r as (select *, case when is_pmc_openaccess then 'pmc_oa' when is_manuscript then 'pmc_manuscript' end as source from pmc_inventory)
select concat_ws(':', source, metadata_key, etag) as key, 'metadata filter' as stage, trim(regexp_replace(concat('metadata field license marks a non-commercial license (', license, ')'), '[ \t\n\x0B\f\r]+', ' ', 'g')) as reason from r where source = 'pmc_oa' and ({_MARKED})""")
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory rows that are not fetched, with stage and reason."""
    rows = table(spark, folder, "pmc_inventory")
    source = F.when(F.col("is_pmc_openaccess"), "pmc_oa").when(F.col("is_manuscript"), "pmc_manuscript")
    key = F.concat_ws(":", source, "metadata_key", "etag")
    return incremental.split_by_reason(rows, classify.skip_reason(F.col("is_pmc_openaccess"), F.col("license"), source), key, "metadata filter")[1]


__all__ = ["QUERIES", "SQL", "WHITESPACE"]
