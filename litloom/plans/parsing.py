"""Queries over the XML parsers: the tables' records are written as XML of each source and parsed again; the SQL takes the same from the columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions import tables
from litloom.plans.ingest import WS
from litloom.runtime import WHITESPACE, spread, table
from litloom.sources import grid, jats, pubmed, spl
from litloom.sources.xmltext import root_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return keep


def escaped(c: Column | str) -> Column:
    """Text as XML content: characters that XML forbids are blanks; null gives ''."""
    c = F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]", " ")
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def element(name: str, content: Column | str, attributes: str = "") -> Column:
    """An element with escaped text; absent if the text is null."""
    c = F.col(content) if isinstance(content, str) else content
    return F.coalesce(F.when(c.isNotNull(), F.concat(F.lit(f"<{name}{attributes}>"), escaped(c), F.lit(f"</{name}>"))), F.lit(""))


def each(items: Column, f: Callable[[Column], Column]) -> Column:
    """The elements of a list, one after the other; null ones are left out."""
    return F.coalesce(F.array_join(F.transform(F.filter(items, lambda x: x.isNotNull()), f), ""), F.lit(""))


def one(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WHITESPACE, " "))


def _one(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{WS}', ' ', 'g'))"


def _flat(items: str, value: str) -> str:
    """The non-blank texts of a list's elements, joined."""
    return f"array_to_string(list_filter(list_transform(list_filter(coalesce({items}, []), lambda x: x is not null), lambda x: {_one(value)}), lambda x: x <> ''), '|')"


def binary(xml: Column) -> Column:
    return F.encode(xml, "UTF-8")


def pubmed_files(articles: DataFrame) -> DataFrame:
    """(path, content): a file for each record, its number among the identifiers."""
    mesh = each(F.col("mesh_terms"), lambda m: F.concat(F.lit("<MeshHeading>"), element("DescriptorName", m["descriptor"]), each(m["qualifiers"], lambda q: element("QualifierName", q["name"])), F.lit("</MeshHeading>")))
    keywords = each(F.col("keywords_flat"), lambda k: element("Keyword", k))
    types = each(F.col("publication_types_flat"), lambda t: element("PublicationType", t))
    xml = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><Article><Journal>"), element("Title", "journal"), F.lit("<JournalIssue><PubDate>"), element("Year", F.col("year").cast("string")), F.lit("</PubDate></JournalIssue></Journal>"),
        element("ArticleTitle", "title"), F.lit("<Abstract>"), element("AbstractText", "abstract"), F.lit("</Abstract><PublicationTypeList>"), types, F.lit("</PublicationTypeList></Article><MeshHeadingList>"), mesh, F.lit("</MeshHeadingList><KeywordList>"), keywords,
        F.lit("</KeywordList></MedlineCitation><PubmedData><ArticleIdList>"), element("ArticleId", "doi", ' IdType="doi"'), element("ArticleId", F.col("record_no").cast("string"), ' IdType="mid"'), F.lit("</ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"),
    )
    return articles.select(F.col("record_no").cast("string").alias("path"), binary(xml).alias("content"))


@query(f"""select record_no, {_one('title')} as title, {_one('abstract')} as abstract, {_one('journal')} as journal, nullif({_one('doi')}, '') as doi, year,
  {_flat('mesh_terms', 'x.descriptor')} as mesh, {_flat('keywords_flat', 'x')} as keywords, {_flat('publication_types_flat', 'x')} as types,
  coalesce(list_sum(list_transform(list_filter(mesh_terms, lambda m: m is not null and {_one('m.descriptor')} <> ''), lambda m: len(list_filter(coalesce(m.qualifiers, []), lambda q: q is not null and q.name is not null)))), 0)::int as qualifiers
  from pubmed_articles""")
def pubmed_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Bibliographic records through PubMed XML."""
    rows = pubmed.read(spread(pubmed_files(table(spark, folder, "pubmed_articles"))))
    flat = lambda c: F.array_join(F.filter(F.transform(c, one), lambda x: x != ""), "|")
    return rows.select(
        F.col("other_ids")["mid"].cast("long").alias("record_no"), one(F.col("title")).alias("title"), one(F.col("abstract")).alias("abstract"), one(F.col("journal")).alias("journal"), F.when(one(F.col("doi")) != "", one(F.col("doi"))).alias("doi"), "year",
        flat(F.col("mesh_terms_flat")).alias("mesh"), flat(F.col("keywords_flat")).alias("keywords"), flat(F.col("publication_types_flat")).alias("types"), F.aggregate("mesh_terms", F.lit(0), lambda n, m: n + F.size(m["qualifiers"])).alias("qualifiers"),
    )


def jats_files(articles: DataFrame) -> DataFrame:
    """(path, content): an article for each record, named by its number."""
    section = lambda s: F.concat(F.lit('<sec sec-type="'), escaped(s["type"]), F.lit('"'), F.coalesce(F.concat(F.lit(' id="'), escaped(s["id"]), F.lit('"')), F.lit("")), F.lit(">"), element("title", s["title"]), element("p", s["content"]), F.lit("</sec>"))
    boxed = lambda t: F.concat(F.lit("<table-wrap>"), element("label", t["label"]), F.lit("<caption>"), element("title", t["caption_title"]), F.lit("</caption><table-wrap-foot>"), each(t["footnotes"], lambda f: element("fn", f)), F.lit("</table-wrap-foot></table-wrap>"))
    xml = F.concat(
        F.lit("<article><front><article-meta>"), element("article-id", "doi", ' pub-id-type="doi"'), F.lit("<title-group>"), element("article-title", "title"), F.lit("</title-group><pub-date>"), element("year", F.col("year").cast("string")),
        F.lit("</pub-date></article-meta></front><body>"), each(F.col("structured_sections"), section), F.lit("</body><floats-group>"), each(F.col("content")["tables"], boxed), F.lit("</floats-group></article>"),
    )
    return articles.select(F.concat(F.col("record_no").cast("string"), F.lit(".xml")).alias("path"), binary(xml).alias("content"))


@query(f"""with r as (select record_no, title, year, list_filter(coalesce(structured_sections, []), lambda s: s is not null) as own, list_filter(coalesce(content.tables, []), lambda t: t is not null) as boxed from pmc_articles),
s as (select record_no, unnest(own) as s, unnest(range(len(own))) as i from r),
kept as (select record_no, i, coalesce(nullif(s.id, ''), 'sec' || (i + 1)) as id, {_one('s.title')} as title, {_one('s.content')} as content from s where {_one('s.content')} <> ''),
told as (select record_no, string_agg(id || ':' || title || ':' || content, chr(10) order by i) as sections, count(*) as n from kept group by record_no)
select record_no, coalesce(nullif({_one('r.title')}, ''), 'Untitled ' || record_no) as title, year, coalesce(told.sections, '') as sections, coalesce(told.n, 0)::int as n_sections,
  len(boxed)::int as n_tables, coalesce(list_sum(list_transform(boxed, lambda t: len(list_filter(coalesce(t.footnotes, []), lambda f: {_one('f')} <> '')))), 0)::int as n_footnotes from r left join told using (record_no)""")
def jats_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Articles through JATS XML: sections, tables and their notes."""
    rows = jats.read(spread(jats_files(table(spark, folder, "pmc_articles"))))
    told = F.array_join(F.transform("sections", lambda s: F.concat_ws(":", s["id"], one(s["title"]), one(s["content"]))), "\n")
    return rows.select(
        F.regexp_extract("path", r"^(\d+)", 1).cast("long").alias("record_no"), "title", "year", told.alias("sections"), F.size("sections").alias("n_sections"),
        F.size("tables").alias("n_tables"), F.aggregate("tables", F.lit(0), lambda n, t: n + F.size(t["footnotes"])).alias("n_footnotes"),
    )


_CODES = {key: code for code, (key, _) in reversed(tables.LABEL_SECTIONS.items())}


def spl_files(labels: DataFrame) -> DataFrame:
    """(path, content): a label for each record, named by its number; sections of unknown kinds have no code."""
    code = F.create_map(*[F.lit(x) for kv in _CODES.items() for x in kv])
    section = lambda s: F.concat(F.lit('<component><section><code code="'), F.coalesce(F.try_element_at(code, s["key"]), F.lit("")), F.lit('"/>'), element("title", s["title"]), element("text", s["text"]), F.lit("</section></component>"))
    xml = F.concat(
        F.lit('<document xmlns="urn:hl7-org:v3"><code code="'), escaped("label_type_code"), F.lit('" displayName="'), escaped("label_type_display"), F.lit('"/>'), element("title", "title"), F.lit('<setId root="'), escaped("set_id"),
        F.lit('"/><author><representedOrganization>'), element("name", "manufacturer"), F.lit("</representedOrganization></author><subject><manufacturedProduct><manufacturedProduct>"), element("name", "drug_name"),
        each(F.col("active_ingredients"), lambda a: F.concat(F.lit('<ingredient classCode="ACTIB"><ingredientSubstance>'), element("name", a), F.lit("</ingredientSubstance></ingredient>"))),
        F.lit("</manufacturedProduct></manufacturedProduct></subject><component><structuredBody>"), each(F.col("sections"), section), F.lit("</structuredBody></component></document>"),
    )
    return labels.select(F.concat(F.col("record_no").cast("string"), F.lit(".xml")).alias("path"), binary(xml).alias("content"))


_KEYS = ", ".join(f"'{k}'" for k in _CODES)


@query(f"""with r as (select *, list_filter(coalesce(sections, []), lambda s: s is not null) as own from dailymed_labels
  where {_one('label_type_code')} = '34391-3' or contains(lower({_one('label_type_display')}), 'human prescription drug label')),
s as (select record_no, unnest(own) as s, unnest(range(len(own))) as i from r),
kept as (select record_no, s.key as key, string_agg({_one('s.text')}, ' ' order by i) as text, min(i) as i from s where s.key in ({_KEYS}) and {_one('s.text')} <> '' group by all),
told as (select record_no, string_agg(key || ':' || text, chr(10) order by i) as sections, count(*) as n from kept group by record_no)
select record_no, coalesce(nullif({_one('set_id')}, ''), record_no::varchar) as set_id, coalesce({_one('case when drug_name is null then r.title else drug_name end')}, '') as drug_name, {_one('manufacturer')} as manufacturer,
  array_to_string(list_transform(list_filter(coalesce(active_ingredients, []), lambda a: a is not null), lambda a: {_one('a')}), '|') as ingredients, coalesce(told.sections, '') as sections, coalesce(told.n, 0)::int as n_sections from r left join told using (record_no)""")
def spl_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Prescription labels through SPL XML."""
    rows = spl.read(spread(spl_files(table(spark, folder, "dailymed_labels")))).filter("status = 'ok'")
    told = F.array_join(F.transform("sections", lambda s: F.concat_ws(":", s["key"], one(s["text"]))), "\n")
    return rows.select(
        F.regexp_extract("path", r"^(\d+)", 1).cast("long").alias("record_no"), one(F.col("set_id")).alias("set_id"), one(F.col("drug_name")).alias("drug_name"), one(F.col("manufacturer")).alias("manufacturer"),
        F.array_join(F.transform("active_ingredients", one), "|").alias("ingredients"), told.alias("sections"), F.size("sections").alias("n_sections"),
    )


@query("""with n as (select r_name, n_name, c.n as customers from nation join region on n_regionkey = r_regionkey join (select c_nationkey, count(*) as n from customer group by 1) c on c_nationkey = n_nationkey)
select r_name as region, '| region | nation | customers |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || r_name || ' | ' || n_name || ' | ' || customers || ' |', chr(10) order by n_name) as markdown from n group by r_name""")
def table_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Tables in markup, the first cell over all rows, as pipe tables."""
    customers = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    rows = table(spark, folder, "nation").join(customers, "n_nationkey").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = rows.groupBy(F.col("r_name").alias("region")).agg(F.sort_array(F.collect_list(F.struct("n_name", "customers"))).alias("own"))
    cells = F.transform("own", lambda n, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.concat(F.lit('<td rowspan="'), F.size("own").cast("string"), F.lit('">'), escaped("region"), F.lit("</td>"))).otherwise(""), element("td", n["n_name"]), element("td", n["customers"].cast("string")), F.lit("</tr>")))
    xml = F.concat(F.lit("<table><tr><th>region</th><th>nation</th><th>customers</th></tr>"), F.array_join(cells, ""), F.lit("</table>"))

    @F.pandas_udf("string")
    def told(content):
        return content.map(lambda x: grid.markdown(grid.grid(root_of(x.encode()))))

    return own.select("region", told(xml).alias("markdown"))
