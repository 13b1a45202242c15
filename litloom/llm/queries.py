"""The queries of the llm operators, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.llm import leakage, mixing, neardup, residue, seen, split, terms, truncation
from litloom.runtime import WHITESPACE, drop, materialize, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# 6. Frequency of every distinct value

TERM_FIELDS = ["mesh_terms_flat", "keywords_flat", "publication_types_flat"]


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values too rare or too common to be useful."""
    return terms.marked(table(spark, folder, "pubmed_articles"), TERM_FIELDS).filter("mark <> ''").select("field_name", "term", "mark")


@query
def p6_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Occurrences and records of every value, with its mark."""
    return terms.marked(table(spark, folder, "pubmed_articles"), TERM_FIELDS)


_TERMS = """
with v as (
  select record_no, field_name, trim(regexp_replace(lower(t), '[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')) as term from (
    select record_no, 'mesh_terms_flat' as field_name, unnest(mesh_terms_flat) as t from pubmed_articles
    union all select record_no, 'keywords_flat', unnest(keywords_flat) from pubmed_articles
    union all select record_no, 'publication_types_flat', unnest(publication_types_flat) from pubmed_articles)),
c as (
  select field_name, term, count(*) as occurrences, count(distinct record_no) as records from v where term is not null and term <> '' group by all),
m as (
  select *, case when records < 3 then 'rare' when records > 0.15 * (select count(*) from pubmed_articles) then 'common' else '' end as mark from c)
"""
SQL["p6_found"] = _TERMS + "select field_name, term, mark from m where mark <> ''"
SQL["p6_term_counts"] = _TERMS + "select * from m"


# 2. Splitting oversized items


def _items(spark: SparkSession, folder: str) -> DataFrame:
    pmc, labels = table(spark, folder, "pmc_articles"), table(spark, folder, "dailymed_labels")
    full = pmc.select(F.lit("full_text").alias("item_kind"), "record_no", F.lit(-1).alias("section_pos"), F.col("full_text").alias("text"))
    section = pmc.select(F.lit("section").alias("item_kind"), "record_no", F.posexplode(F.transform("structured_sections", lambda s: s["content"])).alias("section_pos", "text"))
    label = labels.select(F.lit("label_section").alias("item_kind"), "record_no", F.posexplode(F.transform("sections", lambda s: s["text"])).alias("section_pos", "text"))
    return full.unionByName(section).unionByName(label)


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each item that had to be split."""
    pieces = split.split_oversized(_items(spark, folder), table(spark, folder, "split_limits"))
    return pieces.filter("piece_no = 0").select("item_kind", "record_no", "section_pos")


@query
def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces, in order, with their place in the item."""
    return split.split_oversized(_items(spark, folder), table(spark, folder, "split_limits"))


SQL["p2_found"] = """
select i.item_kind, record_no, section_pos from (
  select 'full_text' as item_kind, record_no, -1 as section_pos, full_text as text from pmc_articles
  union all select 'section', record_no, unnest(range(len(structured_sections)))::int, unnest(structured_sections).content from pmc_articles
  union all select 'label_section', record_no, unnest(range(len(sections)))::int, unnest(sections).text from dailymed_labels) i
join split_limits l on l.item_kind = i.item_kind where length(text) > max_chars"""


@query
def p2_rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """The digest of each item's text as its pieces give it, and whether all pieces are within the limit."""
    limits = table(spark, folder, "split_limits")
    pieces = split.split_oversized(_items(spark, folder), limits).join(F.broadcast(limits), "item_kind")  # a limit for each kind
    own = F.when(F.col("piece_no") == 0, F.col("piece")).otherwise(F.substr("piece", F.col("overlap_chars") + 1))
    rebuilt = pieces.groupBy("item_kind", "record_no", "section_pos").agg(F.sort_array(F.collect_list(F.struct("piece_no", own.alias("own")))).alias("parts"), F.bool_and(F.length("piece") <= F.col("max_chars")).alias("within_limit"))
    return rebuilt.select("item_kind", "record_no", "section_pos", F.md5(F.array_join("parts.own", "")).alias("digest"), "within_limit")


SQL["p2_rebuilt"] = """
with i as (select 'full_text' as item_kind, record_no, -1 as section_pos, full_text as text from pmc_articles
  union all select 'section', record_no, p::int, x.content from (select record_no, unnest(structured_sections) as x, unnest(range(len(structured_sections))) as p from pmc_articles)
  union all select 'label_section', record_no, p::int, x.text from (select record_no, unnest(sections) as x, unnest(range(len(sections))) as p from dailymed_labels))
select item_kind, record_no, section_pos, md5(text) as digest, true as within_limit from i join split_limits using (item_kind) where length(text) > max_chars"""


# 5. Has this key been seen before?


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """(feed, number, key): the lines done before, with number null, then the records of the three tables."""
    kinds = {"pubmed": [r"pmid\s*:", r"pubmed\s*:"], "pmc": ["w/", r"etag\s*:"], "dailymed": [r"urn:uuid:", r"uuid\s*:", r"set_?id\s*:", r"dailymed\s*:"]}

    def key(c: Column, feed: str) -> Column:
        own = seen.bare(c, *kinds[feed])
        return F.regexp_replace(own, "^0+(?=.)", "") if feed == "pubmed" else own

    named = [("pubmed", "pubmed_articles", "pmid"), ("pmc", "pmc_inventory", "etag"), ("dailymed", "dailymed_labels", "set_id")]
    records = [table(spark, folder, t).select(F.lit(f).alias("feed"), F.col("record_no").alias("number"), key(F.col(c), f).alias("key")) for f, t, c in named]
    line = F.regexp_replace(F.lower("line"), rf"^(?:{WHITESPACE}|[\"'{{}}])+", "")
    space = F.regexp_extract(line, r"^([a-z_]+)\s*:", 1)
    rest = F.regexp_replace(line, r"^[a-z_]+\s*:", "")
    lines = table(spark, folder, "checkpoint_lines").select(line.alias("line"), space.alias("space"), rest.alias("rest"))
    done = lines.select(
        F.explode(
            F.when(F.col("space").isin("pubmed", "pmid"), F.array(F.struct(F.lit("pubmed").alias("feed"), key(F.col("rest"), "pubmed").alias("key"))))
            .when(F.col("space").isin("dailymed", "urn", "uuid", "set_id", "setid"), F.array(F.struct(F.lit("dailymed").alias("feed"), key(F.col("rest"), "dailymed").alias("key"))))
            .when(F.col("space").isin("pmc_oa", "pmc_manuscript"), F.array(F.struct(F.lit("pmc").alias("feed"), key(F.regexp_extract("rest", r"^[^:]*:(.*)$", 1), "pmc").alias("key"))))
            .when(F.col("space") == "", F.array(F.struct(F.lit("pubmed").alias("feed"), key(F.col("line"), "pubmed").alias("key")), F.struct(F.lit("dailymed").alias("feed"), key(F.col("line"), "dailymed").alias("key"))))
        ).alias("d")
    )
    before = done.select("d.feed", F.lit(None).cast("long").alias("number"), "d.key")
    return records[0].unionByName(records[1]).unionByName(records[2]).unionByName(before)


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each record whose key was in an earlier record or among the lines."""
    return seen.seen_before(_arrivals(spark, folder)).withColumnRenamed("number", "record_no")


@query
def p5_wrong_rate(spark: SparkSession, folder: str) -> DataFrame:
    """How often the filters answer wrongly, measured with keys that are certainly absent."""
    return seen.wrong_rate(_arrivals(spark, folder))


_OUTER = "(?:[\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{3000}]|[\"''{}])"


def _bare(c: str, prefixes: str, zeros: bool = False) -> str:
    own = f"regexp_replace(regexp_replace(lower({c}), '^(?:{_OUTER}|{prefixes})+', ''), '{_OUTER}+$', '')"
    own = f"regexp_replace({own}, '^0+(.)', '\\1')" if zeros else own
    return f"nullif({own}, '')"


_PUB, _PMC, _DM = "pmid\\s*:|pubmed\\s*:", "w/|etag\\s*:", "urn:uuid:|uuid\\s*:|set_?id\\s*:|dailymed\\s*:"
SQL["p5_found"] = f"""
with l as (select regexp_replace(lower(line), '^{_OUTER}+', '') as line from checkpoint_lines),
n as (select line, regexp_extract(line, '^([a-z_]+)\\s*:', 1) as space, regexp_replace(line, '^[a-z_]+\\s*:', '') as rest from l),
k as (
  select 'pubmed' as feed, record_no as number, {_bare("pmid", _PUB, True)} as key from pubmed_articles
  union all select 'pmc', record_no, {_bare("etag", _PMC)} from pmc_inventory
  union all select 'dailymed', record_no, {_bare("set_id", _DM)} from dailymed_labels
  union all select 'pubmed', null, {_bare("rest", _PUB, True)} from n where space in ('pubmed', 'pmid')
  union all select 'dailymed', null, {_bare("rest", _DM)} from n where space in ('dailymed', 'urn', 'uuid', 'set_id', 'setid')
  union all select 'pmc', null, {_bare("regexp_extract(rest, '^[^:]*:(.*)$', 1)", _PMC)} from n where space in ('pmc_oa', 'pmc_manuscript')
  union all select 'pubmed', null, {_bare("line", _PUB, True)} from n where space = ''
  union all select 'dailymed', null, {_bare("line", _DM)} from n where space = ''),
f as (select *, min(coalesce(number, -1)) over (partition by feed, key) as first from k where key is not null)
select feed, number as record_no from f where number is not null and first < number"""


# 1. Near-duplicate records

LABEL_SIMILARITY = 0.65


def _label_pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes of equal labels, and which label is in which class."""
    labels = table(spark, folder, "dailymed_labels")
    texts = F.coalesce(F.transform("sections", lambda s: s["text"]), F.array().cast("array<string>"))
    told = labels.filter(F.exists(texts, lambda t: t.isNotNull() & t.rlike(r"\S")))
    sets = materialize(neardup.shingled(told, "record_no", F.concat(F.array("drug_name", "manufacturer"), texts), 3), "sets")
    distinct, member = neardup.classes(sets)
    pairs = neardup.similar_pairs(distinct, LABEL_SIMILARITY)
    drop(sets)
    return pairs, member


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair of labels whose similarity is at least 0.65."""
    pairs, member = _label_pairs(spark, folder)
    return neardup.expanded(pairs, member).select(F.col("a").alias("record_no_a"), F.col("b").alias("record_no_b"))


@query
def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Each label with section text: its group, its class of equal labels, and how many other classes it is linked with."""
    pairs, member = _label_pairs(spark, folder)
    linked = neardup.components(pairs).withColumnRenamed("id", "rep")
    links = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    out = member.join(linked, "rep", "left").join(links, "rep", "left")
    return out.select(F.col("id").alias("record_no"), F.coalesce("component", "rep").alias("group_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))

_LABEL_SETS = """
with recursive l as (select record_no, [drug_name, manufacturer] || list_transform(coalesce(sections, []), lambda s: s.text) as texts from dailymed_labels where len(list_filter(coalesce(sections, []), lambda s: regexp_matches(s.text, '\\S'))) > 0),
t as (select record_no, unnest(list_transform(list_filter(texts, lambda t: t is not null), lambda t: regexp_extract_all(lower(t), '[a-z0-9]+'))) as w from l),
g as (select distinct record_no, unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) as s from t where len(w) > 2),
z as (select record_no, count(*) as n, md5(string_agg(s, '|' order by s)) as h from g group by record_no),
m as (select a.record_no as a, b.record_no as b, count(*) as met from g a join g b on a.s = b.s and a.record_no < b.record_no group by all),
pairs as (select a, b from m join z x on x.record_no = a join z y on y.record_no = b where met >= 0.65 * (x.n + y.n - met))"""
SQL["p1_found"] = f"{_LABEL_SETS} select a as record_no_a, b as record_no_b from pairs"
SQL["p1_groups"] = f"""{_LABEL_SETS},
c as (select record_no, min(record_no) over (partition by h) as class_id from z),
e as (select distinct x.class_id as a, y.class_id as b from pairs join c x on x.record_no = pairs.a join c y on y.record_no = pairs.b where x.class_id <> y.class_id),
two as (select a, b from e union select b, a from e),
r as (select class_id as node, class_id as root from (select distinct class_id from c) union select two.b, r.root from r join two on two.a = r.node)
select record_no, (select min(root) from r where node = class_id) as group_id, class_id, (select count(*) from two where two.a = class_id) as links from c"""


# 8. Evaluation texts in training text


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    index = leakage.build_index(table(spark, folder, "documents"), "doc_id", "text")
    return leakage.phrase_matches(index, leakage.items_of(table(spark, folder, "eval_items"), "item_id", "text"))


@query
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each document and item with 13 consecutive words in common."""
    return _leaks(spark, folder).select("doc_id", "item_id").distinct()


@query
def p8_passages(spark: SparkSession, folder: str) -> DataFrame:
    """The common passages: where they begin and how many words they have."""
    return _leaks(spark, folder)


@query
def p8_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """The items that leaked: in how many documents, and the most words found in one piece."""
    return _leaks(spark, folder).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.max("words").alias("longest"))


@query
def p8_proximity(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have the rarest terms of an item close together, in any order."""
    index = leakage.build_index(table(spark, folder, "documents"), "doc_id", "text")
    return leakage.proximity(index, leakage.items_of(table(spark, folder, "eval_items"), "item_id", "text"))


SQL["p8_found"] = """
with g as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from documents),
i as (select item_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from eval_items),
a as (select doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) as s from g where len(w) > 12),
b as (select item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) as s from i where len(w) > 12)
select distinct doc_id, item_id from a join b using (s)"""

_RUNS = """
with g as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from documents),
i as (select item_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from eval_items),
a as (select doc_id, unnest(range(len(w) - 12)) as p, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) as s from g where len(w) > 12),
b as (select item_id, unnest(range(len(w) - 12)) as q, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) as s from i where len(w) > 12),
m as (select doc_id, item_id, p, q, p - q as shift, q - row_number() over (partition by doc_id, item_id, p - q order by q) as island from a join b using (s)),
runs as (select doc_id, item_id, min(q)::int as item_start, min(p)::int as doc_start, (count(*) + 12)::int as words from m group by doc_id, item_id, shift, island)"""
SQL["p8_passages"] = f"{_RUNS} select * from runs"
SQL["p8_leaked_items"] = f"{_RUNS} select item_id, count(distinct doc_id) as documents, max(words) as longest from runs group by item_id"


# 3. Text cut off by field limits


def _cut_scores(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.scored(table(spark, folder, "label_texts"), "text_no", "source", "text")


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each row whose text lost its end."""
    return _cut_scores(spark, folder).filter("score > 0.5").select(F.col("id").alias("text_no"))


@query
def p3_rates(spark: SparkSession, folder: str) -> DataFrame:
    """How often each source truncates."""
    scored = _cut_scores(spark, folder)
    return scored.groupBy("source").agg(F.count("*").alias("texts"), F.sum((F.col("score") > 0.5).cast("long")).alias("truncated"), F.avg((F.col("score") > 0.5).cast("double")).alias("share"))


# 10. Template residue and error-page text


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each document that holds residue anywhere."""
    return residue.residue(table(spark, folder, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id")).distinct()


@query
def p10_residue(spark: SparkSession, folder: str) -> DataFrame:
    """Where the residue lies, of which kind it is, and its likelihood ratio."""
    return residue.residue(table(spark, folder, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


@query
def p10_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without residue."""
    documents = table(spark, folder, "documents")
    return residue.excluded(documents, "doc_id", residue.residue(documents, "doc_id", "text")).select("doc_id", "source", "n_chars")


# 9. Mixing sources to target weights


@query
def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture: how often each chosen document is used for its source."""
    return mixing.mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), "doc_id", "text", "source")


@query
def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares reached."""
    targets = table(spark, folder, "mix_targets")
    return mixing.shares(materialize(mixing.mixture(table(spark, folder, "documents"), targets, "doc_id", "text", "source"), "mixture"), targets)
