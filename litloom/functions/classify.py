"""Classifiers over publication types, licences, sections, affiliations and labels, as columns without Python workers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from litloom.functions import tables
from litloom.runtime import WHITESPACE


def first_of(cases: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """The value of the first case that holds."""
    out = reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0]))
    return out if default is None else out.otherwise(default)


def any_in(c: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in parts])


def normal_types(types: Column) -> Column:
    return F.transform(F.filter(F.coalesce(types, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != "")), lambda t: F.trim(F.lower(t)))


def is_target(types: Column) -> Column:
    return F.arrays_overlap(normal_types(types), F.array(*map(F.lit, tables.PUBLICATION_TYPES)))


def publication_type(types: Column) -> Column:
    """The article type of the publication type that comes first in precedence, or null."""
    own = normal_types(types)
    return first_of([(F.array_contains(own, name), F.lit(kind)) for name, kind in tables.PUBLICATION_TYPES.items()])


def evidence(article_type: Column, types: Column, abstract: Column) -> Column:
    """struct(grade, level, matched_term, matched_from): from the article type, else a publication type, else words of the abstract."""
    kind = F.regexp_replace(F.lower(F.coalesce(article_type, F.lit(""))), "[_ ]", "-")
    text = F.lower(F.coalesce(abstract, F.lit("")))

    def told(grade: str, term: Column, where: str) -> Column:
        return F.struct(F.lit(grade).alias("grade"), F.lit(tables.EVIDENCE_LEVELS[grade]).alias("level"), term.alias("matched_term"), F.lit(where).alias("matched_from"))

    def by_term(c: Column, where: str) -> Column:
        return first_of([(F.contains(c, F.lit(t)), told(g, F.lit(t), where)) for t, g in tables.EVIDENCE_TERMS])

    in_types = F.get(F.filter(F.transform(F.coalesce(types, F.array().cast("array<string>")), lambda t: by_term(F.lower(t), "publication_type")), lambda x: x.isNotNull()), F.lit(0))
    in_text = first_of([
        (any_in(text, ["systematic review", "meta-analysis", "meta analysis"]), told("A", F.lit("systematic review"), "abstract")),
        (F.contains(text, F.lit("guideline")), told("A", F.lit("guideline"), "abstract")),
        (any_in(text, ["randomized controlled trial", "randomised controlled trial"]), told("B", F.lit("randomized controlled trial"), "abstract")),
        (F.contains(text, F.lit("rct")), told("B", F.lit("rct"), "abstract")),
        (F.contains(text, F.lit("randomized trial")) & F.contains(text, F.lit("phase")), told("B", F.lit("randomized trial + phase"), "abstract")),
        (any_in(text, ["cohort study", "prospective study", "observational study"]), told("C", F.lit("cohort study"), "abstract")),
    ])
    rest = F.when(kind == "news", told("D", kind, "fallback")).otherwise(told("C", F.nullif(kind, F.lit("")), "fallback"))
    return F.coalesce(by_term(kind, "article_type"), in_types, in_text, rest)


def license_type(c: Column) -> Column:
    """The normal name of a licence written as text."""
    t = F.lower(F.coalesce(c, F.lit("")))
    has = lambda *p: any_in(t, list(p))
    return first_of([(has("cc0"), F.lit("cc0")), (has("by-nc"), F.lit("cc-by-nc")), (has("by-sa"), F.lit("cc-by-sa")), (has("by-nd"), F.lit("cc-by-nd")), (has("cc by", "cc-by"), F.lit("cc-by")), (has("public domain"), F.lit("cc0"))], F.lit("unknown"))


def is_commercial(license_: Column) -> Column:
    return ~F.contains(F.coalesce(license_, F.lit("")), F.lit("nc"))


def section_type(kind: Column, title: Column) -> Column:
    """The normal type of a section: from its type, else from its title, else other."""
    mapped = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in tables.SECTION_TYPES.items() for x in kv)), F.lower(kind)), F.lit("other"))
    own = F.lower(F.coalesce(title, F.lit("")))
    return F.when(mapped != "other", mapped).otherwise(first_of([(F.contains(own, F.lit(p)), F.lit(t)) for p, t in tables.TITLE_HINTS], F.lit("other")))


def weight(kind: Column, weights: dict[str, float] = tables.SECTION_WEIGHTS, default: float = 0.5) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)), F.lower(kind)), F.lit(default))


def is_left_out(kind: Column, title: Column) -> Column:
    """Whether a section is back matter."""
    return F.lower(F.coalesce(kind, F.lit(""))).isin(tables.EXCLUDED_SECTION_TYPES) | any_in(F.lower(F.coalesce(title, F.lit(""))), tables.EXCLUDED_SECTION_TITLES)


def is_prescription(code: Column, display: Column) -> Column:
    space = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WHITESPACE, " "))
    return (space(code) == tables.PRESCRIPTION_CODE) | F.contains(F.lower(space(display)), F.lit(tables.PRESCRIPTION_TOKEN))


def agencies(affiliations: Column, grants: Column) -> Column:
    """Sorted names of the agencies in a record's affiliations, with the grant agencies that are of the government as they stand."""
    none = F.array().cast("array<string>")
    own = F.flatten(F.transform(F.coalesce(affiliations, none), lambda a: F.filter(F.array(*(F.when(F.contains(F.lower(a), F.lit(p)), F.lit(n)) for p, n in tables.AGENCY_PHRASES)), lambda x: x.isNotNull())))
    given = F.transform(F.filter(F.coalesce(grants, none), lambda g: g.isNotNull() & any_in(F.lower(g), tables.GRANT_TOKENS)), lambda g: F.trim(g))
    return F.array_sort(F.array_distinct(F.concat(own, given)))


def skip_reason(is_open: Column, license_: Column, source: Column) -> Column:
    """Why an inventory row is not to be fetched, or null; only rows of the open-access set are judged."""
    marked = any_in(F.lower(F.trim(license_)), tables.NON_COMMERCIAL)
    return F.when(source == "pmc_oa", F.when(~is_open, F.lit("metadata field is_pmc_openaccess is false")).when(marked, F.concat(F.lit("metadata field license marks a non-commercial license ("), license_, F.lit(")"))))


def json_skip_reason(metadata: Column) -> Column:
    """The same for free metadata in JSON text: the first flag that is false, else the first licence field that bars commercial use."""
    value = lambda f: F.get_json_object(metadata, f"$['{f}']")
    flags = [(F.lower(F.trim(value(f))).isin("false", "0", "no", "n"), F.lit(f"metadata field {f} is false")) for f in tables.OPEN_FLAGS]
    marks = [(any_in(F.lower(F.trim(value(f))), tables.NON_COMMERCIAL), F.concat(F.lit(f"metadata field {f} marks a non-commercial license ("), value(f), F.lit(")"))) for f in tables.LICENSE_FIELDS]
    return first_of(flags + marks)


def retry_kind(status: Column, message: Column, kind: Column) -> Column:
    """rate_limit, transient or fatal."""
    text, name = F.lower(F.coalesce(message, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    limited = (F.coalesce(status, F.lit(0)) == 429) | any_in(text, ["429", "rate limit", "too many requests"])
    passing = F.coalesce(status, F.lit(0)).isin(500, 502, 503, 504) | any_in(text, ["500", "502", "503", "504", "connection", "timeout", "reset"]) | any_in(name, ["connection", "timeout"])
    return F.when(limited, "rate_limit").when(passing, "transient").otherwise("fatal")


def retry_wait(kind: Column, attempt: Column, retry_after: Column) -> Column:
    """Seconds to wait before jitter: what the service asks for, else a growing pause."""
    grow = F.pow(F.lit(2.0), attempt - 1)
    own = F.when(kind == "rate_limit", F.least(2 * grow, F.lit(30.0))).when(kind == "transient", F.least(grow, F.lit(8.0)))
    return F.when(kind != "fatal", F.coalesce(F.when(retry_after.try_cast("double") < 0, F.lit(0.0)).otherwise(retry_after.try_cast("double")), own))
