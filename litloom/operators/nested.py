"""Deeply nested records as related flat tables.

The merged schema of a column is walked; each array level becomes a child table whose rows carry the key of their
record, the surrogate key of their parent row, and their ordinal in the stored list (null elements are skipped but
counted). JSON text columns get their schema from an aggregate over all rows and are walked as variants (json_tables).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_schema(df: DataFrame, column: str) -> str:
    """The merged schema of all parsable values of a JSON text column, as DDL."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]


def json_list(value: Column, path: str) -> Column:
    """A JSON member as array<variant>: an array as it is, an object standing alone as its only element, else null."""
    v = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array(v))


def child_table(df: DataFrame, key: str, lists: Column, path: str, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row for each non-null element of `lists`, with key, parent_key, row_key, parent_pos, child_pos and the element as `item`.

    A top-level list's parent is the record (parent_pos -1). `carried` gives the parent row's own row_key and position.
    """
    up = carried or {"parent_key": F.col(key).cast("string"), "parent_pos": F.lit(-1)}
    out = df.select(F.col(key).alias("record_no"), up["parent_key"].alias("parent_key"), up["parent_pos"].alias("parent_pos"), F.posexplode(lists).alias("child_pos", "item"))
    kind = out.schema["item"].dataType
    present = ~F.is_variant_null(F.col("item")) if isinstance(kind, T.VariantType) else F.lit(True)
    return out.filter(F.col("item").isNotNull() & present).withColumn("row_key", F.concat_ws("/", "parent_key", F.lit(path), F.col("child_pos").cast("string")))


def child_tables(df: DataFrame, key: str, column: str, name: str | None = None) -> dict[str, DataFrame]:
    """Every array level under `column` as its own table, named by its path; the fields of struct elements become columns.

    Struct fields that are arrays go to tables of their own and leave the parent's row; other nested structs are flattened
    with names joined by '_'. Null and empty arrays give no rows; a repeated key gives the rows of all its records.
    """
    out: dict[str, DataFrame] = {}

    def scalars(at: Column, kind: T.DataType, prefix: str) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [c for f in kind.fields for c in scalars(at.getField(f.name), f.dataType, f"{prefix}{'_' if prefix else ''}{f.name}")]
        return [] if isinstance(kind, T.ArrayType) else [at.alias(prefix or "value")]

    def arrays(at: Column, kind: T.DataType, path: str) -> list[tuple[str, Column, T.ArrayType]]:
        if isinstance(kind, T.StructType):
            return [a for f in kind.fields for a in arrays(at.getField(f.name), f.dataType, f"{path}.{f.name}")]
        return [(path, at, kind)] if isinstance(kind, T.ArrayType) else []

    def walk(base: DataFrame, at: Column, kind: T.ArrayType, path: str, carried: dict[str, Column] | None, own: str) -> None:
        rows = child_table(base, own, at, path, carried)
        links = [F.col(c) for c in ("record_no", "parent_key", "row_key", "parent_pos", "child_pos")]
        taken = {"record_no", "parent_key", "row_key", "parent_pos", "child_pos"}
        fields = [c.alias(f"{n}_value") if (n := c._jc.toString().rpartition(" AS ")[2].strip("`")) in taken else c for c in scalars(F.col("item"), kind.elementType, "")] if not isinstance(kind.elementType, T.ArrayType) else []
        out[path] = rows.select(*links, *fields)
        for inner_path, inner, inner_kind in ([(f"{path}[]", F.col("item"), kind.elementType)] if isinstance(kind.elementType, T.ArrayType) else arrays(F.col("item"), kind.elementType, path)):
            walk(rows, inner, inner_kind, inner_path, {"parent_key": F.col("row_key"), "parent_pos": F.col("child_pos")}, "record_no")

    for path, at, kind in arrays(F.col(column), df.select(column).schema[0].dataType, name or column):
        walk(df, at, kind, path, None, key)
    return out


def _parsed(schema: str) -> tuple[str, object]:
    """The schema of a variant as a tree: ("OBJECT", {name: tree}), ("ARRAY", tree) or (type, None)."""
    tokens = re.findall(r"`(?:[^`]|``)*`|[<>,:]|[^<>,:`\s(]+(?:\([^)]*\))?", schema)

    def take(at: int) -> tuple[tuple[str, object], int]:
        kind = tokens[at]
        if tokens[at + 1 : at + 2] != ["<"]:
            return (kind, None), at + 1
        at += 2
        if kind == "ARRAY":
            inner, at = take(at)
            return (kind, inner), at + 1
        fields = {}
        while tokens[at] != ">":
            name = tokens[at][1:-1].replace("``", "`") if tokens[at].startswith("`") else tokens[at]
            fields[name], at = take(at + 2)
            at += tokens[at] == ","
        return (kind, fields), at + 1

    return take(0)[0]


def json_tables(df: DataFrame, key: str, column: str) -> dict[str, DataFrame]:
    """A column of JSON text as flat tables named by path: one row for each record, and each array level as child_tables gives it.

    The merged schema of all rows is walked. Members of objects become columns with names joined by '_'. Where some rows have
    an array and others an object alone, the member is an array level (see json_list) whose elements are merged again. A
    member with values of kinds that don't merge stays JSON text in one column, and so does a single value beside arrays.
    """
    out: dict[str, DataFrame] = {}

    def text(at: Column) -> Column:
        return F.when(~F.is_variant_null(at), F.to_json(at))

    def fields(rows: DataFrame, at: Column, kind: tuple, path: str, prefix: str) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, tuple]]]:
        name, inner = kind
        if name == "OBJECT":
            members = F.try_variant_get(at, "$", "map<string,variant>")
            parts = [fields(rows, members[n], k, f"{path}.{n}", f"{prefix}{'_' if prefix else ''}{n}") for n, k in inner.items()]
            return [c for own, _ in parts for c in own], [x for _, lists in parts for x in lists]
        if name == "ARRAY":
            return [], [(path, at, inner)]
        if name != "VARIANT":
            return [(prefix or "value", F.lit(None).cast("string") if name == "VOID" else F.try_variant_get(at, "$", name.lower()))], []
        shape = F.schema_of_variant(at)
        found = rows.select(F.max(shape.startswith("ARRAY")).alias("array"), F.max(~shape.rlike("^(ARRAY|OBJECT|VOID)")).alias("single")).first()
        if not found.array:
            return [(prefix or "value", text(at))], []
        merged = rows.select(F.explode(json_list(at, "$")).alias("e")).select(F.schema_of_variant_agg("e")).first()[0]
        return [(prefix or "value", F.when(~shape.rlike("^(ARRAY|OBJECT)"), text(at)))] * bool(found.single), [(path, at, _parsed(merged))]

    def walk(rows: DataFrame, kind: tuple, path: str, own: list[str], carried: dict[str, Column] | None) -> None:
        columns, lists = fields(rows, F.col("item"), kind, path, "")
        taken, named = set(own), []
        for n, c in columns:
            while n.lower() in taken:
                n += "_value"
            taken.add(n.lower())
            named.append(c.alias(n))
        if named or carried:
            out[path] = rows.select(*own, *named)
        for at, value, element in lists:
            at = f"{at}[]" if at in out and at == path else at
            walk(child_table(rows, "record_no", json_list(value, "$"), at, carried), element, at, ["record_no", "parent_key", "row_key", "parent_pos", "child_pos"], {"parent_key": F.col("row_key"), "parent_pos": F.col("child_pos")})

    base = df.select(F.col(key).alias("record_no"), F.try_parse_json(F.col(column)).alias("item"))
    walk(base, _parsed(json_schema(df, column)), column, ["record_no"], None)
    return out


def links(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("child_kind"), "record_no", F.col("parent_pos").cast("int").alias("parent_pos"), F.col("child_pos").cast("int").alias("child_pos"))
