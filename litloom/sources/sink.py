"""Columnar upsert tables: coercion, schemas by name, shards, dead letters."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litloom.runtime import drop, materialize


def coerced(rows: DataFrame, weight: str = "section_weight") -> DataFrame:
    """Payload columns as a sink stores them: empty lists become null, structs, maps and lists of these become JSON text; the weight is a double, 0 if it is none."""
    out = []
    for f in rows.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if f.name == weight:
            c = F.when(c.isNotNull(), F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0)))
        elif isinstance(kind, (T.StructType, T.MapType)) or isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.MapType, T.ArrayType)):
            c = F.when(F.size(c) > 0, F.to_json(c, {"ignoreNullFields": "false"})) if isinstance(kind, T.ArrayType) else F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(kind, T.ArrayType):
            c = F.when(F.size(c) > 0, c)
        out.append(c.alias(f.name))
    return rows.select(*out)


def union_of_keys(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; a column that a part lacks is null there, columns are in order of name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def inferred_type(kinds: Column) -> Column:
    """The type of a column from the set of kinds its non-null values have: bool, int, float, list (of strings), other."""
    only = lambda *k: (F.size(kinds) > 0) & (F.size(F.array_except(kinds, F.array(*map(F.lit, k)))) == 0)
    return F.when(only("bool"), "bool").when(only("int"), "int").when(only("int", "float"), "float").when(only("list"), "[]string").otherwise("string")


def checked_vectors(rows: DataFrame, vector: str, size: int) -> DataFrame:
    """rows with `vector_ok`: whether the vector has the declared size and no missing component."""
    return rows.withColumn("vector_ok", F.coalesce((F.size(vector) == size) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)), F.lit(False)))


# Columns whose type a sink fixes by name. Fixed values.
_NAMED_TYPES = {
    **dict.fromkeys(("year", "evidence_level", "chunk_index", "total_chunks", "table_count", "token_count"), "int"),
    **dict.fromkeys(("section_weight", "ingestion_timestamp"), "float"),
    **dict.fromkeys(("is_table", "is_author_manuscript", "has_full_text", "is_open_access", "has_tables", "is_gov_affiliated", "has_structured_abstract"), "bool"),
    **dict.fromkeys(("keywords", "mesh_terms", "publication_type", "active_ingredients", "gov_agencies"), "[]string"),
}
_UNFILTERED = ("abstract_structured", "mesh_terms_full", "keywords_full", "publication_types_full", "journal_full", "publication_date", "other_ids", "abstract", "full_section_text", "text_preview", "journal", "section_title", "section_id", "table_caption")
_SEARCHED = {
    "page_content": {"type": "string", "full_text_search": {"tokenizer": "word_v3", "language": "english", "stemming": True, "remove_stopwords": True}, "filterable": False},
    "title": {"type": "string", "full_text_search": True, "filterable": False},
    "drug_name": {"type": "string", "full_text_search": True, "filterable": True},
}
_SPARK_TYPES = {T.BooleanType: "bool", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "int", T.FloatType: "float", T.DoubleType: "float", T.DecimalType: "float"}


def schema_by_name(columns: T.StructType, vector_size: int = 1024) -> dict[str, object]:
    """What a service is told of each column: by its name where that says it, else by its Spark type; other types are strings."""
    out: dict[str, object] = {}
    for f in columns.fields:
        kind = f.dataType
        if f.name == "id":
            out[f.name] = "uuid"
        elif f.name == "vector":
            out[f.name] = {"type": f"[{vector_size}]f16", "ann": True}
        elif f.name in _SEARCHED:
            out[f.name] = _SEARCHED[f.name]
        elif f.name in _UNFILTERED:
            out[f.name] = {"type": "string", "filterable": False}
        else:
            out[f.name] = _NAMED_TYPES.get(f.name) or ("[]string" if isinstance(kind, T.ArrayType) else _SPARK_TYPES.get(type(kind), "string"))
    return out


class Table:
    """A Parquet table keyed by id, cut into shards by the hash of the key.

    An upsert writes new files for the shards it touches, then a manifest that names the files of all shards. A manifest is
    written under another name and renamed, and a rename over an existing one fails: so readers see the old table or the new
    one, a crash leaves the old one whole, and of two upserts at once the second fails. Files that no manifest of the last
    `keep` names are deleted by vacuum(). A table's number of shards is that of its first upsert.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str = "id", shards: int = 1):
        self.spark, self.folder, self.key, self.shards = spark, folder.rstrip("/"), key, max(1, shards)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        held = self._manifest()
        if held:
            self.shards = held["shards"]

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.folder}/{folder}")
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _versions(self) -> list[int]:
        return [int(n[:8]) for n in self._names("manifests") if n.endswith(".json") and n[:8].isdigit()]

    def _manifest(self, version: int | None = None) -> dict | None:
        found = self._versions()
        if not found:
            return None
        at = version if version is not None else found[-1]
        stream = self._fs.open(self._path(f"{self.folder}/manifests/{at:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        draft, final = (self._path(f"{self.folder}/manifests/{n}") for n in (f"draft-{uuid.uuid4().hex}", f"{manifest['version']:08d}.json"))
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError("another upsert has written this version")

    def _read(self, files: list[str]) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.folder}/{f}" for f in files]) if files else None

    def read(self) -> DataFrame | None:
        held = self._manifest()
        return self._read(sorted(held["files"].values())) if held else None

    def upsert(self, rows: DataFrame, order: str | None = None) -> int:
        """Of rows with the same id in one call the first in `order` holds, without it the first as they are read; a later call replaces earlier rows.

        Rows with a null or blank id are all kept. Gives the number of rows of the call that are now in the table.
        """
        from litloom.operators.incremental import keep_first

        held = self._manifest() or {"version": 0, "shards": self.shards, "files": {}}
        own = [F.col(f"`{c}`") for c in rows.columns]
        place = F.col(order) if order else F.monotonically_increasing_id()
        told = materialize(rows.withColumn("_order", F.struct(place.alias("o"), F.xxhash64(F.to_json(F.struct(*own))).alias("h"))).withColumn("_shard", F.pmod(F.xxhash64(self.key), F.lit(self.shards)).cast("int")), "upsert")
        first = keep_first(told, self.key, "_order").drop("_order")
        blank = F.col(self.key).isNull() | (F.trim(self.key) == "")
        new = first.filter(~blank).dropDuplicates([self.key]).unionByName(first.filter(blank))
        touched = [r[0] for r in told.select("_shard").distinct().collect()]  # one row for each shard at most
        if not touched:
            return 0
        old = self._read([held["files"][str(i)] for i in touched if str(i) in held["files"]])
        whole = new
        if old is not None:
            stays = old.join(new.select(self.key).distinct(), self.key, "left_anti")
            whole = union_of_keys(new, stays.withColumn("_shard", F.pmod(F.xxhash64(self.key), F.lit(self.shards)).cast("int")))
        data = f"data/{uuid.uuid4().hex}"
        count = new.count()
        # a shard that an upsert touches is written by as many tasks as the shuffle has, not by one
        whole.write.partitionBy("_shard").parquet(f"{self.folder}/{data}")
        self._commit({"version": held["version"] + 1, "shards": self.shards, "files": held["files"] | {str(i): f"{data}/_shard={i}" for i in touched}})
        drop(told)
        return count

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the manifests before the last `keep`, and files that the others don't name. Not while an upsert runs."""
        versions = self._versions()
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/manifests/{v:08d}.json"), False)
        named = {f.split("/")[1] for v in versions[-keep:] for f in self._manifest(v)["files"].values()}
        gone = [d for d in self._names("data") if d not in named]
        for d in gone:
            self._fs.delete(self._path(f"{self.folder}/data/{d}"), True)
        return gone


def append_json(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").json(folder)


def guarded_drop(spark: SparkSession, folder: str, name: str, protected: list[str], confirm: str) -> dict:
    """Delete a table's folder only if it is not protected and its name is repeated; says what was done."""
    if any(name == p or name.startswith(p) for p in protected):
        return {"name": name, "dropped": False, "reason": "protected"}
    if confirm != name:
        return {"name": name, "dropped": False, "reason": "not confirmed"}
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    done = where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return {"name": name, "dropped": bool(done), "reason": "" if done else "not found"}
