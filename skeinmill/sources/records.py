"""JSON records, JSON documents and Parquet tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REFS = "array<struct<source_id:string, citation_key:string, source_url:string, put_code:string, inspire_recid:string, inspire_author_recid:string, evidence_source_id:string, evidence_url:string>>"
SCHEMAS = {
    "entities": f"id string, type string, rdf_type string, name string, identifiers map<string,string>, properties map<string,string>, source_refs {REFS}",
    "relations": f"id string, subject string, predicate string, object string, source_refs {REFS}",
    "aliases": f"id string, alias string, kind string, entity_id string, source_refs {REFS}",
}
SCHEMAS["concepts"] = SCHEMAS["scopes"] = SCHEMAS["entities"]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def jsonl(spark: SparkSession, path: str, schema: str, *, strict: bool = True, missing: str = "error") -> DataFrame:
    """Records of JSON lines.

    ``missing`` is ``error`` or ``empty``. ``strict`` makes a line that is no JSON
    object, or has no id, an error when it is read; otherwise such a line is
    a row of nulls. Blank lines are no records.
    """
    if missing == "empty" and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    if not strict:
        return spark.read.schema(schema).json(path)
    bad = "_corrupt"
    rows = spark.read.schema(f"{schema}, {bad} string").option("columnNameOfCorruptRecord", bad).json(path)
    broken = F.col(bad).isNotNull() | F.col("id").isNull() | (F.col("id") == "")
    # The failing row names itself; there is no second pass over the file.
    said = F.concat(F.lit(f"{path}: not a record with an id: "), F.coalesce(bad, F.to_json(F.struct(*[c for c in rows.columns if c != bad]))))
    checked = rows.withColumn("id", F.when(broken, F.raise_error(said)).otherwise(F.col("id")))
    return checked.drop(bad)


def json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Items of files that hold one JSON array each."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", True).json(path)


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def query_files(folder: str) -> list[tuple[str, str, str]]:
    """(name, leading comments, query) of the ``.rq`` files of a folder, by name."""
    out = []
    for p in sorted(Path(folder).glob("**/*.rq")):
        lines = p.read_text().splitlines()
        k = next((i for i, x in enumerate(lines) if not x.startswith("#")), len(lines))
        out.append((p.name, "\n".join(x.lstrip("# ") for x in lines[:k]), "\n".join(lines[k:]).strip()))
    return out


def tag_vocabulary(store: DataFrame) -> DataFrame:
    """(key, name) of the tags of a store snapshot that are not archived."""
    return store.where(~F.coalesce("archived", F.lit(False)) & (F.col("type_key") == "tag")).select("key", "name").distinct()


def live_objects(store: DataFrame, types: list[str]) -> DataFrame:
    """Objects of the given types that are not archived."""
    return store.where(~F.coalesce("archived", F.lit(False)) & F.col("type_key").isin(*types))


def empty(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMAS[kind]))
