"""Canonical records as RDF quads of encoded terms."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinmill.functions.text import percent_encoded
from skeinmill.sparql.compiler import Dataset
from skeinmill.sparql.parser import RDF_TYPE
from skeinmill.sparql.terms import SOH, iri_of

#: Prefixes of records' compact IRIs; ``pkg`` and the bases are this engine's own and can be replaced.
NAMESPACES = {
    "foaf": "http://xmlns.com/foaf/0.1/",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "bibo": "http://purl.org/ontology/bibo/",
    "fabio": "http://purl.org/spar/fabio/",
    "schema": "https://schema.org/",
    "prov": "http://www.w3.org/ns/prov#",
    "pkg": "https://skeinmill.example/ontology/",
    "resource": "https://skeinmill.example/resource/",
    "source": "https://skeinmill.example/source/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
}


def resource(col: Column, base: str) -> Column:
    """The IRI term of a record id."""
    return F.concat(F.lit("u" + base), percent_encoded(col))


def expanded(col: Column, namespaces: dict[str, str]) -> Column:
    """The IRI term of ``prefix:local``; an error for an unknown prefix, null for null and "" (P3)."""
    prefix, local = F.substring_index(col, ":", 1), F.substring(col, F.locate(":", col) + 1, F.length(col))
    base = F.try_element_at(F.create_map(*[F.lit(x) for kv in namespaces.items() for x in kv]), prefix)
    known = F.when(base.isNull(), F.raise_error(F.concat(F.lit("unknown prefix in "), col))).otherwise(iri_of(F.concat(base, local)))
    return F.when(col.isNotNull() & (col != ""), known)


def _literal(col: Column, kind: T.DataType) -> Column:
    """A typed literal term; null for null and "" (F26)."""
    if isinstance(kind, T.StringType):
        return F.when(col != "", F.concat(F.lit("s"), col))
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return F.concat(F.lit("i"), col.cast("string"))
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.concat(F.lit("f"), col.cast("string"))
    if isinstance(kind, T.BooleanType):
        return F.concat(F.lit("b"), col.cast("string"))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit(f"thttp://www.w3.org/2001/XMLSchema#{'date' if isinstance(kind, T.DateType) else 'dateTime'}{SOH}"), col.cast("string"))
    return F.concat(F.lit("s"), F.to_json(col))


def _graphs(base: str) -> Column:
    """One graph per source of the record; null, the default graph, without one."""
    ids = F.array_distinct(F.filter(F.transform("source_refs", lambda r: r["source_id"]), lambda x: x.isNotNull() & (x != "")))
    return F.explode_outer(F.transform(ids, lambda x: F.concat(F.lit("u" + base), percent_encoded(x))))


def _graph(base: str, wanted: bool) -> list[Column]:
    return [_graphs(base).alias("g")] if wanted else []


def record_quads(records: DataFrame, namespaces: dict[str, str], only: str | None = None, graphs: bool = True) -> DataFrame | None:
    """Quads of entities, concepts or scopes: canonical id, type, name and every filled property, one pass over the table.

    With ``only``, an encoded predicate, those of that predicate alone, reading just
    its column; None if no record can have it. Without ``graphs`` a row is not repeated for each of its sources.
    """
    ns = namespaces
    facts = {
        ns["pkg"] + "canonical_id": F.concat(F.lit("s"), F.col("id")),
        RDF_TYPE: expanded(F.col("rdf_type"), ns),
        ns["schema"] + "name": _literal(F.col("name"), T.StringType()),
    }
    if "properties" in records.columns:
        facts |= {ns["pkg"] + f.name: _literal(F.col("properties")[f.name], f.dataType) for f in records.schema["properties"].dataType.fields}
    own = records.where(F.col("id").isNotNull())
    g, s = _graph(ns["source"], graphs), resource(F.col("id"), ns["resource"]).alias("s")
    if only is not None:
        if only[1:] not in facts:
            return None
        o = facts[only[1:]]
        return own.where(o.isNotNull()).select(*g, s, F.lit(only).alias("p"), o.alias("o"))
    pairs = F.filter(F.array(*[F.struct(F.lit("u" + p).alias("p"), o.alias("o")) for p, o in facts.items()]), lambda x: x["o"].isNotNull())
    at = ["g", "s"] if graphs else ["s"]
    return own.select(*g, s, pairs.alias("facts")).select(*at, F.explode("facts").alias("x")).select(*at, "x.p", "x.o")


def edge_quads(relations: DataFrame, namespaces: dict[str, str], only: str | None = None, graphs: bool = True) -> DataFrame | None:
    """Quads of relations; edges with a null or blank end or predicate are none."""
    ns = namespaces
    base = "u" + ns["pkg"]
    rows = relations
    for c in ("subject", "predicate", "object"):
        rows = rows.where(F.col(c).isNotNull() & (F.trim(F.col(c)) != ""))
    if only is not None:
        if not only.startswith(base):
            return None
        rows = rows.where(F.col("predicate") == only.removeprefix(base))
    return rows.select(
        *_graph(ns["source"], graphs),
        resource(F.col("subject"), ns["resource"]).alias("s"),
        F.concat(F.lit(base), F.col("predicate")).alias("p"),
        resource(F.col("object"), ns["resource"]).alias("o"),
    )


def alias_quads(aliases: DataFrame, namespaces: dict[str, str], only: str | None = None, graphs: bool = True) -> DataFrame | None:
    """Quads of aliases: alternate names of their entities."""
    ns = namespaces
    p = "u" + ns["schema"] + "alternateName"
    if only not in (None, p):
        return None
    return aliases.where((F.col("alias") != "") & (F.col("entity_id") != "")).select(
        *_graph(ns["source"], graphs),
        resource(F.col("entity_id"), ns["resource"]).alias("s"),
        F.lit(p).alias("p"),
        F.concat(F.lit("s"), F.col("alias")).alias("o"),
    )


class RecordGraph(Dataset):
    """A dataset read straight from canonical tables: a bound predicate reads only the columns that can hold it."""

    def __init__(self, records: list[DataFrame], relations: DataFrame, aliases: DataFrame, namespaces: dict[str, str] | None = None) -> None:
        self.tables = (records, relations, aliases)
        self.ns = {**NAMESPACES, **(namespaces or {})}
        self.spark = relations.sparkSession

    @cached_property
    def quads(self) -> DataFrame:
        return self._union(None)

    def _union(self, only: str | None, graphs: bool = True) -> DataFrame | None:
        records, relations, aliases = self.tables
        parts = [edge_quads(relations, self.ns, only, graphs), alias_quads(aliases, self.ns, only, graphs), *[record_quads(t, self.ns, only, graphs) for t in records]]
        parts = [p for p in parts if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def with_predicate(self, p: str) -> DataFrame:
        rows = self._union(p)
        return self.spark.createDataFrame([], "g string, s string, p string, o string") if rows is None else rows

    def triples(self, p: str | None = None) -> DataFrame:
        rows = self._union(p, False)
        return self.spark.createDataFrame([], "s string, p string, o string") if rows is None else rows


def quads(records: list[DataFrame], relations: DataFrame, aliases: DataFrame, namespaces: dict[str, str] | None = None) -> DataFrame:
    """(g, s, p, o) of the whole graph."""
    return RecordGraph(records, relations, aliases, namespaces).quads


def write_quads(rows: DataFrame, path: str) -> None:
    """Quads as Parquet partitioned by predicate, which turns a bound predicate into partition pruning."""
    rows.distinct().repartition(F.col("p"), F.pmod(F.xxhash64("s"), F.lit(32))).write.mode("overwrite").partitionBy("p").parquet(path)


def quad_counts(rows: DataFrame) -> DataFrame:
    """(triples, named_graphs) of a graph."""
    triples = rows.select("s", "p", "o").distinct().agg(F.count(F.lit(1)).alias("triples"))
    graphs = rows.where(F.col("g").isNotNull()).select("g").distinct().agg(F.count(F.lit(1)).alias("named_graphs"))
    return triples.crossJoin(F.broadcast(graphs))


def trig_lines(rows: DataFrame) -> DataFrame:
    """(g, line): every quad as a TriG statement inside its graph's block, for ``write_trig`` (K3)."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit('"'))
    kind, body = F.substring("o", 1, 1), F.substring(F.col("o"), F.lit(2), F.length("o"))
    iri = lambda c: F.concat(F.lit("<"), F.substring(c, F.lit(2), F.length(c)), F.lit(">"))
    tag, tail = F.substring_index(body, SOH, 1), F.substring_index(body, SOH, -1)
    xsd = "http://www.w3.org/2001/XMLSchema#"
    typed = lambda dt: F.concat(quote(body), F.lit(f"^^<{xsd}{dt}>"))
    o = (
        F.when(kind == "u", iri(F.col("o"))).when(kind == "i", typed("integer")).when(kind == "d", typed("decimal")).when(kind == "f", typed("double"))
        .when(kind == "b", typed("boolean")).when(kind == "l", F.concat(quote(tail), F.lit("@"), tag))
        .when(kind == "t", F.concat(quote(tail), F.lit("^^<"), tag, F.lit(">"))).otherwise(quote(body))
    )
    return rows.distinct().select("g", F.concat(F.when(F.col("g").isNotNull(), F.concat(iri(F.col("g")), F.lit(" { "))).otherwise(""), iri(F.col("s")), F.lit(" "), iri(F.col("p")), F.lit(" "), o, F.when(F.col("g").isNotNull(), " . }").otherwise(" .")).alias("line"))
