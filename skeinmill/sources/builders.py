"""Parsed works, talks and hits as canonical records: entities, relations and aliases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinmill.functions import text as X
from skeinmill.operators.merge import merged
from skeinmill.operators.resolve import bounded_authors

ENTITY = ("id", "type", "rdf_type", "name", "identifiers", "properties", "source_refs")
#: RDF classes of record types.
CLASSES = {"Paper": "bibo:AcademicArticle", "Person": "foaf:Person", "Institution": "foaf:Organization", "Concept": "skos:Concept", "Talk": "fabio:Presentation", "Event": "schema:Event", "GraphScope": "schema:Collection"}


def refs(source_id: str, citation_key: Column | None = None, source_url: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit(source_id).alias("source_id"), (citation_key if citation_key is not None else none).alias("citation_key"), (source_url if source_url is not None else none).alias("source_url")))


def props(**values: Column) -> Column:
    """A map of the values that are there."""
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[v.cast("string") for v in values.values()]))
    return F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != ""))


def entity(rows: DataFrame, id_: Column, kind: str, name: Column, identifiers: Column, properties: Column, ref: Column) -> DataFrame:
    pos = F.struct(*[F.col(c) for c in rows.columns if c in ("_doc", "pos")], F.lit(0).alias("_"))
    out = rows.select(pos.alias("_pos"), id_.alias("id"), F.lit(kind).alias("type"), F.lit(CLASSES[kind]).alias("rdf_type"), name.alias("name"), identifiers.alias("identifiers"), properties.alias("properties"), ref.alias("source_refs"))
    # Records repeated within a batch merge by id: the first stands, the last value of each property wins, references unite.
    out = out.withColumn("_tie", F.to_json("properties"))
    return merged(out, "id", ["_pos", "name", "_tie"]).select(*ENTITY)


def edge(rows: DataFrame, s: Column, predicate: str, o: Column, ref: Column) -> DataFrame:
    out = rows.select(s.alias("subject"), F.lit(predicate).alias("predicate"), o.alias("object"), ref.alias("source_refs")).where(F.col("subject").isNotNull() & F.col("object").isNotNull())
    united = out.groupBy("subject", "predicate", "object").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_refs")))).alias("source_refs"))
    return united.select(X.digest_id("relation:", F.col("subject"), F.col("predicate"), F.col("object")).alias("id"), "subject", "predicate", "object", "source_refs")


def alias(rows: DataFrame, kind: str, value: Column, entity_id: Column, ref: Column) -> DataFrame:
    out = rows.select(F.concat(F.lit(f"alias:{kind}:"), X.slug(value)).alias("id"), value.alias("alias"), F.lit(kind).alias("kind"), entity_id.alias("entity_id"), ref.alias("source_refs"))
    return out.where(F.col("alias").isNotNull() & (F.col("alias") != "")).groupBy("id").agg(*[F.min(c).alias(c) for c in ("alias", "kind", "entity_id")], F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_refs")))).alias("source_refs"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def person_id(name: Column) -> Column:
    return F.concat(F.lit("person:name:"), X.slug(name))


def scope_records(members: DataFrame, scopes: DataFrame, source_id: str) -> tuple[DataFrame, DataFrame]:
    """(scopes, edges in both directions) of one ingest's members (J18, J19). ``scopes`` has key, kind and name."""
    from skeinmill.operators.project import scope_edges

    none = F.create_map().cast("map<string,string>")
    rows = entity(scopes, F.concat(F.lit("scope:"), "key"), "GraphScope", F.col("name"), none, props(scope_kind=F.col("kind")), refs(source_id))
    pairs = scope_edges(members, rows)
    both = pairs.select(X.digest_id("relation:", F.col("subject"), F.col("predicate"), F.col("object")).alias("id"), "subject", "predicate", "object", refs(source_id).alias("source_refs"))
    return rows, both


def parse_scope(spec: str) -> tuple[str, str, str]:
    """(key, kind, name) of ``KEY[=KIND:NAME]``."""
    key, _, rest = spec.partition("=")
    kind, _, name = rest.partition(":")
    if not key.strip():
        raise ValueError(f"no key in scope {spec!r}")
    return key.strip(), kind.strip() or "collection", name.strip() or X.title_case(key.strip())


def from_bibtex(entries: DataFrame, source_id: str, source_url: str | None = None) -> dict[str, DataFrame]:
    """Papers, persons, collaborations and subject concepts of parsed entries (G1)."""
    f = lambda k: F.nullif(F.try_element_at("fields", F.lit(k)), F.lit(""))
    arxiv = F.when(F.coalesce(F.lower(f("archiveprefix")), F.lit("arxiv")) == "arxiv", X.arxiv_id(f("eprint")))
    paper = F.coalesce(F.concat(F.lit("paper:doi:"), X.doi(f("doi"))), F.concat(F.lit("paper:arxiv:"), arxiv), F.concat(F.lit("paper:bibtex:"), X.slug(F.col("citation_key"))))
    rows = entries.select("*", paper.alias("paper"), refs(source_id, F.col("citation_key"), F.lit(source_url).cast("string")).alias("ref"))
    ids = F.map_filter(F.map_from_arrays(F.array(F.lit("doi"), F.lit("arxiv")), F.array(X.doi(f("doi")), arxiv)), lambda _, v: v.isNotNull())
    none = F.create_map().cast("map<string,string>")
    properties = props(
        citation_key=F.col("citation_key"), entry_type=F.col("entry_type"), author_list=f("author"), author_list_incomplete=F.when(X.has_others(f("author")), F.lit("true")),
        doi=F.concat(F.lit("https://doi.org/"), X.doi(f("doi"))), arxiv_id=arxiv, publication_year=X.guarded_int(f("year")), journal=f("journal"), volume=f("volume"),
        pages=f("pages"), primary_class=f("primaryclass"), source_url=f("url"),
    )
    clean = F.regexp_replace(f("title"), "[{}]", "")
    authors = rows.select("paper", "ref", *[c for c in ("_doc", "pos") if c in rows.columns], F.explode(X.split_authors(f("author"))).alias("cited"))
    authors = authors.select("*", X.given_first(F.col("cited")).alias("person"))
    groups = rows.where(f("collaboration").isNotNull()).select("paper", "ref", X.with_suffix(f("collaboration")).alias("group"))
    topics = rows.where(f("primaryclass").isNotNull()).select("paper", "ref", f("primaryclass").alias("topic"))
    group_id, topic_id = F.concat(F.lit("institution:name:"), X.slug(F.col("group"))), F.concat(F.lit("concept:arxiv:"), X.slug(F.col("topic")))
    entities = _all([
        entity(rows, F.col("paper"), "Paper", clean, ids, properties, F.col("ref")),
        entity(authors, person_id(F.col("person")), "Person", F.col("person"), none, props(name_as_cited=F.col("cited")), F.col("ref")),
        entity(groups, group_id, "Institution", F.col("group"), none, props(institution_kind=F.lit("collaboration")), F.col("ref")),
    ])
    return {
        "entities": entities,
        "concepts": entity(topics, topic_id, "Concept", F.col("topic"), none, props(notation=F.col("topic"), scheme=F.lit("arXiv taxonomy")), F.col("ref")),
        "relations": _all([
            edge(authors, F.col("paper"), "authored_by", person_id(F.col("person")), F.col("ref")),
            edge(groups, F.col("paper"), "corporate_authored_by", group_id, F.col("ref")),
            edge(topics, F.col("paper"), "about", topic_id, F.col("ref")),
        ]),
        "aliases": _all([
            alias(rows, "bibtex_key", F.col("citation_key"), F.col("paper"), F.col("ref")),
            alias(rows, "doi", X.doi(f("doi")), F.col("paper"), F.col("ref")),
            alias(rows, "arxiv", arxiv, F.col("paper"), F.col("ref")),
            alias(authors, "author_name", F.col("cited"), person_id(F.col("person")), F.col("ref")),
        ]),
    }


def from_talks(talks: DataFrame, source_id: str, event_id: str, event_name: str, prefix: str, source_url: str | None = None, **event: str) -> dict[str, DataFrame]:
    """Event, talks, presenters, affiliations and tracks of a parsed program."""
    ref = refs(source_id, source_url=F.lit(source_url).cast("string"))
    none = F.create_map().cast("map<string,string>")
    rows = talks.select("*", F.concat(F.lit(f"talk:{prefix}:"), X.slug(F.col("title"))).alias("talk"), F.concat(F.lit(f"concept:{prefix}-track:"), X.slug(F.col("track"))).alias("concept"))
    people = rows.select("talk", F.explode("authors").alias("a")).select("talk", F.col("a.name").alias("name"), F.col("a.affiliation").alias("place"))
    placed = people.where(F.col("place").isNotNull())
    place_id = F.concat(F.lit("institution:name:"), X.slug(F.col("place")))
    one = talks.sparkSession.range(1)
    return {
        "entities": _all([
            entity(one, F.lit(event_id), "Event", F.lit(event_name), none, props(**{k: F.lit(v) for k, v in event.items()}) if event else none, ref),
            entity(rows, F.col("talk"), "Talk", F.col("title"), none, props(description=F.col("abstract"), source_url=F.lit(source_url).cast("string")), ref),
            entity(people, person_id(F.col("name")), "Person", F.col("name"), none, none, ref),
            entity(placed, place_id, "Institution", F.col("place"), none, props(institution_kind=F.lit("research institution")), ref),
        ]),
        "concepts": entity(rows, F.col("concept"), "Concept", F.col("track"), none, props(scheme=F.lit(f"{event_name} parallel session"), description=F.concat(F.lit("Track: "), "track")), ref),
        "relations": _all([
            edge(rows, F.col("talk"), "presented_at", F.lit(event_id), ref),
            edge(rows, F.col("talk"), "about", F.col("concept"), ref),
            edge(people, F.col("talk"), "presented_by", person_id(F.col("name")), ref),
            edge(placed, person_id(F.col("name")), "affiliated_with", place_id, ref),
        ]),
        "aliases": alias(people, "author_name", F.col("name"), person_id(F.col("name")), ref),
    }


def from_hits(hits: DataFrame, source_id: str, researcher: str | None = None) -> dict[str, DataFrame]:
    """Papers and bounded authors of literature hits (G6); ``researcher`` is listed before all others."""
    get = lambda k: F.try_element_at("identifiers", F.lit(k))
    paper = F.coalesce(F.concat(F.lit("paper:doi:"), X.doi(get("doi"))), F.concat(F.lit("paper:arxiv:"), X.arxiv_id(get("arxiv"))), F.concat(F.lit("paper:inspire:"), "recid"))
    listed = F.array_join("authors", "; ")
    rows = hits.select("*", paper.alias("paper"), listed.alias("author_list"), refs(source_id, F.col("citation_key")).alias("ref"))
    none = F.create_map().cast("map<string,string>")
    first = X.name_key(F.col("author")) == researcher.lower() if researcher else None
    people = bounded_authors(rows, "author_list", "paper", full_up_to=0, first=6, always_first=first).join(rows.select(F.col("paper").alias("id"), "ref"), "id")
    return {
        "entities": _all([
            entity(rows, F.col("paper"), "Paper", X.clean_title(F.col("title")), F.col("identifiers"), props(citation_key=F.col("citation_key"), publication_year=F.col("year"), journal=F.col("journal"), author_list=F.col("author_list"), author_count=F.size("authors"), description=F.col("description"), citation_count=F.col("citation_count")), F.col("ref")),
            entity(people, person_id(F.col("author")), "Person", F.col("author"), none, props(name_as_cited=F.col("author")), F.col("ref")),
        ]),
        "relations": edge(people, F.col("id"), "authored_by", person_id(F.col("author")), F.col("ref")),
        "aliases": alias(rows, "inspire_key", F.col("citation_key"), F.col("paper"), F.col("ref")),
    }


def from_works(works: DataFrame, existing: DataFrame, source_id: str) -> dict[str, DataFrame]:
    """Papers of a researcher's works, under the id of the paper that their identifiers lead to, if any."""
    from skeinmill.operators.resolve import identifier_index, resolved

    get = lambda k: F.try_element_at("identifiers", F.lit(k))
    found = resolved(works, "put_code", "identifiers", identifier_index(existing)).withColumnRenamed("id", "known")
    rows = works.join(found, "put_code")
    paper = F.coalesce("known", F.concat(F.lit("paper:doi:"), X.doi(get("doi"))), F.concat(F.lit("paper:arxiv:"), X.arxiv_id(get("arxiv"))), X.digest_id("paper:orcid:", F.lit("orcid"), F.col("put_code")))
    rows = rows.select("*", paper.alias("paper"), refs(source_id).alias("ref"))
    return {
        "entities": entity(rows, F.col("paper"), "Paper", F.col("title"), F.col("identifiers"), props(entry_type=F.col("entry_type"), publication_year=F.col("year")), F.col("ref")),
        "aliases": alias(rows, "orcid_work", F.col("put_code"), F.col("paper"), F.col("ref")),
    }
