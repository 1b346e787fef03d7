"""Projecting the canonical graph into an external store: manifest, checks, and plans of differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinmill.functions import text as X

#: Record types and the keys of their store types.
TYPE_KEYS = {"Person": "person", "Institution": "institution", "Paper": "paper", "Talk": "talk", "Concept": "concept", "Event": "event", "GraphScope": "graph_scope", "Graph Scope": "graph_scope"}
#: Predicates and the store properties that hold them.
RELATION_PROPERTIES = {
    "authored_by": "authored_by", "corporate_authored_by": "corporate_authors", "about": "about", "affiliated_with": "affiliated_with",
    "member_of": "member_of", "broader": "broader", "related_to": "related_to", "presented_by": "presented_by",
    "presented_at": "presented_at", "in_scope": "scopes", "contains": "members",
}
#: Properties that the store knows.
ALLOWED = (
    "description", "orcid", "institution_kind", "ror", "doi", "arxiv_id", "ads_bibcode", "ads_url", "publication_year", "publication",
    "citation_count", "author_count", "ads_keywords", "source_url", "author_list", "skos_uri", "start_date", "end_date", "location", "website", "scope_kind",
)


def mapped(col: Column, table: dict[str, str]) -> Column:
    """A value through a fixed table, null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), col)


def author_preview(names: Column, count: Column, limit: int = 20, first: int = 5) -> Column:
    """The author list, or its first names and how many more there are."""
    items = X.split_list(names)
    kept = F.slice(items, 1, first)
    more = F.concat(F.array_join(kept, "; "), F.lit(" and "), (count - F.size(kept)).cast("string"), F.lit(" additional authors"))
    return F.when((count > limit) & (F.size(items) > 0), more).otherwise(names)


def objects(records: DataFrame) -> DataFrame:
    """(canonical_id, type_key, name, property, value): projected objects, a row per property the store knows."""
    members = [f for f in records.schema["properties"].dataType.fields if f.name in ALLOWED]
    text = lambda f: F.col("properties")[f.name].cast("string")
    scheme = any(f.name == "scheme" for f in records.schema["properties"].dataType.fields)
    cells = []
    for f in members:
        value = text(f)
        if f.name == "description" and scheme:
            value = F.when((value.isNull() | (value == "")) & (F.col("type") == "Concept"), F.concat(F.col("properties.scheme"), F.lit(" concept"))).otherwise(value)
        cells.append(F.when(value != "", F.struct(F.lit(f.name).alias("property"), value.alias("value"))))
    listed = F.filter(F.concat(F.array(F.struct(F.lit("canonical_id").alias("property"), F.col("id").alias("value"))), F.array(*cells)), lambda x: x.isNotNull())
    return (
        records.where(F.col("id").isNotNull() & mapped(F.col("type"), TYPE_KEYS).isNotNull())
        .select(F.col("id").alias("canonical_id"), mapped(F.col("type"), TYPE_KEYS).alias("type_key"), "name", F.explode(listed).alias("x"))
        .select("canonical_id", "type_key", "name", "x.property", "x.value")
    )


def relation_targets(relations: DataFrame) -> DataFrame:
    """(subject, property, object): distinct projected edges; predicates without a store property drop out (P10)."""
    prop = mapped(F.col("predicate"), RELATION_PROPERTIES)
    return relations.where(prop.isNotNull()).select("subject", prop.alias("property"), "object").distinct()


def violations(records: DataFrame, relations: DataFrame) -> DataFrame:
    """(rule, id, n): what keeps a graph from being projected (P22, J16): repeated ids, unknown types, blank names, edges that lead nowhere."""
    ids = records.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    one = lambda df, rule: df.select(F.lit(rule).alias("rule"), "id", "n")
    bad_type = records.where(mapped(F.coalesce("type", F.lit("")), TYPE_KEYS).isNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    blank = records.where(F.coalesce(F.trim("name"), F.lit("")) == "").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    parts = [one(ids.where(F.col("n") > 1), "duplicate id"), one(bad_type, "unknown type"), one(blank, "blank name")]
    for end in ("subject", "object"):
        # Ends are counted before they meet the ids, so a hot end is one row.
        ends = relations.where(F.col(end) != "").groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(one(ends.join(ids.select("id"), "id", "left_anti"), f"dangling {end}"))
    return reduce(DataFrame.unionByName, parts)


def scope_edges(members: DataFrame, scopes: DataFrame) -> DataFrame:
    """(subject, predicate, object): both directions between every member and every scope.

    ``members`` and ``scopes`` have an id; scopes are the few collections of one
    ingest, at most MAX_SCOPES, which is checked before they are broadcast.
    """
    n = scopes.select("id").distinct().count()
    if n > MAX_SCOPES:
        raise ValueError(f"{n} scopes for one ingest; at most {MAX_SCOPES}")
    pairs = members.select("id").distinct().join(F.broadcast(scopes.select(F.col("id").alias("scope")).distinct()), how="cross")
    return pairs.select(F.explode(F.array(
        F.struct(F.col("id").alias("subject"), F.lit("in_scope").alias("predicate"), F.col("scope").alias("object")),
        F.struct(F.col("scope").alias("subject"), F.lit("contains").alias("predicate"), F.col("id").alias("object")),
    )).alias("e")).select("e.*")


MAX_SCOPES = 1_000


def scope_members(relations: DataFrame, predicate: str = "contains") -> DataFrame:
    """(scope, n, first, last): distinct members of each scope, counted and bounded by order."""
    pairs = relations.where((F.col("predicate") == predicate) & (F.col("subject") != "") & (F.col("object") != "")).select("subject", "object").distinct()
    return pairs.groupBy(F.col("subject").alias("scope")).agg(F.count(F.lit(1)).alias("n"), F.min("object").alias("first"), F.max("object").alias("last"))


# Plans: two snapshots in, differences out.


def same_text(a: Column, b: Column) -> Column:
    """Equal as trimmed text, null as "" (P19)."""
    return F.trim(F.coalesce(a.cast("string"), F.lit(""))) == F.trim(F.coalesce(b.cast("string"), F.lit("")))


def same_set(a: Column, b: Column) -> Column:
    """Equal as sets (P20)."""
    norm = lambda x: F.array_sort(F.array_distinct(F.coalesce(x, F.array().cast("array<string>"))))
    return norm(a) == norm(b)


def upsert_plan(desired: DataFrame, live: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """(key, action, reasons): create, update or unchanged per desired record, skip without a key.

    Of several desired or live rows with one key the first by the remaining
    columns counts, so that none is planned twice.
    """
    first = lambda df: df.groupBy(key).agg(F.min(F.struct(*compare)).alias("row")).select(key, *[F.col("row")[c].alias(c) for c in compare])
    want, have = first(desired.where(F.trim(key) != "")), first(live.where(F.trim(key) != "")).select(key, F.lit(True).alias("_live"), *[F.col(c).alias(f"_{c}") for c in compare])
    reasons = F.filter(F.array(*[F.when(~same_text(F.col(c), F.col(f"_{c}")), F.lit(c)) for c in compare]), lambda x: x.isNotNull())
    both = want.join(have, key, "left").withColumn("_why", F.when(F.col("_live"), reasons).otherwise(F.array(F.lit("new"))))
    action = F.when(F.col("_live").isNull(), "create").when(F.size("_why") > 0, "update").otherwise("unchanged")
    planned = both.select(key, action.alias("action"), F.array_join("_why", ",").alias("reasons"))
    skipped = desired.where(F.col(key).isNull() | (F.trim(key) == "")).select(F.col(key), F.lit("skip").alias("action"), F.lit("no key").alias("reasons"))
    return planned.unionByName(skipped)


def reason_histogram(plan: DataFrame) -> DataFrame:
    """(reason, n) of a plan's updates."""
    return plan.where(F.col("action") == "update").select(F.explode(F.split("reasons", ",")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def edge_plan(desired: DataFrame, current: DataFrame, on: list[str]) -> DataFrame:
    """(on..., action): edges to add and to remove so that current becomes desired."""
    a, b = desired.select(*on).distinct(), current.select(*on).distinct()
    return a.join(b, on, "left_anti").withColumn("action", F.lit("add")).unionByName(b.join(a, on, "left_anti").withColumn("action", F.lit("remove")))


def relation_plan(desired: DataFrame, managed: DataFrame, index: DataFrame, current: DataFrame) -> DataFrame:
    """(subject, property, target, action): what makes the store's relations those of the graph.

    ``desired`` has subject, property and object by canonical id, ``managed`` the
    (subject, property) pairs that the graph rules even where it has no target, ``index``
    canonical_id and object_id, ``current`` object_id, property and target by object id. A target without
    an object is ``unresolved``, by its canonical id; where the subject has none, its edges wait as ``no subject``.
    Only managed or desired properties lose targets.
    """
    ids = index.groupBy("canonical_id").agg(F.min("object_id").alias("object_id"))
    side = lambda c, o: ids.select(F.col("canonical_id").alias(c), F.col("object_id").alias(o))
    want = desired.select("subject", "property", "object").distinct().join(side("subject", "_s"), "subject", "left").join(side("object", "_o"), "object", "left")
    have = current.select("object_id", "property", F.col("target").alias("_o")).distinct().join(ids, "object_id").select(F.col("canonical_id").alias("subject"), "property", "_o")
    rules = managed.select("subject", "property").union(desired.select("subject", "property")).distinct()
    sound = want.where(F.col("_s").isNotNull() & F.col("_o").isNotNull()).select("subject", "property", "_o")
    plan = lambda df, target, action: df.select("subject", "property", F.col(target).alias("target"), F.lit(action).alias("action"))
    return (
        plan(sound.join(have, ["subject", "property", "_o"], "left_anti"), "_o", "add")
        .unionByName(plan(have.join(rules, ["subject", "property"], "left_semi").join(sound, ["subject", "property", "_o"], "left_anti"), "_o", "remove"))
        .unionByName(plan(want.where(F.col("_s").isNotNull() & F.col("_o").isNull()), "object", "unresolved"))
        .unionByName(plan(want.where(F.col("_s").isNull()), "object", "no subject"))
    )


def guide_bookmarks(items: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """(guide, url, bookmark_id): each guide's links with the bookmark that has the same trimmed url (J12), null if none has.

    ``items`` has guide and url, ``bookmarks`` url, id and archived; of several live bookmarks the least id counts.
    """
    url = lambda c: F.nullif(F.trim(c), F.lit(""))
    live = bookmarks.where(~F.coalesce("archived", F.lit(False))).groupBy(url("url").alias("url")).agg(F.min("id").alias("bookmark_id"))
    return items.select("guide", url("url").alias("url")).where(F.col("url").isNotNull()).distinct().join(live, "url", "left").select("guide", "url", "bookmark_id")


def page_plan(desired: DataFrame, live: DataFrame) -> DataFrame:
    """(name, page_id, reasons): why each guide's page has to be written, "" if it needn't be.

    Both have name, markdown, tags and related (lists), ``live`` an id too. Pages meet
    by exact trimmed name, of several the least id; lists are compared as sets.
    """
    one = live.groupBy(F.trim("name").alias("name")).agg(F.min(F.struct("id", "markdown", "tags", "related")).alias("p"))
    both = desired.withColumn("name", F.trim("name")).join(one, "name", "left")
    differs = [
        F.when(~same_text(F.col("markdown"), F.col("p.markdown")), F.lit("markdown")), F.when(~same_set(F.col("tags"), F.col("p.tags")), F.lit("tags")),
        F.when(~same_set(F.col("related"), F.col("p.related")), F.lit("related_bookmarks")),
    ]
    why = F.when(F.col("p").isNull(), F.array(F.lit("new"))).otherwise(F.filter(F.array(*differs), lambda x: x.isNotNull()))
    return both.select("name", F.col("p.id").alias("page_id"), F.array_join(why, ",").alias("reasons"))


def archive_plan(pages: DataFrame, prefixes: list[str]) -> DataFrame:
    """(id, name, action): live pages whose name begins with one of ``prefixes``, to be archived."""
    named = reduce(lambda x, y: x | y, [F.col("name").startswith(p) for p in prefixes])
    return pages.where(named & ~F.coalesce("archived", F.lit(False))).select("id", "name", F.lit("archive").alias("action"))


def first_rows(rows: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order``, or all: a trial run's limit."""
    return rows if n is None else rows.orderBy(*order).limit(n)


def member_positions(relations: DataFrame, predicate: str = "contains") -> DataFrame:
    """(scope, position, member): the sorted distinct members of each scope (A26), as rows, so that a scope may have any number."""
    from skeinmill.operators.skew import running_totals

    pairs = relations.where((F.col("predicate") == predicate) & (F.col("subject") != "") & (F.col("object") != "")).select(F.col("subject").alias("scope"), F.col("object").alias("member")).distinct()
    placed = running_totals(pairs.withColumn("one", F.lit(1)), ["scope"], ["member"], "one")
    return placed.select("scope", (F.col("before") + 1).alias("position"), "member")


def manifest(records: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """The whole projection (G9): objects, relations, collections with their sorted members, and the list view of each collection."""
    members = member_positions(relations)
    return {
        "objects": objects(records), "relations": relation_targets(relations), "collections": members,
        "list_views": members.select(F.col("scope").alias("subject"), F.lit("list_view").alias("property"), F.col("member").alias("object")),
    }


def found_missing(wanted: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """(found, missing): how many wanted keys the store has (J21); rows without a key count as neither."""
    keys = wanted.where(F.trim(key) != "").select(key).distinct()
    have = live.where(F.trim(key) != "").select(key).distinct().withColumn("_hit", F.lit(1))
    return keys.join(have, key, "left").agg(F.count("_hit").alias("found"), (F.count(F.lit(1)) - F.count("_hit")).alias("missing"))


def later_duplicates(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Rows that repeat the key of an earlier row (A17); the earliest is a minimum, so a hot key is not sorted."""
    keyed = rows.withColumn("_key", key)
    first = keyed.where(F.col("_key") != "").groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    return keyed.join(first, "_key").where(F.struct(*order) != F.col("_first")).drop("_key", "_first")


def duplicate_names(rows: DataFrame, name: str = "name") -> DataFrame:
    """(name, n) of names that more than one row has."""
    return rows.where(F.trim(name) != "").groupBy(F.trim(name).alias("name")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def fan_out(relations: DataFrame) -> DataFrame:
    """(property, subjects, edges, widest): audit sums of projected edges."""
    per = relation_targets(relations).groupBy("property", "subject").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("property").agg(F.count(F.lit(1)).alias("subjects"), F.sum("n").alias("edges"), F.max("n").alias("widest"))


def schema_plan(desired: DataFrame, live: DataFrame) -> DataFrame:
    """(type_key, property_key, action): create, rename on a different format, or unchanged (J20, K10). Both have type_key, property_key and format."""
    have = live.select("type_key", "property_key", F.col("format").alias("_f"))
    action = F.when(F.col("_f").isNull(), "create").when(F.col("_f") != F.col("format"), "rename").otherwise("unchanged")
    return desired.join(have, ["type_key", "property_key"], "left").select("type_key", "property_key", action.alias("action"))


# Pulling changes of the live store back.


def adopted_concepts(live: DataFrame, known: DataFrame, prefix: str = "concept:store:") -> DataFrame:
    """(object_id, id, action) for live concepts without a canonical id (G11): adopt a new id, or conflict if it is taken.

    ``live`` has object_id, type_key, name and canonical_id. Two live objects that
    lead to one id conflict, but for the first of them.
    """
    new = live.where((F.col("type_key") == "concept") & (F.coalesce("canonical_id", F.lit("")) == "") & (F.trim("name") != ""))
    ids = new.select("object_id", F.concat(F.lit(prefix), X.plain_slug(F.col("name"))).alias("id"))
    first = ids.groupBy("id").agg(F.min("object_id").alias("_first"))
    taken = known.select("id").distinct().withColumn("_taken", F.lit(True))
    return ids.join(first, "id").join(taken, "id", "left").select("object_id", "id", F.when(F.col("_taken") | (F.col("object_id") != F.col("_first")), "conflict").otherwise("adopt").alias("action"))


def pull_edges(live: DataFrame, id_map: DataFrame, known: DataFrame) -> DataFrame:
    """(subject, predicate, object, target, action): edges the store has and the graph lacks.

    ``live`` has object_id, property and target (an edge per row), ``id_map``
    object_id and id, ``known`` the graph's edges. Edges to objects without an id
    are ``unresolved``; nothing is ever removed.
    """
    back = {v: k for k, v in RELATION_PROPERTIES.items()}
    rows = live.withColumn("predicate", mapped(F.col("property"), back)).where(F.col("predicate").isNotNull())
    s, o = id_map.select("object_id", F.col("id").alias("subject")), id_map.select(F.col("object_id").alias("target"), F.col("id").alias("object"))
    linked = rows.join(s, "object_id").join(o, "target", "left").select("subject", "predicate", "object", "target").distinct()
    lost = linked.where(F.col("object").isNull()).withColumn("action", F.lit("unresolved"))
    new = linked.where(F.col("object").isNotNull()).join(known.select("subject", "predicate", "object").distinct(), ["subject", "predicate", "object"], "left_anti")
    return new.withColumn("action", F.lit("add")).unionByName(lost)
