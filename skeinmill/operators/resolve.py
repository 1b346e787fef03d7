"""Resolving identifiers, titles and authors of incoming works against the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinmill.functions import text as X
from skeinmill.functions.cells import is_filler

#: Order in which identifiers name a paper.
PRECEDENCE = ("doi", "arxiv", "ads")


def normal_identifier(kind: Column, value: Column) -> Column:
    """An identifier in comparable form, by its kind."""
    return F.when(kind == "doi", X.doi(value)).when(kind == "arxiv", X.arxiv_id(value)).otherwise(F.trim(value))


def identifier_index(entities: DataFrame, key: str = "id", identifiers: str = "identifiers") -> DataFrame:
    """(kind, value, id): which entity an identifier leads to; of several the greatest id."""
    rows = entities.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.explode(identifiers).alias("kind", "raw")).where(~is_filler(F.col("raw")))
    return rows.select("kind", normal_identifier(F.col("kind"), F.col("raw")).alias("value"), "id").groupBy("kind", "value").agg(F.max("id").alias("id"))


def resolved(works: DataFrame, key: str, identifiers: str, index: DataFrame, order: tuple[str, ...] = PRECEDENCE) -> DataFrame:
    """(key, id): the existing entity of each work, by its first identifier in ``order`` that leads to one.

    One join on (kind, value) and a minimum by precedence, whatever the number of
    kinds; works without a hit keep a null id.
    """
    rank = F.create_map(*[x for k, o in enumerate(order) for x in (F.lit(o), F.lit(k))])
    wanted = works.select(F.col(key), F.explode(identifiers).alias("kind", "raw")).where(F.col("kind").isin(*order) & ~is_filler(F.col("raw")))
    hits = wanted.select(key, "kind", normal_identifier(F.col("kind"), F.col("raw")).alias("value")).join(index, ["kind", "value"])
    best = hits.groupBy(key).agg(F.min(F.struct(rank[F.col("kind")].alias("r"), "id")).alias("b")).select(key, F.col("b.id").alias("id"))
    return works.select(key).distinct().join(best, key, "left")


def ambiguous_identifiers(entities: DataFrame, key: str = "id", identifiers: str = "identifiers") -> DataFrame:
    """(kind, value, n): identifiers that lead to more than one entity (J3's guard)."""
    rows = entities.select(F.col(key).alias("id"), F.explode(identifiers).alias("kind", "raw")).where(~is_filler(F.col("raw")))
    return rows.select("kind", normal_identifier(F.col("kind"), F.col("raw")).alias("value"), "id").distinct().groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_title_matches(left: DataFrame, right: DataFrame, title: str = "name", key: str = "id") -> DataFrame:
    """(left_id, right_id): records whose normalised titles are equal, where the title leads to one record only."""
    one = right.where(F.col(title).isNotNull()).select(X.title_key(F.col(title)).alias("t"), F.col(key).alias("right_id")).distinct()
    one = one.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("right_id").alias("right_id")).where((F.col("n") == 1) & (F.col("t") != ""))
    return left.where(F.col(title).isNotNull()).select(F.col(key).alias("left_id"), X.title_key(F.col(title)).alias("t")).distinct().join(one, "t").select("left_id", "right_id").distinct()


def paper_identity(identifiers: str = "identifiers", key: str = "id") -> Column:
    """DOI, else arXiv id, else the record's own id."""
    get = lambda k: F.when(~is_filler(F.try_element_at(identifiers, F.lit(k))), F.try_element_at(identifiers, F.lit(k)))
    return F.coalesce(F.concat(F.lit("doi:"), X.doi(get("doi"))), F.concat(F.lit("arxiv:"), X.arxiv_id(get("arxiv"))), F.col(key))


def best_records(papers: DataFrame, score: Column, identity: Column, key: str = "id") -> DataFrame:
    """(identity, id, n): per identity the record with the highest score, of equals the greatest key, and how many there were."""
    rows = papers.select(identity.alias("identity"), F.col(key).alias("id"), score.alias("score"))
    return rows.groupBy("identity").agg(F.max(F.struct("score", "id")).alias("b"), F.count(F.lit(1)).alias("n")).select("identity", F.col("b.id").alias("id"), "n")


def bounded_authors(papers: DataFrame, authors: str, key: str = "id", count: str | None = None, full_up_to: int = 20, first: int = 5, exclude: str = r"(?i)\scollaboration$", always_first: Column | None = None, without: Column | None = None) -> DataFrame:
    """(id, position, author): the first distinct authors of a ``;`` list.

    All of them where ``count`` is known and at most ``full_up_to``, else ``first``.
    Corporate names and empty items are no authors, nor is who ``without`` marks; ``always_first``
    marks the one that is listed before all others.
    """
    names = F.filter(X.split_list(F.col(authors)), lambda a: ~a.rlike(exclude))
    rows = papers.select(F.col(key).alias("id"), *([F.col(count).alias("_n")] if count else [F.lit(None).cast("bigint").alias("_n")]), F.posexplode(names).alias("_pos", "author"))
    rows = rows.withColumn("author", X.given_first(F.col("author"))).groupBy("id", "author").agg(F.min("_pos").alias("_pos"), F.max("_n").alias("_n"))
    if without is not None:
        rows = rows.where(~F.coalesce(without, F.lit(False)))
    front = F.when(always_first, 0).otherwise(1) if always_first is not None else F.lit(0)
    rows = rows.withColumn("position", F.row_number().over(Window.partitionBy("id").orderBy(front, "_pos")))
    limit = F.when(F.col("_n").between(0, full_up_to), F.lit(2**31 - 1)).otherwise(F.lit(first))
    return rows.where(F.col("position") <= limit).select("id", "position", "author")


def is_researcher(name: Column, surname: str, given: list[str]) -> Column:
    """Whether a cited name, in either order, is the researcher's: the surname with one of the given forms."""
    key = X.name_key(X.given_first(name))
    return F.coalesce(key.isin(*[f"{g} {surname}".lower() for g in given]), F.lit(False))


def author_edges(authors: DataFrame, source_id: str) -> DataFrame:
    """Derived edges from papers (id) to their bounded authors (author), as canonical relations."""
    person = F.concat(F.lit("person:name:"), X.slug(F.col("author")))
    rows = authors.select(F.col("id").alias("subject"), F.lit("authored_by").alias("predicate"), person.alias("object")).distinct()
    return rows.select(X.digest_id("relation:", F.col("subject"), F.col("predicate"), F.col("object")).alias("id"), "subject", "predicate", "object", F.lit(source_id).alias("source_id"))


def author_position(names: Column, aliases: list[str]) -> Column:
    """1-based place of the first author with one of ``aliases``, null if absent."""
    known = [a.lower() for a in aliases]
    at = F.array_position(F.transform(X.split_list(names), lambda a: X.name_key(a).isin(*known)), F.lit(True))
    return F.when(at > 0, at)


def is_corporate(title: Column, names: Column, markers: list[str], prefix: str) -> Column:
    """A marker stands among the authors, or the title begins with the series' name as a word."""
    known = F.array(*[F.lit(m.lower()) for m in markers])
    listed = F.arrays_overlap(F.transform(X.split_list(names), lambda a: X.name_key(a)), known)
    return F.coalesce(listed, F.lit(False)) | F.coalesce(title.rlike(rf"(?i)^{prefix}\b"), F.lit(False))


def corporate_edges(papers: DataFrame, flag: Column, institution: str, source_id: str, key: str = "id") -> DataFrame:
    """Derived edges from corporate papers to their institution."""
    rows = papers.where(flag).select(F.col(key).alias("subject")).distinct()
    return rows.select(
        X.digest_id("relation:", F.col("subject"), F.lit("corporate_authored_by"), F.lit(institution)).alias("id"),
        "subject", F.lit("corporate_authored_by").alias("predicate"), F.lit(institution).alias("object"), F.lit(source_id).alias("source_id"),
    )


def researcher_class(corporate: Column, position: Column) -> Column:
    """Ordered classes of a researcher's papers (P23): own, leading or wider collaboration."""
    return F.when(~corporate, "personal").when(position <= 10, "core").otherwise("collab")
