"""REST sources through injected callables, so that tests and offline runs use recorded answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinmill.functions import text as X

#: A callable from a path and parameters to the decoded JSON of an answer.
Get = Callable[[str, dict], dict]

WORKS = "put_code string, entry_type string, title string, year bigint, identifiers map<string,string>, group_no int"
HITS = "recid string, title string, citation_key string, authors array<string>, identifiers map<string,string>, year bigint, journal string, description string, citation_count bigint, page int"
DOCS = "asked string, bibcode string, title string, authors array<string>, identifiers map<string,string>, year bigint, publication string, description string, keywords array<string>, citation_count bigint, n_hits bigint"


class RestError(RuntimeError):
    """An answer that cannot be used."""


def _path(node, *keys):
    for k in keys:
        node = node.get(k) if isinstance(node, dict) else None
    return node.strip() if isinstance(node, str) else node


def _digits(value) -> int | None:
    return int(value) if isinstance(value, int) or (isinstance(value, str) and value.strip().isdigit()) else None


def preferred_summary(group: dict) -> dict | None:
    """The summary with the greatest display index of a group, the first of equals."""
    found = group.get("work-summary") or []
    return max(found, key=lambda s: _digits(s.get("display-index")) or 0, default=None)


def researcher_works(spark: SparkSession, get: Get, orcid: str) -> DataFrame:
    """One row per work group of a researcher (S10). External ids of other relationships than self don't count."""
    rows = []
    for no, group in enumerate(get(f"{orcid}/works", {}).get("group") or []):
        s = preferred_summary(group)
        if not s:
            continue
        ids = {}
        for x in _path(s, "external-ids", "external-id") or []:
            if (x.get("external-id-relationship") or "self").lower() == "self" and x.get("external-id-value"):
                kind = {"doi": "doi", "arxiv": "arxiv", "bibcode": "ads"}.get((x.get("external-id-type") or "").lower())
                if kind:
                    ids.setdefault(kind, x["external-id-value"].strip())
        rows.append((str(s.get("put-code")), s.get("type"), _path(s, "title", "title", "value"), _digits(_path(s, "publication-date", "year", "value")), ids, no))
    return spark.createDataFrame(rows, WORKS)


def literature_hits(spark: SparkSession, get: Get, author: str, size: int = 100, parallel: int = 8) -> DataFrame:
    """All hits of an author (S11): the first page tells how many pages there are, which tasks then fetch in parallel."""
    total = _path(get("literature", {"q": f"a {author}", "size": 1, "page": 1}), "hits", "total") or 0
    pages = spark.range(1, -(-total // size) + 1, numPartitions=max(1, min(parallel, -(-total // size))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for page in pdf["id"]:
                for hit in _path(get("literature", {"q": f"a {author}", "size": size, "page": int(page)}), "hits", "hits") or []:
                    m = hit.get("metadata") or {}
                    first = lambda k, f, m=m: next((x[f] for x in m.get(k) or [] if isinstance(x, dict) and x.get(f)), None)
                    ids = {k: v for k, v in (("doi", first("dois", "value")), ("arxiv", first("arxiv_eprints", "value")), ("inspire", str(hit.get("id")))) if v}
                    rows.append((
                        str(hit.get("id")), first("titles", "title"), next(iter(m.get("texkeys") or []), None), [a.get("full_name") for a in m.get("authors") or []], ids,
                        _digits(first("publication_info", "year")), first("publication_info", "journal_title"), first("abstracts", "value"), _digits(m.get("citation_count")), int(page),
                    ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in HITS.split(", ")])

    return pages.mapInPandas(run, HITS)


def looked_up(rows: DataFrame, key: str, identifiers: str, title: str, get: Get, rows_per_answer: int = 2, rows_per_page: int = 200) -> DataFrame:
    """``key`` and the enriching document of each row (S12, S13): by its identifiers in order, else by title.

    An identifier with more than one hit is an error. A title counts only if it is
    the same in comparable form and leads to one document; the phrase is asked
    first, then, where none has the title, its words. All hits of a title are
    compared, ``rows_per_page`` at a time.
    """
    kind = dict(rows.dtypes)[key]

    def document(asked: str, docs: list[dict]):
        d = docs[0]
        ids = {"ads": d.get("bibcode")} | ({"doi": d["doi"][0]} if d.get("doi") else {})
        for i in d.get("identifier") or []:
            if i.lower().startswith("arxiv:"):
                ids.setdefault("arxiv", i[6:])
        return (asked, d.get("bibcode"), (d.get("title") or [None])[0], d.get("author") or [], {k: v for k, v in ids.items() if v}, _digits(d.get("year")), d.get("pub"), d.get("abstract"), d.get("keyword") or [], _digits(d.get("citation_count")), len(docs))

    def ask(q: str) -> list[dict]:
        return _path(get("search/query", {"q": q, "rows": rows_per_answer}), "response", "docs") or []

    def titled(q: str, key: str) -> list[dict]:
        """All hits of a search whose title has this comparable form."""
        found, start, last = [], 0, None
        while True:
            answer = get("search/query", {"q": q, "rows": rows_per_page, "start": start})
            docs, total = _path(answer, "response", "docs") or [], _path(answer, "response", "numFound")
            # A source that knows no pages repeats its answer.
            if docs == last:
                return found
            found += [d for d in docs if X.title_key_of((d.get("title") or [""])[0]) == key]
            start, last = start + len(docs), docs
            if not docs or (start >= total if isinstance(total, int) else len(docs) < rows_per_page):
                return found

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for k, ids, t in zip(pdf[key], pdf[identifiers], pdf[title]):
                ids = dict(ids or {})
                hit = None
                for i in dict.fromkeys(ids[n] for n in ("doi", "arxiv", "ads") if ids.get(n)):
                    docs = ask(f'identifier:"{i}"')
                    if len(docs) > 1:
                        raise RestError(f"{i} is ambiguous")
                    if docs:
                        hit = document(i, docs)
                        break
                if hit is None and t:
                    for q in (f'title:"{t}"', "title:(" + " ".join(X.title_key_of(t).split()) + ")"):
                        docs = titled(q, X.title_key_of(t))
                        if docs:
                            hit = document(t, docs) if len(docs) == 1 else None
                            break
                if hit:
                    out.append((k, *hit))
            yield pd.DataFrame(out, columns=[key, *[c.split()[0] for c in DOCS.split(", ")]])

    return rows.select(key, identifiers, title).mapInPandas(run, f"{key} {kind}, {DOCS}")


def enriched(entities: DataFrame, docs: DataFrame, key: str = "id") -> DataFrame:
    """(id, property, value) that an enriching document sets (G7): managed ones always, doi and arXiv id only where missing."""
    d = docs.select(key, F.explode(F.array(
        *[F.struct(F.lit(p).alias("property"), v.cast("string").alias("value"), F.lit(force).alias("force")) for p, v, force in (
            ("ads_bibcode", F.col("bibcode"), True), ("description", F.col("description"), True), ("publication", F.col("publication"), True),
            ("citation_count", F.col("citation_count"), True), ("author_count", F.size("authors"), True), ("publication_year", F.col("year"), True),
            ("author_list", F.array_join("authors", "; "), True), ("ads_keywords", F.array_join("keywords", "; "), True), ("name", X.clean_title(F.col("title")), True),
            ("doi", F.try_element_at("identifiers", F.lit("doi")), False), ("arxiv_id", F.try_element_at("identifiers", F.lit("arxiv")), False),
        )]
    )).alias("x")).select(key, "x.*")
    have = entities.select(F.col(key), F.try_element_at("identifiers", F.lit("doi")).alias("_doi"), F.try_element_at("identifiers", F.lit("arxiv")).alias("_arxiv"))
    missing = F.when(F.col("property") == "doi", F.col("_doi").isNull()).when(F.col("property") == "arxiv_id", F.col("_arxiv").isNull()).otherwise(True)
    return d.join(have, key).where(F.col("value").isNotNull() & (F.col("value") != "") & (F.col("force") | missing)).select(key, "property", "value")


def retrying(call: Callable, retries: int = 4, wait: float = 1.2, longest: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``call`` tried again while it is turned away for now.

    An error's ``status`` of 429, one of 5xx and none at all (a broken connection) are tried again after a
    wait that grows linearly up to ``longest``; any other status says that the request itself is wrong, and is raised at once.
    """

    def run(*args, **kw):
        for k in range(retries + 1):
            try:
                return call(*args, **kw)
            except Exception as x:
                status = getattr(x, "status", None)
                if k == retries or not (status is None or status == 429 or status >= 500):
                    raise
            sleep(min(wait * (k + 1), longest))

    return run


def first_of(*backends: Callable) -> Callable:
    """A callable that asks one backend after another until one answers (S14); the last one's error stands if none does."""

    def run(*args, **kw):
        for k, backend in enumerate(backends):
            try:
                return backend(*args, **kw)
            except Exception:
                if k == len(backends) - 1:
                    raise

    return run
