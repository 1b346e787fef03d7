"""Scalar functions on names, identifiers and text."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def slug_of(value: str) -> str:
    """ASCII letters and digits joined by hyphens; a digest where nothing is left."""
    ascii_ = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "-", ascii_.lower()).strip("-") or hashlib.sha256(value.encode()).hexdigest()[:16]


def _slugs(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else slug_of(v))


def slug(col: Column) -> Column:
    """Identifier form of a name (F1): composed characters are taken apart, so a Pandas UDF for all but ASCII text."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    udf = F.pandas_udf(_slugs, T.StringType())
    return F.when(col.rlike(r"^[\x00-\x7f]*$") & (plain != ""), plain).otherwise(udf(col))


def plain_slug(col: Column, empty: str = "misc") -> Column:
    """Lower-case ASCII letters and digits joined by hyphens (F2)."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(col)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", empty).otherwise(s)


def short_slug(col: Column, limit: int = 50) -> Column:
    """``plain_slug`` cut to ``limit`` characters without a hyphen at the end."""
    return F.regexp_replace(F.substring(plain_slug(col, "query"), 1, limit), "-+$", "")


def doi(col: Column) -> Column:
    """A bare lower-case DOI."""
    return F.lower(F.regexp_replace(F.trim(col), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", ""))


def arxiv_id(col: Column) -> Column:
    """A bare lower-case arXiv id without its version."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(col), r"(?i)^arxiv:\s*", ""), r"(?i)v\d+$", ""))


def given_first(col: Column) -> Column:
    """``Family, Given`` turned round (F6); other names unchanged."""
    parts = F.split(col, ",", 2)
    family, given = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    return F.when(given.isNotNull(), F.trim(F.concat_ws(" ", given, family))).otherwise(F.trim(col))


def squeezed(col: Column) -> Column:
    """One blank between words, none around, of any script's white space (F16 without case)."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def name_key(col: Column) -> Column:
    """A name for comparison: squeezed, lower case (F16)."""
    return F.lower(squeezed(col))


_TAGS = re.compile(r"</?(?:sub|sup|i|b|em|strong)\b[^>]*>", re.I)


def clean_title_of(value: str) -> str:
    return " ".join(_TAGS.sub("", html.unescape(value)).split())


def title_key_of(value: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in clean_title_of(value).casefold()).split())


def clean_title(col: Column) -> Column:
    """A title without HTML entities and markup (F8)."""
    plain = ~col.rlike(r"[<&]") & ~col.rlike(r"[^\x00-\x7f]")
    return F.when(plain, squeezed(col)).otherwise(F.pandas_udf(_clean_titles, T.StringType())(col))


def _clean_titles(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else clean_title_of(v))


def _title_keys(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else title_key_of(v))


def title_key(col: Column) -> Column:
    """A title for comparison: case folded, words only (F8)."""
    plain = ~col.rlike(r"[<&]") & ~col.rlike(r"[^\x00-\x7f]")
    return F.when(plain, F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))).otherwise(F.pandas_udf(_title_keys, T.StringType())(col))


def percent_encoded(col: Column) -> Column:
    """Percent-encoding that leaves only letters, digits and ``_.-~``."""
    return F.replace(F.replace(F.replace(F.url_encode(col), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def digest_id(prefix: str, *cols: Column, length: int = 20) -> Column:
    """``prefix`` and the first digits of the SHA-256 of the parts, joined by NUL."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\u0000", *cols), 256), 1, length))


def cache_key(col: Column) -> Column:
    """Name of a cached page."""
    return F.substring(F.sha1(col), 1, 16)


def split_authors(col: Column) -> Column:
    """Names joined by ``and`` (F12), without ``others``."""
    names = F.transform(F.split(col, r"(?i)\s+and\s+"), lambda x: squeezed(x))
    return F.filter(names, lambda x: (x != "") & (F.lower(x) != "others"))


def has_others(col: Column) -> Column:
    return F.exists(F.split(col, r"(?i)\s+and\s+"), lambda x: F.lower(F.trim(x)) == "others")


def split_list(col: Column, sep: str = ";") -> Column:
    """Trimmed non-empty items."""
    return F.filter(F.transform(F.split(col, sep), lambda x: F.trim(x)), lambda x: x != "")


def guarded_int(col: Column) -> Column:
    """Digits as a number, anything else null."""
    return F.when(F.trim(col).rlike(r"^\d+$"), F.trim(col).try_cast("bigint"))


def epoch_date(col: Column) -> Column:
    """Seconds since 1970 as an ISO date in UTC, "" where that is none."""
    return F.coalesce(F.date_format(F.timestamp_seconds(col.try_cast("bigint")), "yyyy-MM-dd"), F.lit(""))


def bibtex_escaped(col: Column) -> Column:
    """Text for a quoted BibTeX value: trimmed, on one line, its quotes escaped."""
    return F.replace(F.translate(F.trim(col), "\r\n", "  "), F.lit('"'), F.lit('\\"'))


def author_value(col: Column, corporate: list[str]) -> Column:
    """A ``;`` list as BibTeX authors, corporate names in braces."""
    known = [c.lower() for c in corporate]
    items = F.transform(split_list(col), lambda x: F.when(name_key(x).isin(*known), F.concat(F.lit("{"), x, F.lit("}"))).otherwise(x))
    return F.nullif(F.array_join(items, " and "), F.lit(""))


def snake_keyword(col: Column) -> Column:
    """A keyword in snake case."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(col)), r"[^a-z0-9]+", "_"), "^_+|_+$", "")


def tolerant_json(col: Column) -> Column:
    """The JSON object in a reply, also where other text surrounds it (F21); null if there is none."""
    return F.coalesce(F.try_parse_json(col), F.try_parse_json(F.nullif(F.regexp_extract(col, r"(?s)\{.*\}", 0), F.lit(""))))


def json_items(col: Column) -> Column:
    """The JSON array in a reply, as ``tolerant_json``."""
    return F.coalesce(F.try_parse_json(col), F.try_parse_json(F.nullif(F.regexp_extract(col, r"(?s)\[.*\]", 0), F.lit(""))))


def truncated(col: Column, limit: int = 12_000) -> Column:
    """At most ``limit`` characters for a prompt (F23); the text itself is kept elsewhere."""
    return F.substring(col, 1, limit)


def title_case(value: str) -> str:
    """Default name of a collection from its key."""
    return value.replace("-", " ").replace("_", " ").title()


def folder_path(col: Column) -> Column:
    """Folders joined."""
    return F.array_join(col, " > ")


def last_folder(col: Column) -> Column:
    return F.trim(F.element_at(F.split(col, ">"), -1))


def with_suffix(col: Column, suffix: str = "Collaboration") -> Column:
    """The name with its corporate suffix."""
    return F.when(F.lower(col).endswith(suffix.lower()), col).otherwise(F.concat(col, F.lit(f" {suffix}")))


def unwrapped_of(value: str) -> str:
    """A BibTeX value without outer braces and quotes, blanks squeezed."""
    v = " ".join(value.split())
    while len(v) >= 2 and ((v[0], v[-1]) in (("{", "}"), ('"', '"'))):
        v = v[1:-1].strip()
    return v


def first_text(col: Column) -> Column:
    """The first item of a list, trimmed; null if empty."""
    return F.nullif(F.trim(F.get(col, F.lit(0))), F.lit(""))


def bool_arg(value: object) -> bool:
    """Truthiness of a command-line value."""
    return str(value).strip().lower() in ("1", "true", "yes", "y", "on")


def int_arg(value: object, default: int) -> int:
    try:
        return int(str(value).strip())
    except ValueError:
        return default
