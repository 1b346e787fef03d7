"""Ontology profiles: types, their RDF classes and properties, validated on the driver."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Formats and layouts that a profile may use.
FORMATS = ("text", "number", "select", "multi_select", "date", "files", "checkbox", "url", "email", "phone", "objects")
LAYOUTS = ("basic", "profile", "action", "note", "collection", "set")
_KEY = re.compile(r"[a-z][a-z0-9_]*")


class ProfileError(ValueError):
    """A profile that breaks a rule."""


def _need(ok: bool, said: str) -> None:
    if not ok:
        raise ProfileError(said)


def checked(profile: dict) -> dict:
    """The profile itself if it is sound: version 1, snake-case keys, no repeated type or property, known prefixes, layouts and formats."""
    _need(isinstance(profile, dict) and profile.get("version") == 1, "version has to be 1")
    for k in ("key", "name"):
        _need(isinstance(profile.get(k), str) and bool(profile[k].strip()), f"{k} is missing")
    _need(bool(_KEY.fullmatch(profile["key"])), f"key {profile['key']!r} is not in snake case")
    spaces = profile.get("namespaces")
    _need(isinstance(spaces, dict) and all(isinstance(v, str) and v for v in spaces.values()), "namespaces have to be texts")
    types = profile.get("types")
    _need(isinstance(types, list) and bool(types), "types are missing")
    seen = set()
    for t in types:
        _need(isinstance(t.get("key"), str) and bool(_KEY.fullmatch(t["key"])), f"type key {t.get('key')!r} is not in snake case")
        _need(t["key"] not in seen, f"type {t['key']} is repeated")
        seen.add(t["key"])
        _need(t.get("layout") in LAYOUTS, f"type {t['key']} has layout {t.get('layout')!r}")
        prefix, _, local = (t.get("rdf_class") or "").partition(":")
        _need(prefix in spaces and bool(local), f"type {t['key']} has class {t.get('rdf_class')!r}")
        own = set()
        for p in t.get("properties") or []:
            _need(isinstance(p.get("key"), str) and bool(_KEY.fullmatch(p["key"])), f"property key {p.get('key')!r} is not in snake case")
            _need(p["key"] not in own, f"property {t['key']}.{p['key']} is repeated")
            own.add(p["key"])
            _need(p.get("format") in FORMATS, f"property {t['key']}.{p['key']} has format {p.get('format')!r}")
    return profile


def load(path: str) -> dict:
    """A profile from a JSON file, checked."""
    return checked(json.loads(Path(path).read_text()))


def properties(spark: SparkSession, profile: dict) -> DataFrame:
    """(type_key, rdf_class, property_key, format) of a profile."""
    rows = [(t["key"], t["rdf_class"], p["key"], p["format"]) for t in profile["types"] for p in t.get("properties") or []]
    return spark.createDataFrame(rows, "type_key string, rdf_class string, property_key string, format string")
