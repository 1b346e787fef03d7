"""SPARQL SELECT over quads, compiled to DataFrames."""

from skeinmill.sparql.compiler import Dataset, select
from skeinmill.sparql.parser import SparqlError, parse

__all__ = ["Dataset", "SparqlError", "parse", "select"]
