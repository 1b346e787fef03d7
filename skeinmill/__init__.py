"""skeinmill: a PySpark engine for provenance-tracked entity graphs."""

__version__ = "0.1.0"
