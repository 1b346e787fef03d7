"""Writers of canonical records, RDF, BibTeX, guides and queries."""
