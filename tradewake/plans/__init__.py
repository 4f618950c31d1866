"""Whole jobs (``pipelines``) and the registered queries with their SQL (``catalog``)."""
