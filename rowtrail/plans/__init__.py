"""Composed queries: change feeds derived from the given tables, and the queries run over them."""
