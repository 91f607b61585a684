"""Queries and SQL of this subpackage."""

from siftwise.llm import queries_native, queries_similarity, queries_text, queries_tokens

MODULES = (queries_native, queries_similarity, queries_text, queries_tokens)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
