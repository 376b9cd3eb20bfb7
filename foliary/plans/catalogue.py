"""All registered queries and their DuckDB SQL. Each module of queries has QUERIES and ORACLE_SQL."""

from foliary.plans import queries_corpus, queries_markdown, queries_pages, queries_readers, queries_runs, queries_sources, queries_talk

_MODULES = (queries_pages, queries_corpus, queries_markdown, queries_talk, queries_sources, queries_readers, queries_runs)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
