"""The registered queries of this package and their SQL."""

from cairnlake.llm import garbled_queries, mix_queries, term_queries, token_queries

_PARTS = [term_queries, token_queries, mix_queries, garbled_queries]
QUERIES = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
SQL = {k: v for p in _PARTS for k, v in p.SQL.items()}
