"""The registered queries and their SQL."""

from cairnlake.plans import joins, lakeside, ledger, nearness, references, schemas

_PARTS = [references, nearness, schemas, joins, ledger, lakeside]
QUERIES = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
SQL = {k: v for p in _PARTS for k, v in p.SQL.items()}
