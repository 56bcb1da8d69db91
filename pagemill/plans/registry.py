"""All queries of the core, and their SQL."""

from pagemill.plans import documents, hierarchy
from pagemill.plans.documents_sql import SQL as _DOCUMENTS_SQL

QUERIES = {**hierarchy.QUERIES, **documents.QUERIES}
SQL = {**hierarchy.SQL, **_DOCUMENTS_SQL}
FLAGSHIP = "p1_hierarchy"
