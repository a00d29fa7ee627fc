"""The queries of the library, and the SQL that each must agree with."""

from . import canonical, contracts, extraction

QUERIES = extraction.QUERIES | canonical.QUERIES | contracts.QUERIES
ORACLE_SQL = extraction.ORACLE_SQL | canonical.ORACLE_SQL | contracts.ORACLE_SQL
