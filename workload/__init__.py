"""The registered queries: tidemark's operators on the test tables, each with plain SQL.

Every module holds QUERIES (name -> function of session and folder) and SQL (name ->
the same result in SQL). Input frames are projections of whole test tables.
"""

from workload import deletes, follow, ledgers, merges, options, payloads, quality, silver_gold, sinks, texts

MODULES = (texts, merges, deletes, ledgers, quality, sinks, silver_gold, options, follow, payloads)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
