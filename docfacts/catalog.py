"""All registered queries of the library with their oracle SQL."""

from docfacts.plans import columns, documents, facts, jobs, queries, tables

assert columns and documents and facts and jobs and tables  # their queries register themselves
QUERIES: dict = dict(queries.QUERIES)
ORACLES: dict[str, str] = dict(queries.ORACLES)
