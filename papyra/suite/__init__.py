"""Every operator as a query on the shared test tables, with the same in SQL."""

from papyra.suite import enrichment, search, selection, storage, texts

MODULES = (selection, enrichment, texts, search, storage)

QUERIES = {name: query for m in MODULES for name, (query, _) in m.SUITE.items()}
ORACLES = {name: sql for m in MODULES for name, (_, sql) in m.SUITE.items() if sql}
