"""Every operator run on the given tables, each with its SQL where SQL can say it."""

from lakestrata.queries import bank, files, quality, scalar, taxi

_GROUPS = (bank, scalar, taxi, quality, files)

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
