"""Registered queries and their SQL, by name."""

from workload import batch, distributions, modelling, quality, streams, upkeep

QUERIES = {**batch.QUERIES, **quality.QUERIES, **modelling.QUERIES, **streams.QUERIES, **distributions.QUERIES, **upkeep.QUERIES}
SQL = {**batch.SQL, **quality.SQL, **modelling.SQL, **streams.SQL, **distributions.SQL, **upkeep.SQL}
