"""Every analytics query by name, with its SQL where one is given."""

from corpusq.plans import audits, corpus, distance, entities, lexicon, markup, pages, positions, review, statistics, text  # noqa: F401
from corpusq.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
