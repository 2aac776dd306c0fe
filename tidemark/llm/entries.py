"""The corpus queries and their SQL."""

from __future__ import annotations

from tidemark.llm import queries, queries_words

QUERIES = queries.QUERIES | queries_words.QUERIES
ORACLES = queries.ORACLES | queries_words.ORACLES
