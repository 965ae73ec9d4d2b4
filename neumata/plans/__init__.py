"""All registered queries and their SQL."""

from neumata.plans import corpus_queries, notation_queries, ranking_queries, record_queries, search_queries, stream_queries, title_queries, token_queries
from neumata.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "corpus_queries", "notation_queries", "ranking_queries", "record_queries", "search_queries", "stream_queries", "title_queries", "token_queries"]
