"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this package. Each module holds one operator with a general
interface and its thin ``opN_<name>`` query; ``registry`` collects the queries and their SQL.
"""
