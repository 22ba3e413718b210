"""Training-data operators: filtering, extraction, scoring, packing, search, sharding and mixing.

Nothing else in the library imports this subpackage. Each operator is one
module with its own general interface; ``queries.py`` holds the registered
queries and their SQL.
"""
