"""Training-data operators: scoring, scanning, deduplication, token output, search.

Nothing outside this package imports it.  Each module holds one operator with a
general interface; ``queries.py`` binds them to the given tables.
"""
