"""tessera: named, tested analytics operators on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (plus parameters).
No module creates a session or performs I/O except ``tessera.session`` and
``tessera.sources``.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
