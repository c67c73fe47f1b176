"""Training-data operators: independent operators over ``documents``,
``pages``, ``embeddings`` and ``benchmark``, and the queries that register them.

Nothing else in the library imports this package.
"""
