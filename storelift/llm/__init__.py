"""Training-data operators over documents, pages and embeddings.

Self-contained: nothing outside this subpackage imports it, apart from the
guarded registration in ``__spark_entry__.py``.  One module per operator, each
with a general DataFrame-in, DataFrame-out function; ``queries.py`` holds the
registered queries and their SQL, ``stages.py`` the pipeline stages.
"""
