"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames, keeps columns it does not know, and cuts lineage only with
tables written below the session's shared folder (``spark.checkpoint.dir``).
"""
