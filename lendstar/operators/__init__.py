"""DataFrame -> DataFrame operators of the lending pipelines."""
