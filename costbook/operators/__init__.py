"""DataFrame -> DataFrame operators of the seven pipelines."""
