"""DataFrame -> DataFrame operators; each runs on batch and (where the
semantics allow) streaming DataFrames unchanged."""
