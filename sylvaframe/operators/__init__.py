"""DataFrame operators: preparation, parsing, ranking, sharding, embeddings."""
