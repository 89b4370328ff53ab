"""DataFrame-to-DataFrame operators: weights, similarity, normalisation, records, profiles."""
