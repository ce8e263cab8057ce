"""DataFrame operators: joins, distincts, samples, indexes, centroids."""
