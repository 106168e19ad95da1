"""User-level pipelines assembled from the operators."""
