"""Whole-run plans: the feature table and the clustering model."""
