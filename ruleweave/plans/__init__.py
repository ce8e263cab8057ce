"""Composite jobs: training data, inference, ensembles, models."""
