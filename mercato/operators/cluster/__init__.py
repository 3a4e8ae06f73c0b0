"""Segmentation: models, metrics, profiles, comparison."""
