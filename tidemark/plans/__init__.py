"""Whole flows: logs to retention, profiles to clusters, clusters to retention."""
