"""Whole jobs: silver, marts, named queries, serving, models, refresh."""
