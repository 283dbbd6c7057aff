"""Reusable table operators: staging, shaping, ranking, history, quality, refresh."""
