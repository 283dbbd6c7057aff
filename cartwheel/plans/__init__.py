"""Models built from the operators: enriched tables, marts, metrics, price analytics."""
