"""Reusable relational steps: rule cascade, membership, dedup, upsert, keys."""
