"""Reusable DataFrame operators: ordering, joins, rules, ingestion, warehouse, snapshots."""
