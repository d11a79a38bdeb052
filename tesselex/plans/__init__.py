"""Helpers that shape a physical plan: lineage cuts, worker environment."""
