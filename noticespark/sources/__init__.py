"""Readers for landed data and the deterministic projections of the driver tables."""
