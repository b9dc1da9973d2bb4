"""Whole jobs built from the operators: marts, enrichment, refresh."""
