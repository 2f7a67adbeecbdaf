"""Compositions of operators: curated tables, verification, scoring, the batch."""
