"""Compositions of the operators: one dated run (T17), the backfill."""
