"""Compositions of operators: whole jobs, models, and the registered queries."""
