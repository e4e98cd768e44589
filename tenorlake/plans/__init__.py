"""Whole jobs built from the operators: bronze, silver, gold, training, scoring, monitoring."""
