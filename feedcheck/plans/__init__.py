"""Whole validations built from the operators, and the query catalogue."""
