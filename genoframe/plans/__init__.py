"""Whole analyses composed of the operators, and queries that run the operators on general tables."""
