"""Stateful stream operators, the query runner and the wired jobs."""
