"""Whole jobs made of the operators, the registered queries and their check SQL."""
