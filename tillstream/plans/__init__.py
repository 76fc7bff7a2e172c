"""Whole flows built from the operators, the registered queries and their SQL checks."""
