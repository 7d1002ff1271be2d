"""Operators for preparing training text: one module per operator, one catalogue of queries."""
