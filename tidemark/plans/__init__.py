"""Composed plans: the retail layers and the registered queries."""
