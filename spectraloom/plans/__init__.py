"""Whole searches and the registered queries."""
