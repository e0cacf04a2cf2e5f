"""Registered queries: operators applied to the shared tables."""
