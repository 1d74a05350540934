"""Registered queries over the stand-in tables, and the same results as plain SQL."""
