"""Checks taxonomic read classifications of many samples as Spark jobs."""

from readsift.session import build_session, staging_path

__all__ = ["build_session", "staging_path"]
