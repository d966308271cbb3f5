"""Corpus curation as Spark jobs: DataFrame operators, sources and plans."""

from siftwork.session import build_session, materialize

__all__ = ["build_session", "materialize"]
