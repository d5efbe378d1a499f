"""Traceable document analytics as set-based Spark jobs."""

from attestry.session import build_session, checkpoint_root, materialize

__all__ = ["build_session", "checkpoint_root", "materialize"]
