"""Spark-first engine for planning, auditing, selecting and measuring corpora."""

from strataloom.session import build_session, durable

__all__ = ["build_session", "durable"]
