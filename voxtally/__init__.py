"""Voxtally: customer-feedback analytics as Spark DataFrame jobs."""

from voxtally.session import build_session, shared_path

__all__ = ["build_session", "shared_path"]
