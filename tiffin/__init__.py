"""Tiffin: food-delivery marketplace analytics as Spark DataFrame jobs."""

from tiffin.session import build_session, tune
from tiffin.sources.catalog import Marketplace

__all__ = ["Marketplace", "build_session", "tune"]
