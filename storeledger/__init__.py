"""Retail analytics as lazy PySpark jobs: each job takes tables and business rules and returns a DataFrame."""

from storeledger.config import Rules
from storeledger.sources.tables import Tables

__all__ = ["Rules", "Tables"]
