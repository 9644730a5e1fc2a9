"""Registered query plans (Spark builders + oracle SQL)."""

from .catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
