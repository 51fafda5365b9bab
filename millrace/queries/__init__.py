"""Registered queries, each with the SQL that gives the same rows."""

from millrace.queries import catalog, dates, etl, files, flow, functions, keyed, quality, sqltext, streams, whole
from millrace.queries.base import ORACLE, REGISTRY

__all__ = ["ORACLE", "REGISTRY", "catalog", "dates", "etl", "files", "flow", "functions", "keyed", "quality", "sqltext", "streams", "whole"]
