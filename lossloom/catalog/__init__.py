"""Registered queries; importing the package fills the registry."""

from lossloom.catalog import aggregates, claims, composite, modelling, ordering, relational, scalars, scoring, texts  # noqa: F401
from lossloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
