"""All registered queries."""

from . import evaluation, features, screening, storage  # noqa: F401  (they register)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
