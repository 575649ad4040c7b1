"""The build's inputs taken from a star schema of orders, and queries on them."""

from .queries import QUERIES
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]
