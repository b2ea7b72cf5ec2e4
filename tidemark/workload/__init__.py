"""The operators run on the star-schema test tables, with equivalent SQL."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
