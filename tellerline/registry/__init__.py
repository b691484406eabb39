"""Queries over the driver tables and the SQL each must agree with."""

from tellerline.registry.oracles import ORACLES
from tellerline.registry.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
