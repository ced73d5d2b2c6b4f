from rillstone.plans.oracle import ORACLE
from rillstone.plans.registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]
