"""Imports every plan module, which fills the registry."""

from avspark.plans import airspace, flights, learning, live, performance, streams  # noqa: F401
from avspark.plans.registry import ORACLE, QUERIES  # noqa: F401
