"""Registered queries. Importing the package registers all of them."""

from millrace.plans import (  # noqa: F401
    chatting,
    cleaning,
    encoding,
    evaluating,
    files,
    modeling,
    planted,
    profiling,
    splitting,
    tracking,
    tuning,
)
from millrace.plans.modeling import flagship
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
