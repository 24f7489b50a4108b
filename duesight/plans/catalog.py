"""All registered queries; importing the modules fills the registry."""

from . import (  # noqa: F401
    decision_queries,
    evaluation_queries,
    history_queries,
    model_queries,
    profile_queries,
    served_queries,
    silver_queries,
    view_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
