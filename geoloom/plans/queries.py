"""Importing this module registers every query."""

from geoloom.plans import q_blend, q_detect, q_grid, q_inventory, q_labels, q_mask, q_metrics, q_vector, q_workflows  # noqa: F401
from geoloom.plans.registry import ORACLES, QUERIES  # noqa: F401
