"""Registered queries: importing this module fills ``QUERIES`` and ``ORACLE``."""

from spendcast.plans import q_explore, q_features, q_labels, q_model  # noqa: F401
from spendcast.plans.base import ORACLE, QUERIES  # noqa: F401
