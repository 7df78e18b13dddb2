"""Importing this module registers every query."""

from tradevault.demo import (  # noqa: F401
    q_core,
    q_gold,
    q_vault,
    q_derived,
    q_ops,
    q_flows,
    q_more,
)
