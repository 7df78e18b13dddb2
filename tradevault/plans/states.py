"""Allowed status moves per entity.

Fixed values: (from, to) moves; the first state of a machine's first move is its entry state. Where the source drawing
of the order status is ambiguous, cancels are read as leaving WORKING and PARTIALLY_FILLED and a bust as leaving FILLED.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradevault.sources.seeds import small_frame

STATE_MACHINES: dict[str, list[tuple[str, str]]] = {
    "order_request": [
        ("RECEIVED", "SYSTEMATIZED"),
        ("SYSTEMATIZED", "ORDER_CREATED"),
        ("RECEIVED", "REJECTED"),
        ("RECEIVED", "EXPIRED"),
    ],
    "order": [
        ("NEW", "ACCEPTED"),
        ("ACCEPTED", "WORKING"),
        ("WORKING", "ACCEPTED"),
        ("WORKING", "PARTIALLY_FILLED"),
        ("PARTIALLY_FILLED", "FILLED"),
        ("WORKING", "CANCELLED"),
        ("PARTIALLY_FILLED", "CANCELLED"),
        ("FILLED", "BUST"),
        ("NEW", "REJECTED"),
        ("NEW", "EXPIRED"),
        ("WORKING", "MODIFIED"),
        ("MODIFIED", "WORKING"),
    ],
    "order_route": [
        ("SENT", "ACKNOWLEDGED"),
        ("ACKNOWLEDGED", "ROUTED_AT_VENUE"),
        ("ACKNOWLEDGED", "REJECTED"),
        ("SENT", "REJECTED"),
        ("ACKNOWLEDGED", "CANCELLED"),
        ("ACKNOWLEDGED", "MODIFIED"),
        ("MODIFIED", "ACKNOWLEDGED"),
    ],
    "order_modification": [
        ("REQUESTED", "ACCEPTED"),
        ("ACCEPTED", "APPLIED_TO_ORDER"),
        ("REQUESTED", "REJECTED"),
    ],
    "quote_request": [
        ("OPEN", "ANSWERED"),
        ("OPEN", "EXPIRED"),
        ("OPEN", "CANCELLED"),
    ],
    "quote": [
        ("ACTIVE", "EXECUTED"),
        ("ACTIVE", "SUPERSEDED"),
        ("ACTIVE", "CANCELLED"),
        ("ACTIVE", "EXPIRED"),
    ],
    "request_for_execution": [
        ("RECEIVED", "ACCEPTED"),
        ("RECEIVED", "REJECTED"),
        ("RECEIVED", "EXPIRED"),
    ],
    "indication_of_interest": [
        ("ACTIVE", "WITHDRAWN"),
        ("ACTIVE", "EXPIRED"),
    ],
    "execution": [
        ("NEW", "PARTIAL"),
        ("PARTIAL", "PARTIAL"),
        ("PARTIAL", "FULL"),
        ("NEW", "BUST"),
        ("NEW", "CORRECT"),
        ("NEW", "CANCEL"),
    ],
    "allocation": [
        ("PENDING", "CONFIRMED"),
        ("PENDING", "REJECTED"),
        ("PENDING", "AMENDED"),
        ("AMENDED", "PENDING"),
        ("PENDING", "CANCELLED"),
    ],
    "confirmation": [
        ("UNCONFIRMED", "AFFIRMED"),
        ("UNCONFIRMED", "DK"),
        ("UNCONFIRMED", "DISPUTED"),
        ("UNCONFIRMED", "CANCELLED"),
    ],
    "match": [
        ("UNMATCHED", "MATCHED"),
        ("UNMATCHED", "ALLEGED"),
    ],
    "clearing": [
        ("SUBMITTED", "ACCEPTED"),
        ("ACCEPTED", "NOVATED"),
        ("SUBMITTED", "REJECTED"),
    ],
    "settlement": [
        ("INSTRUCTED", "MATCHED"),
        ("MATCHED", "SETTLING"),
        ("SETTLING", "SETTLED"),
        ("SETTLING", "PARTIAL"),
        ("SETTLING", "FAILED"),
        ("INSTRUCTED", "UNMATCHED"),
    ],
    "obligation": [
        ("PENDING", "NETTED"),
        ("NETTED", "SETTLED"),
        ("NETTED", "FAILED"),
    ],
    "position": [
        ("UNRECONCILED", "IN_PROGRESS"),
        ("IN_PROGRESS", "MATCHED"),
        ("IN_PROGRESS", "BROKEN"),
    ],
    "position_break": [
        ("OPEN", "INVESTIGATING"),
        ("INVESTIGATING", "RESOLVED"),
        ("INVESTIGATING", "WRITTEN_OFF"),
        ("OPEN", "AGED"),
    ],
    "agreement": [
        ("DRAFT", "EXECUTED"),
        ("EXECUTED", "ACTIVE"),
        ("ACTIVE", "TERMINATED"),
        ("ACTIVE", "AMENDED"),
        ("AMENDED", "ACTIVE"),
        ("DRAFT", "VOID"),
    ],
    "margin_call": [
        ("ISSUED", "ACKNOWLEDGED"),
        ("ACKNOWLEDGED", "PAID"),
        ("ISSUED", "DISPUTED"),
        ("DISPUTED", "RESOLVED"),
        ("RESOLVED", "PAID"),
        ("ISSUED", "EXPIRED"),
    ],
    "regulatory_report": [
        ("GENERATED", "SUBMITTED"),
        ("SUBMITTED", "ACCEPTED"),
        ("SUBMITTED", "REJECTED"),
        ("REJECTED", "CORRECTED"),
        ("CORRECTED", "SUBMITTED"),
    ],
    "regulatory_hold": [
        ("ACTIVE", "RELEASED"),
        ("ACTIVE", "EXPIRED"),
    ],
}


def moves(machine: str) -> list[tuple[str, str]]:
    if machine not in STATE_MACHINES:
        raise ValueError(f"no state machine {machine!r}")
    return STATE_MACHINES[machine]


def machines() -> list[str]:
    return list(STATE_MACHINES)


def entry_state(machine: str) -> str:
    return moves(machine)[0][0]


def edge_frame(spark: SparkSession) -> DataFrame:
    """All machines as (machine, from_state, to_state); the entry state has a row with a NULL from_state."""
    rows = []
    for m in machines():
        rows.append((m, None, entry_state(m)))
        rows += [(m, a, b) for a, b in moves(m)]
    return small_frame(spark, ["machine", "from_state", "to_state"], rows)
