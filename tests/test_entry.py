import pytest

import __spark_entry__ as entry
import check

SAMPLE = ["V1_order_reconstruction", "V2_daily_submission_status", "J2_pit_lookup", "W3_scd2_build", "A8_daily_lifecycle", "B1_trade_lifecycle", "DV7_point_in_time_table", "Q9_state_machine", "X1_batch_metadata", "C6_role_reconciliation", "W8_allocate", "B9_best_execution"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, sf, name):
    problem, n = check.compare(entry.queries()[name](spark, sf), check.connect(sf), entry.oracle_sql()[name])
    assert problem is None and n > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
