"""The flagship's plan shape as a large cluster would get it (no automatic broadcasts, no AQE)."""

import re

from lodestar.plans import survey as S
from lodestar.plans import warehouse as W
from lodestar.plans.fixtures import Fixtures

SCALE_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.enabled": "false",
              "spark.sql.requireAllClusterKeysForCoPartition": "false"}


def plan_of(spark, build) -> list[str]:
    prev = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    try:
        return build()._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tables(spark):
    return Fixtures(spark, "/root/testdata/sf0.001").tables()


def test_wide_chain_frame_is_shuffled_once(spark):
    lines = plan_of(spark, lambda: W.denormalize(tables(spark)))
    text = "\n".join(lines)
    # The checked-small org/program prefix is broadcast into the child fact table.
    assert "BuildLeft" in text
    # The two fact joins share one hash partitioning on applicationid: the wide
    # frame, inmapp and inmappchdj are each shuffled once by it, and by nothing else.
    assert text.count("Exchange hashpartitioning(applicationid") == 3
    assert not re.search(r"Exchange hashpartitioning\((childid|inmateid|caregiverid)#\d+L?, \d+\)", text)
    first_join = next(i for i, ln in enumerate(lines) if "Join" in ln)
    assert not any("Exchange" in ln for ln in lines[:first_join])
    # Inmate, caregiver and child dimensions are broadcast after their size check.
    assert text.count("BroadcastHashJoin") >= 4


def test_no_distinct_above_the_dimension_joins(spark):
    """With every broadcast refused, the chain becomes a set before the dimensions are joined."""
    lines = plan_of(spark, lambda: W.denormalize(tables(spark), max_broadcast_rows=0))
    text = "\n".join(lines)
    assert "BroadcastHashJoin" not in text
    first_join = next(i for i, ln in enumerate(lines) if "Join" in ln)
    assert not any("HashAggregate" in ln for ln in lines[:first_join])
    wide = [ln for ln in lines if "HashAggregate(keys=[" in ln and "message_to_child" in ln]
    assert wide and not any("caregiver_first_name" in ln or "inmate_first_name" in ln for ln in wide)


def test_survey_melt_shuffles_answers_not_joined_rows(spark):
    from lodestar.plans.catalog import _survey_tables
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    lines = plan_of(spark, lambda: S.melt_of_tables(_survey_tables(fx), base_unique=True))
    last_join = next(i for i, ln in enumerate(lines) if "BroadcastHashJoin" in ln)
    assert not any("Exchange" in ln for ln in lines[:last_join])
    assert any("rangepartitioning(participant_id" in ln for ln in lines[last_join:])
