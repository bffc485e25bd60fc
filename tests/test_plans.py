"""What plans deal rows out by: no step may send all rows of a few values to as many tasks."""

import os

import pytest

from folioframe.plans import catalog

SF = os.environ.get("FOLIO_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", ["pt_mask_decode", "pt_canon_convert"])
def test_rule_tables_go_to_the_pages(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(kind" not in plan


@pytest.mark.parametrize("name", ["kv_page_all", "kv_review_view", "kv_name", "kv_dob", "kv_member_id", "kv_dos", "kv_provider", "kv_credentials", "kv_esignature", "kv_trust", "join_key_catalog"])
def test_words_stay_with_their_page(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and "hashpartitioning(page_id" not in plan
