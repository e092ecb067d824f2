"""The fixtures read every row of the given tables below them."""

import os

import pytest

from queryset.views import GivenTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


def test_fixtures_hold_every_row(spark):
    t = GivenTables(spark, SF)
    n = {name: t.raw(name).count() for name in ("lineitem", "supplier", "customer", "part")}
    closed = t.raw("lineitem").select("l_suppkey", "l_orderkey").distinct().count()
    want = {
        "store_requests": n["lineitem"], "store_deactivations": closed, "external_stores": n["supplier"],
        "vendor_features": 2 * n["part"], "label_nn": 2 * n["supplier"], "label_danp": 2 * n["supplier"],
        "prior_danp_inputs": n["customer"], "poor_activations": n["supplier"], "premium_flags": n["supplier"],
        "order_values": n["supplier"],
    }
    assert {name: t.raw(name).count() for name in want} == want
    assert t.raw("poor_activations").join(t.raw("registry").selectExpr("id AS match_id"), "match_id").count() < n["supplier"]
    assert t.raw("premium_flags").where("store_id IS NULL").count() > 0
