"""F1 probe values (rule action totals and the rule -> final matrix) at sf0.01."""

import os

import pytest

from ledgerlens.plans import catalog

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


def test_rule_action_totals(spark):
    got = {r.rule_action: r.n for r in catalog.queries()["rule_action_counts"](spark, SF).collect()}
    assert got == {"ALLOW": 9557, "WARN": 2689, "BLOCK": 2675, "LOCK": 79}


def test_rule_to_final_matrix(spark):
    got = {(r.rule_action, r.final_action): r.n for r in catalog.queries()["final_action_matrix"](spark, SF).collect()}
    assert got[("ALLOW", "ALLOW")] == 1810 and got[("ALLOW", "WARN")] == 6552
    assert got[("ALLOW", "BLOCK")] == 1113 and got[("ALLOW", "LOCK")] == 82
    assert got[("WARN", "WARN")] == 2261 and got[("WARN", "BLOCK")] == 395 and got[("WARN", "LOCK")] == 33
    assert got[("BLOCK", "BLOCK")] == 2411 and got[("BLOCK", "LOCK")] == 264
    assert got[("LOCK", "LOCK")] == 79
