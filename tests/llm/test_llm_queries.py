import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import DATA, check  # noqa: E402

from frond.llm.queries import ORACLES, QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        check(spark, name, QUERIES[name], ORACLES[name])
    else:
        QUERIES[name](spark, str(DATA)).collect()


def test_sample_of_both_fields(spark):
    report = QUERIES["p6_report"](spark, str(DATA)).collect()
    drawn = {(r.field_name, r.key): r.drawn for r in report if r.quota > 0}
    assert {f for f, _ in drawn} == {"disease_name", "category"} and all(r.drawn == r.quota for r in report)
    sample = [tuple(r) for r in QUERIES["p6_sample"](spark, str(DATA)).collect()]
    assert len(sample) == len(set(sample))
    assert {x: sum((f, k) == x for f, _, k in sample) for x in drawn} == drawn
