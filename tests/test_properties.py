"""Property checks: distributed exact metrics equal brute force on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fundlens.operators import evaluation as EV

rows = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12).map(lambda v: v / 12)), min_size=1, max_size=60)


def brute_auc(data):
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    if not pos or not neg:
        return None
    num = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return round(num / (len(pos) * len(neg)), 6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, fineness=st.integers(1, 6))
def test_auc_property(spark, data, fineness):
    df = spark.createDataFrame(data, "label int, score double")
    assert EV.auc(df, fineness=fineness).first()["auc"] == brute_auc(data)
