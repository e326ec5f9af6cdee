import pytest

from storeloom.operators import metric_states
from storeloom.operators import quality as dq

CHECKS = [dq.has_size(3), dq.not_null("id", min_ratio=0.5), dq.unique("id", min_ratio=0.5), dq.email_format(), dq.positive("n")]
SCHEMA = "id string, email string, n int"
DAYS = [[("a", "a@b.co", 1), ("b", "bad", -1), (None, None, None)], [("a", "c@d.org", 5)], [("c", None, 0), ("d", "d@e.fr", 2)]]


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("merged_after", [(), (0,), (0, 1), (2,)])
def test_states_equal_a_full_scan(spark, tmp_path, merged_after):
    path = str(tmp_path / "states")
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in DAYS]
    fields = frames[0].schema
    for number, frame in enumerate(frames):
        metric_states.record(frame, path, number, CHECKS, fields.names)
        if number in merged_after:
            metric_states.merge(spark, path, fields)
    everything = spark.createDataFrame([r for day in DAYS for r in day], SCHEMA)
    assert shown(metric_states.evaluate(spark, path, CHECKS, fields)) == shown(dq.evaluate(everything, CHECKS))
    profile = metric_states.profile(spark, path, fields)
    assert shown(profile.drop("unique_ratio")) == shown(dq.profile_columns(everything, fields.names))
    rules = dq.profile_rules(everything, {"id": {"unique_check": True}}).first()
    assert profile.filter("column_name = 'id'").first()["unique_ratio"] == rules["id_unique_ratio"]


def test_recording_again_replaces_a_delivery(spark, tmp_path):
    path = str(tmp_path / "states")
    first, second = (spark.createDataFrame(rows, SCHEMA) for rows in DAYS[:2])
    metric_states.record(first, path, 0, CHECKS, ["id"])
    metric_states.record(second, path, 0, CHECKS, ["id"])
    got = {r["check"]: r["value"] for r in metric_states.evaluate(spark, path, CHECKS, first.schema).collect()}
    assert got["size_at_least_3"] == 1.0 and got["id_unique"] == 1.0


def test_no_deliveries(spark, tmp_path):
    fields = spark.createDataFrame([], SCHEMA).schema
    empty = spark.createDataFrame([], fields)
    path = str(tmp_path / "none")
    assert shown(metric_states.evaluate(spark, path, CHECKS, fields)) == shown(dq.evaluate(empty, CHECKS))
    assert shown(metric_states.profile(spark, path, fields).drop("unique_ratio")) == shown(dq.profile_columns(empty, fields.names))
