from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storeloom.operators import quality as dq


def verdicts(df):
    return {r["check"]: (r["status"], r["value"]) for r in df.collect()}


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("1", "a@b.co"), ("2", "bad"), ("2", None), (None, "c@d.org")], "id string, email string")


def test_every_metric(people):
    got = verdicts(dq.evaluate(people, [dq.has_size(5), dq.not_null("id"), dq.not_null("id", min_ratio=0.75),
                                        dq.unique("id"), dq.email_format()]))
    assert got["size_at_least_5"] == ("Failure", 4.0)
    assert got["id_unique"][0] == "Failure" and got["id_unique"][1] == pytest.approx(1 / 3)
    assert got["email_format"] == ("Failure", 0.75)


def test_enforce_lists_every_error_and_spares_warnings(people):
    checks = [dq.has_size(5), dq.unique("id"), dq.email_format(level=dq.WARNING)]
    with pytest.raises(dq.QualityError) as failed:
        dq.enforce(dq.evaluate(people, checks))
    text = str(failed.value)
    assert "size(*) >= 5" in text and "uniqueness(id)" in text and "email" not in text
    with pytest.raises(dq.QualityError):
        dq.enforce(dq.evaluate(people, [dq.email_format(level=dq.ERROR)]))


def test_warning_suite_passes_the_gate(people):
    rows = dq.enforce(dq.evaluate(people, dq.at_level((dq.has_size(1000), dq.not_null("id")), dq.WARNING)))
    assert [r["status"] for r in rows] == ["Failure", "Failure"]


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "id string")
    got = verdicts(dq.evaluate(empty, [dq.has_size(1), dq.not_null("id"), dq.unique("id")]))
    assert got == {"size_at_least_1": ("Failure", 0.0), "id_not_null": ("Success", 1.0), "id_unique": ("Success", 1.0)}


def test_distinctness_counts_null_once(spark, people):
    rules = {"id": {"unique_check": True, "null_check": True}, "absent": {"null_check": True}}
    assert dq.profile_rules(people, rules).first().asDict() == {"id_null_count": 1, "id_unique_ratio": 0.75}
    assert dq.profile_rules(people.limit(0), {"id": {"unique_check": True}}).first()[0] == 0.0


def test_referential_integrity(spark):
    lines = spark.createDataFrame([("a",)] * 19 + [("x",)], "code string")
    dim = spark.createDataFrame([("a",)], "key string")
    assert tuple(dq.referential_integrity(lines, "code", dim, "key", 0.05).first()) == ("code_in_key", 0.05, 0.05, "Success")
    assert dq.referential_integrity(lines, "code", dim, "key", 0.04).first()["status"] == "Failure"


def test_anomalies(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in [10, 11, 12, 13, 14, 15, 16, 900]] + [(None,)], "v decimal(14,2)")
    assert [int(r["v"]) for r in dq.anomalies(df, "v").filter("is_anomaly").collect()] == [900]
    assert tuple(dq.anomalous_share(df, "v").first()) == (9, 1, 1 / 9)


def test_quarantine_splits_all_rows(people):
    good, rejects = dq.quarantine(people, {"has_id": F.col("id").isNotNull(), "short": F.length("email") < 6})
    assert sorted(r["id"] for r in good.collect()) == ["2", "2"]
    assert {r["id"]: r["reject_reasons"] for r in rejects.collect()} == {None: ["has_id", "short"], "1": ["short"]}


def test_column_profile(people):
    got = {r["column_name"]: tuple(r)[1:] for r in dq.profile_columns(people, ["id", "email"]).collect()}
    assert got == {"id": (4, 1, 2, 0.75, "1", "2"), "email": (4, 1, 3, 0.75, "a@b.co", "c@d.org")}


def test_code_pattern_and_sign(spark):
    df = spark.createDataFrame([("S10_4757", 5), ("T1", -1), (None, 3), ("S1_2", 1)], "code string, amount int")
    got = verdicts(dq.evaluate(df, [dq.product_code_format("code"), dq.positive("amount")]))
    assert got == {"code_format": ("Failure", 0.75), "amount_positive": ("Failure", 0.75)}
