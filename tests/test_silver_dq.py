from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardlake.operators import dq, rules, silver
from wardlake.schemas import FEEDS


def encounters(spark, data):
    """(id, patient, class, start, stop) with the other feed columns NULL."""
    full = [(i, s, e, p, "org", None, c, None, "1", "10.00", "4.00", None, None)
            for i, p, c, s, e in data]
    return silver.derive_encounter(silver.conform_encounter(spark.createDataFrame(full, FEEDS["encounters"])))


def flags(df):
    return {r["encounter_bk"]: r["is_readmission_30d"] for r in silver.flag_readmission(df).collect()}


def test_readmission_across_outpatient_visit(spark):
    df = encounters(spark, [
        ("a", "p", "inpatient", "2020-01-01", "2020-01-05"),
        ("b", "p", "ambulatory", "2020-01-08", "2020-01-08"),
        ("c", "p", "inpatient", "2020-01-10", "2020-01-12")])
    assert flags(df) == {"a": False, "b": False, "c": True}


def test_stay_inside_a_longer_stay_is_no_readmission(spark):
    df = encounters(spark, [
        ("a", "p", "inpatient", "2020-01-01", "2020-03-01"),
        ("b", "p", "inpatient", "2020-01-05", "2020-01-08"),
        ("c", "p", "inpatient", "2020-01-20", "2020-01-21"),
        ("d", "p", "inpatient", "2020-03-10", "2020-03-11"),
        ("e", "q", "inpatient", "2020-01-01", None),
        ("f", "q", "inpatient", "2020-01-05", "2020-01-06"),
        ("g", "q", "inpatient", "2020-01-10", "2020-01-11")])
    assert flags(df) == {"a": False, "b": False, "c": False, "d": True, "e": False, "f": False, "g": False}


def test_readmission_limits(spark):
    df = encounters(spark, [
        ("a", "p", "inpatient", "2020-01-01", "2020-01-05 12:00:00"),
        ("b", "p", "inpatient", "2020-01-03", "2020-01-06"),
        ("c", "q", "inpatient", "2020-01-01", "2020-01-05 12:00:00"),
        ("d", "q", "inpatient", "2020-02-04 12:00:00", "2020-02-05"),
        ("e", "r", "inpatient", "2020-01-01", "2020-01-05 12:00:00"),
        ("f", "r", "inpatient", "2020-02-04 12:00:01", "2020-02-05"),
        ("g", "s", "inpatient", "2020-01-01", None),
        ("h", "s", "inpatient", "2020-01-09", "2020-01-10")])
    got = flags(df)
    assert got["b"] is False          # overlapping stay
    assert got["d"] is True           # exactly 30 days
    assert got["f"] is False          # one second more
    assert got["h"] is False          # earlier stay still open


def test_redelivered_encounter_is_one_row_and_not_flagged(spark):
    one = encounters(spark, [("a", "p", "inpatient", "2020-01-01", "2020-01-05")])
    early = one.withColumn("_ingest_ts", F.lit(datetime(2020, 2, 1)))
    late = one.withColumn("_ingest_ts", F.lit(datetime(2020, 2, 2))).withColumn("encounter_type", F.lit("new"))
    kept = dq.latest(early.unionByName(late), ["encounter_bk"], ["_ingest_ts"])
    assert flags(kept) == {"a": False}
    assert [r["encounter_type"] for r in kept.collect()] == ["new"]


def test_malformed_text_becomes_null_and_is_rejected(spark):
    df = encounters(spark, [("a", "p", "wellness", "garbage", None), ("b", "p", "wellness", "2020-01-01", "x")])
    done = dq.apply(df, rules.encounter())
    assert {r["encounter_bk"]: r[dq.RULE] for r in done.tagged.collect()} == {
        "a": "start_at_present", "b": None}
    assert done.clean.collect()[0]["length_of_stay_hours"] is None


def test_first_failing_rule_wins_and_null_fails(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 50)], "i int, v int")
    done = dq.apply(df, [("positive", F.col("v") > 0), ("small", F.col("v") < 10)], datetime(2020, 1, 1))
    assert {r["i"]: r[dq.RULE] for r in done.tagged.collect()} == {
        1: None, 2: "positive", 3: "positive", 4: "small"}
    assert done.clean.count() + done.rejected.count() == 4
    got = [(r["rule"], r["total"], r["rejected"], float(r["rejected_pct"]))
           for r in done.metrics().orderBy("rule_order").collect()]
    assert got == [("positive", 4, 2, 50.0), ("small", 2, 1, 50.0)]


def test_not_null_split(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None), (3, "ok"), (4, None)], "i int, v string")
    done = dq.split(df, F.col("v").isNotNull(), "v_present")
    assert done.clean.count() == 2
    assert {r[dq.RULE] for r in done.rejected.collect()} == {"v_present"}


@pytest.mark.parametrize("paid,rule", [("10.01", None), ("10.02", "paid_le_billed")])
def test_paid_tolerance(spark, paid, rule):
    df = spark.createDataFrame(
        [("c", "approved", Decimal("10.00"), Decimal(paid), date(2020, 1, 2), date(2020, 1, 3))],
        "claim_bk string, status string, billed_amount decimal(12,2), paid_amount decimal(12,2), "
        "submission_date date, decision_date date")
    assert dq.apply(df, rules.claim()).tagged.collect()[0][dq.RULE] == rule


def test_claim_amounts(spark):
    rows = [("a", "denied", 100.0, 0.0), ("b", "approved", 100.0, 80.0), ("c", "submitted", 100.0, 0.0)]
    cols = "claim_id, status, billed_amount, allowed_amount".split(", ")
    df = spark.createDataFrame([], FEEDS["claims"])
    data = [tuple(dict(zip(cols, r)).get(c) for c in df.columns) for r in rows]
    got = {r["claim_bk"]: r for r in silver.derive_claim(
        silver.conform_claim(spark.createDataFrame(data, FEEDS["claims"]))).collect()}
    assert [float(got[k]["denied_amount"]) for k in "abc"] == [100, 20, 100]
    assert [float(got[k]["pending_amount"]) for k in "abc"] == [0, 0, 100]


def test_patient_gender_and_missing_dob(spark):
    names = spark.createDataFrame([], FEEDS["patients"]).columns
    data = [{"Id": "1", "GENDER": "male", "BIRTHDATE": "1990-01-01"}, {"Id": "2"},
            {"Id": "3", "GENDER": "x", "BIRTHDATE": "1990-01-01"},
            {"Id": "4", "GENDER": "F", "BIRTHDATE": "2050-01-01"}]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in data], FEEDS["patients"])
    done = dq.apply(silver.conform_patient(df, date(2020, 1, 1)), rules.patient(date(2020, 1, 1)))
    assert {r["patient_bk"]: (r["gender"], r[dq.RULE]) for r in done.tagged.collect()} == {
        "1": ("M", None), "2": ("U", "dob_present"), "3": ("X", "gender_valid"),
        "4": ("F", "dob_not_in_future")}


def test_quarantine_of_nothing_adds_no_partition(spark, store):
    df = spark.createDataFrame([(1, 5)], "i int, v int")
    bad = dq.apply(df, [("never", F.col("v") < 0)])
    dq.write_quarantine(bad, store, "q")
    dq.write_quarantine(dq.apply(df, [("never", F.col("v") > 0)]), store, "q")
    assert store.read("q").count() == 1


def test_service_date_rule_lets_orphans_pass(spark):
    claims = spark.createDataFrame(
        [("in", "e", date(2020, 1, 2)), ("out", "e", date(2020, 2, 2)), ("orphan", "x", date(2020, 1, 1))],
        "claim_bk string, encounter_bk string, service_date date")
    enc = encounters(spark, [("e", "p", "inpatient", "2020-01-01", "2020-01-05")])
    got = {r["claim_bk"]: r[dq.RULE] for r in dq.claim_in_encounter(claims, enc).tagged.collect()}
    assert got == {"in": None, "out": "service_in_encounter", "orphan": None}
