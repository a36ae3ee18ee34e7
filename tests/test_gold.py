import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from wardlake.functions.keys import UNKNOWN_SK, hash_sk
from wardlake.operators import dims, facts, governance, profile, scd, silver
from wardlake.plans import analytics, views
from wardlake.schemas import FEEDS

T0, T1, T2 = datetime(1900, 1, 1), datetime(2020, 1, 1), datetime(2021, 1, 1)
SCHEMA = "bk string, city string, tag string"


def claims(spark, *encounters):
    rows = [{"claim_id": f"c{i}", "encounter_id": e, "patient_id": "p1", "carrier": "AXA Egypt", "primary_diagnosis_code": "E11",
             "status": "denied"} for i, e in enumerate(encounters)]
    return silver.derive_claim(silver.conform_claim(spark.createDataFrame(rows, FEEDS["claims"])))


def unsized_plan(spark, df):
    """The plan for sides that Spark does not know to be small."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_claims_are_neither_broadcast_to_nor_sorted_for_their_encounters(spark, tuples):
    known = spark.createDataFrame([("e1",), ("e1",), ("e2",), (None,)], "encounter_bk string")
    fact = facts.claim(claims(spark, "e1", "gone", None, "e1"), known)
    assert "ShuffledHashJoin" in unsized_plan(spark, fact)
    assert "SortMergeJoin" not in unsized_plan(spark, facts.claim(claims(spark, "e1"), known))
    sk = spark.range(1).select(hash_sk(F.lit("e1"))).first()[0]
    assert tuples(fact, "claim_bk", "encounter_sk") == [("c0", sk), ("c1", None), ("c2", None), ("c3", sk)]


def test_claim_view_shuffles_facts_for_patients_only(spark, tuples):
    fed = claims(spark, "e1", "e2")
    t = {"fact_claim": facts.claim(fed), "dim_date": dims.calendar(spark, T1.date(), T1.date()), "dim_payer": dims.payer(fed),
         "dim_diagnosis": dims.diagnosis(fed),
         "dim_hospital": spark.createDataFrame([], "hospital_sk long, hospital_name string, facility_type string"),
         "dim_patient": spark.createDataFrame([(1, True, "x", "F", "Cairo")], "patient_sk long, is_current boolean, age_band string, gender string, governorate string")}
    plan = unsized_plan(spark, views.claim_enriched(t))
    assert not any(f"hashpartitioning({code}" in plan for code in ("payer_sk", "hospital_sk", "primary_diagnosis_sk"))
    assert tuples(views.claim_enriched(t), "payer_name", "primary_icd10_code", "hospital_name") == [("AXA Egypt", "E11", None)] * 2


def test_erasure_writes_rows_where_they_were_without_a_shuffle(spark, store, tuples):
    for i in range(3):
        store.append(spark.createDataFrame([("a", i, 1), ("b", i, 1)], "bk string, v int, part int"), "t", ["part"])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        governance.erase_everywhere(store, {"t": governance.Held("bk", "bk", ("part",))}, spark.createDataFrame([("a",)], "bk string"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert tuples(store.read("t"), "bk", "v") == [("b", 0), ("b", 1), ("b", 2)]
    assert len(store.files(f"{store.path('t')}/part=1")) == 3


def load(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def merge(spark, current, rows, ts):
    return scd.merge2(current, load(spark, *rows), ["bk"], ["city", "tag"], ts)


def first(spark):
    return scd.first_load(load(spark, ("a", "X", "1"), ("b", "Y", "1"), ("c", "Z", None)),
                          ["city", "tag"], T0)


def test_merge_twice_changes_nothing(spark, tuples):
    rows = [("a", "X2", "1"), ("b", "Y", "1"), ("d", "W", "1")]
    once = merge(spark, first(spark), rows, T1)
    assert tuples(merge(spark, once, rows, T2)) == tuples(once)


def test_one_close_and_one_insert(spark):
    out = merge(spark, first(spark), [("a", "X2", "1"), ("b", "Y", "1")], T1).collect()
    a = sorted((r for r in out if r["bk"] == "a"), key=lambda r: r["effective_from"])
    assert len(out) == 4 and len(a) == 2
    assert a[0]["effective_to"] == T1 == a[1]["effective_from"]
    assert not a[0]["is_current"] and a[1]["is_current"] and a[1]["city"] == "X2"
    c = [r for r in out if r["bk"] == "c"]
    assert len(c) == 1 and c[0]["is_current"]     # absent key is untouched


def test_null_and_empty_do_not_open_a_version(spark):
    out = merge(spark, first(spark), [("c", "Z", "")], T1)
    assert out.where("bk = 'c'").count() == 1


def test_validity_intervals_do_not_overlap(spark):
    out = first(spark)
    for ts, city in [(T1, "X2"), (T2, "X3")]:
        out = merge(spark, out, [("a", city, "1")], ts)
    assert out.where("is_current").groupBy("bk").count().where("count <> 1").count() == 0
    a, b = out.alias("a"), out.alias("b")
    clash = a.join(b, (F.col("a.bk") == F.col("b.bk"))
                   & (F.col("a.effective_from") < F.col("b.effective_from"))
                   & (F.coalesce(F.col("a.effective_to"), F.lit(datetime(9999, 1, 1)))
                      > F.col("b.effective_from")))
    assert clash.count() == 0
    keyed = scd.with_version_sk(out, "bk", "version_sk")
    assert keyed.select("version_sk").distinct().count() == out.count()


def test_point_in_time_is_half_open(spark):
    dim = merge(spark, first(spark), [("a", "X2", "1")], T1)
    fact = spark.createDataFrame([(1, "a", datetime(2019, 12, 31, 23, 59, 59)), (2, "a", T1), (3, "zz", T1)],
                                 "i int, bk string, ts timestamp")
    got = {r["i"]: r["city"] for r in scd.as_of(fact, dim, "bk", "ts", ["city"]).collect()}
    assert got == {1: "X", 2: "X2", 3: None}


def test_equal_loads_with_a_null_key_add_nothing(spark, tuples):
    rows = [(None, "X", "1"), ("a", "Y", None)]
    once = scd.first_load(load(spark, *rows), ["city", "tag"], T0)
    twice = merge(spark, merge(spark, once, rows, T1), rows, T2)
    assert tuples(twice) == tuples(once)
    assert merge(spark, once, [(None, "Z", "1")], T1).where("bk is null").count() == 2
    assert scd.changed(once, load(spark, *rows), ["bk"], ["city", "tag"], T1).count() == 0


def test_point_in_time_equals_a_range_join(spark, tuples):
    """Many events and versions of one key, events at version starts, gaps, NULL keys and times."""
    rng = random.Random(4)
    starts = {k: sorted(rng.sample(range(0, 400), n)) for k, n in (("hot", 60), ("a", 1), ("b", 5))}
    base, dim = datetime(2020, 1, 1), []
    for k, days in starts.items():
        for i, day in enumerate(days):
            end = days[i + 1] if i + 1 < len(days) else None
            if end is not None and rng.random() < 0.3:
                end -= rng.random() / 2                        # a gap before the next version
            dim.append((k, base + timedelta(days=day), None if end is None else base + timedelta(days=end), f"{k}{day}"))
    dim.append((None, base, None, "nobody"))
    dim = spark.createDataFrame(dim, "bk string, effective_from timestamp, effective_to timestamp, city string")
    facts_ = [(i, rng.choice(["hot", "hot", "a", "b", "zz", None]),
               rng.choice([None, base + timedelta(days=rng.randrange(420)), base + timedelta(hours=rng.randrange(9600))])) for i in range(500)]
    fact = spark.createDataFrame(facts_ + facts_[:5], "i int, bk string, ts timestamp")
    got = scd.as_of(fact, dim, "bk", "ts", ["city"])
    assert got.columns == ["i", "bk", "ts", "city"]
    d = dim.withColumnRenamed("bk", "k")
    hit = (F.col("bk") == F.col("k")) & (F.col("ts") >= F.col("effective_from")) & (
        F.col("effective_to").isNull() | (F.col("ts") < F.col("effective_to")))
    assert tuples(got, "i", "city") == tuples(fact.join(d, hit, "left"), "i", "city")


def test_changed_lists_new_and_changed(spark):
    got = scd.changed(first(spark), load(spark, ("a", "X2", "1"), ("b", "Y", "1"), ("n", "N", "1")),
                      ["bk"], ["city", "tag"], T1)
    assert {r["bk"]: r["change"] for r in got.collect()} == {"a": "changed", "n": "new"}


def test_unknown_members_and_orphans(spark):
    enc = spark.createDataFrame([("e1", "p1", "np", "o"), ("e2", "gone", None, "o")],
                                "encounter_bk string, patient_bk string, provider_bk string, organization_bk string")
    for c, kind in [("start_at", "timestamp"), ("end_at", "timestamp"), ("encounter_class", "string"),
                    ("length_of_stay_hours", "decimal(10,2)"), ("base_cost_usd", "decimal(12,2)"),
                    ("total_cost_usd", "decimal(12,2)"), ("payer_coverage_usd", "decimal(12,2)"),
                    ("out_of_pocket_usd", "decimal(12,2)"), ("is_inpatient", "boolean"),
                    ("is_emergency", "boolean")]:
        enc = enc.withColumn(c, F.lit(None).cast(kind))
    hosp = spark.createDataFrame([("h", 7)], "hospital_bk string, hospital_sk bigint")
    pats = spark.createDataFrame([("p1",)], "patient_bk string")
    provs = spark.createDataFrame([("np",)], "provider_bk string")
    got = {r["encounter_bk"]: r for r in facts.encounter(enc, hosp, pats, provs).collect()}
    assert len(got) == 2 and {r["hospital_sk"] for r in got.values()} == {7}
    assert got["e2"]["patient_sk"] == UNKNOWN_SK and got["e2"]["provider_sk"] == UNKNOWN_SK
    assert got["e1"]["patient_sk"] == spark.range(1).select(hash_sk(F.lit("p1"))).collect()[0][0]


def test_bridge_has_one_primary(spark):
    df = spark.createDataFrame(
        [("e", "B", date(2020, 1, 2)), ("e", "A", date(2020, 1, 2)), ("e", "A", date(2020, 1, 1)),
         ("e", "C", None), ("f", "C", None)], "encounter_bk string, icd10_code string, onset_date date")
    out = facts.bridge_diagnosis(df)
    assert out.count() == 4
    assert out.where("is_primary").count() == 2
    a = spark.range(1).select(hash_sk(F.lit("A"))).collect()[0][0]
    assert out.where("is_primary").where(F.col("diagnosis_sk") == a).count() == 1


def test_payer_keeps_seeded_flag(spark):
    claims = spark.createDataFrame([("Health Insurance Org. (HIO)",), ("Other",), ("Other",), (None,)],
                                   "carrier string")
    got = {r["payer_name"]: r["is_government"] for r in dims.payer(claims).collect()}
    assert got == {"Health Insurance Org. (HIO)": True, "Other": False}


def test_diagnosis_without_description_is_null(spark):
    df = spark.createDataFrame([("I10", None)],
                               "primary_icd10_code string, primary_diagnosis_description string")
    assert dims.diagnosis(df).collect()[0]["description"] is None


def test_calendar(spark):
    days = spark.createDataFrame([(date(2024, 1, 7),)], "calendar_date date")
    cal = dims.calendar(spark, date(2018, 1, 1), date(2030, 12, 31), days)
    assert cal.count() == 4748
    r = cal.where("date_sk = 20240107").collect()[0]
    assert (r["day_of_week"], r["day_name"], r["us_week"], r["iso_week"]) == (1, "Sunday", 2, 1)
    assert r["is_weekend"] and r["is_holiday"] and r["fiscal_quarter"] == 3
    assert dims.calendar(spark).count() == 47847
    assert dims.clock(spark).count() == 1440


def test_co_occurrence_against_brute_force(spark, tuples):
    data = [("p1", c) for c in "ABC"] + [("p2", c) for c in "AB"] + [("p3", "A"), ("p3", "A"), ("p4", "Z")]
    df = spark.createDataFrame(data, "patient_bk string, icd10_code string")
    pairs = analytics.co_occurrence(df, list("ABC"))
    assert tuples(pairs) == [("A", "B", 2), ("A", "C", 1), ("B", "C", 1)]
    wide = {r["code_a"]: r for r in analytics.co_occurrence_matrix(pairs, list("ABC")).collect()}
    assert wide["A"]["B"] == 2 and wide["B"]["B"] == 0


def test_suppress_mask_restrict_erase(spark, tuples):
    cells = spark.createDataFrame([("a", 4, 1), ("b", 5, 2)], "k string, n int, d int")
    assert tuples(governance.suppress(cells, "n", ["d"])) == [("a", None, None), ("b", 5, 2)]
    names = spark.createDataFrame([("Ann 7",), ("\u0622\u0646",)], "name string")
    assert [r[0] for r in governance.mask(names, ["name"], "Analyst").collect()] == ["Xxx*n", "**"]
    assert governance.mask(names, ["name"], "no such role").collect()[0][0] == "Xxx*n"
    assert governance.mask(names, ["name"], "Clinician").collect()[0][0] == "Ann 7"
    rows = spark.createDataFrame([("h1",), ("h2",)], "hospital_bk string")
    member = spark.createDataFrame([("u", "h1"), ("u", "h1")], "user_name string, hospital_bk string")
    assert tuples(governance.restrict(rows, "u", "HospitalOps", member)) == [("h1",)]
    assert governance.restrict(rows, "x", "RevenueCycle", member).count() == 2
    assert tuples(governance.erase(rows, rows.where("hospital_bk = 'h1'"), "hospital_bk")) == [("h2",)]


def test_planted_key_collision_is_found(spark, tuples):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 2), ("c", 2), (None, 3), ("d", 3), ("e", None), ("f", None)], "bk string, sk long")
    assert tuples(profile.key_collisions(df, "bk", "sk"), "sk", "least_bk", "greatest_bk") == [(2, "b", "c")]
    assert profile.key_collisions(df.limit(0), "bk", "sk").count() == 0


def test_profiles(spark, tuples):
    df = spark.createDataFrame([(1.0, None), (2.0, "x"), (3.0, None), (4.0, "x")], "v double, s string")
    assert tuples(profile.null_rates(df)) == [("s", 0.5), ("v", 0.0)]
    assert tuples(profile.histogram(df, "v", 3)) == [(0, 1), (1, 1), (2, 2)]
    assert tuples(profile.histogram(df.where("v = 1"), "v", 3)) == [(0, 1)]
    one = profile.numeric(df, "v").collect()[0]
    assert (one["n"], one["mean"], one["p50"], one["hi"]) == (4, 2.5, 2.5, 4.0)
    gaps = spark.createDataFrame([(date(2020, 1, 5),), (date(2020, 3, 5),)], "d date")
    assert [r["n"] for r in profile.monthly(gaps, "d").orderBy("month").collect()] == [1, 0, 1]


def test_erasure_rewrites_only_folders_of_the_subject(spark, store, tuples):
    rows = spark.createDataFrame([("a", 1, 202001), ("b", 2, 202001), ("b", 3, 202002), ("a", 4, 202003), (None, 5, None), ("a", 6, None)],
                                 "bk string, v int, month_sk int")
    store.append(rows, "t", ["month_sk"])
    store.overwrite(rows, "plain")
    store.overwrite(rows.where("bk = 'b'"), "other")
    kept = {m: store.files(f"{store.path('t')}/month_sk={m}") for m in (202001, 202002, 202003)}
    other = store.files(store.path("other"))
    held = governance.Held("bk", "who")
    subjects = spark.createDataFrame([("a",), (None,)], "who string")
    done = governance.erase_everywhere(store, {"t": governance.Held("bk", "who", ("month_sk",)), "plain": held, "other": held}, subjects)
    assert done == {"t": ["month_sk=202001", "month_sk=202003", "month_sk=__HIVE_DEFAULT_PARTITION__"], "plain": ["plain"], "other": []}
    assert tuples(store.read("t"), "v") == tuples(store.read("plain"), "v") == [(2,), (3,), (5,)]
    assert store.files(f"{store.path('t')}/month_sk=202002") == kept[202002] and store.files(store.path("other")) == other
    assert store.files(f"{store.path('t')}/month_sk=202003") == [] and store.files(f"{store.path('t')}/month_sk=202001") != kept[202001]
