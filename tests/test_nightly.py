from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardlake.functions.keys import hash_sk
from wardlake.operators import audit, dims, monitor, surrogates
from wardlake.plans import nightly, queries, views
from wardlake.schemas import FEEDS
from wardlake.sources.tables import TableStore


def feed(spark, name, *rows, ts=datetime(2020, 6, 1)):
    names = spark.createDataFrame([], FEEDS[name]).columns
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FEEDS[name])
    return df.withColumn("_ingest_ts", F.lit(ts))


def bronze(spark, city="Ohio"):
    return {
        "synthea_patients": feed(
            spark, "patients",
            {"Id": "p1", "FIRST": "A", "LAST": "B", "BIRTHDATE": "1950-01-01", "GENDER": "F", "STATE": city},
            {"Id": "p2", "FIRST": "C", "LAST": "D", "BIRTHDATE": "garbage", "GENDER": "M"}),
        "provider_registry": feed(
            spark, "providers",
            {"npi": "0000000001", "first_name": "Doc", "last_name": "X", "primary_facility_code": "h1",
             "is_active": True},
            {"npi": "12345", "first_name": "Bad", "last_name": "Y"}),
        "synthea_encounters": feed(
            spark, "encounters",
            {"Id": "e1", "PATIENT": "p1", "PROVIDER": "0000000001", "ORGANIZATION": "o1",
             "ENCOUNTERCLASS": "inpatient", "START": "2020-05-01 08:00:00", "STOP": "2020-05-03 08:00:00",
             "TOTAL_CLAIM_COST": "100.00", "PAYER_COVERAGE": "80.00"},
            {"Id": "e2", "PATIENT": "p1", "ORGANIZATION": "o1", "ENCOUNTERCLASS": "inpatient",
             "START": "2020-05-10 08:00:00", "STOP": "2020-05-11 08:00:00", "TOTAL_CLAIM_COST": "50.00"},
            {"Id": "e2", "PATIENT": "p1", "ORGANIZATION": "o1", "ENCOUNTERCLASS": "inpatient",
             "START": "2020-05-10 08:00:00", "STOP": "2020-05-11 08:00:00", "TOTAL_CLAIM_COST": "50.00"},
            {"Id": "e3", "PATIENT": "p2", "ORGANIZATION": "o1", "ENCOUNTERCLASS": "wellness",
             "START": "2020-05-12 08:00:00", "TOTAL_CLAIM_COST": "10.00"},
            {"Id": "e4", "PATIENT": "p1", "ORGANIZATION": "o1", "ENCOUNTERCLASS": "wellness",
             "START": "2020-05-12 08:00:00", "TOTAL_CLAIM_COST": "-1.00"}),
        "claims_raw": feed(
            spark, "claims",
            {"claim_id": "c1", "claim_number": "C-1", "encounter_id": "e1", "patient_id": "p1",
             "carrier": "Self-Pay", "status": "denied", "service_date": "2020-05-02", "billed_amount": 10.0,
             "allowed_amount": 0.0, "paid_amount": 0.0, "primary_diagnosis_code": "I10",
             "line_items": [("99213", "visit", 10.0, 1)]},
            {"claim_id": "c2", "claim_number": "C-2", "encounter_id": "zz", "patient_id": "p1",
             "carrier": "Self-Pay", "status": "approved", "service_date": "2020-05-02",
             "billed_amount": 10.0, "allowed_amount": 8.0, "paid_amount": 8.0}),
        "synthea_conditions": feed(
            spark, "conditions",
            {"ENCOUNTER": "e1", "PATIENT": "p1", "CODE": "I10", "START": "2020-05-01"}),
        "synthea_medications": feed(
            spark, "medications",
            {"ENCOUNTER": "e1", "PATIENT": "p1", "CODE": "314076", "START": "2020-05-01",
             "STOP": "2020-05-31", "TOTALCOST": "5.00"}),
        "synthea_procedures": feed(
            spark, "procedures",
            {"ENCOUNTER": "e1", "PATIENT": "p1", "CODE": "99213", "START": "2020-05-01 09:00:00"}),
    }


@pytest.fixture
def cfg(spark, store):
    seed = spark.createDataFrame([("h1", "One", "C", "Cairo", "10", "0", "30.1", "31.1")], FEEDS["facilities"])
    return nightly.Config(spark, store, date(2020, 6, 1), datetime(2020, 6, 1), bronze(spark), seed)


def test_night_run_twice_and_after_a_change(cfg, spark, store, tuples):
    nightly.run(cfg)
    fe = {r["encounter_bk"]: r for r in store.read("fact_encounter").collect()}
    assert set(fe) == {"e1", "e2", "e3"}                       # negative cost rejected, repeat merged
    assert fe["e2"]["is_readmission_30d"] and not fe["e1"]["is_readmission_30d"]
    assert fe["e3"]["patient_sk"] == -1                        # quarantined patient stays visible
    assert fe["e2"]["provider_sk"] == -1 and fe["e1"]["primary_diagnosis_sk"] is not None
    claims = {r["claim_bk"]: r["encounter_sk"] for r in store.read("fact_claim").collect()}
    assert claims["c2"] is None and claims["c1"] == fe["e1"]["encounter_sk"]
    assert store.read("quarantine/silver/dim_patient").count() == 1
    cube = tuples(store.read("kpi_daily_hospital").drop("refreshed_at"))
    assert len(cube) == 3
    rate = monitor.rejection_rate(store.read(audit.TABLE), datetime(2100, 1, 1), 36500)
    assert rate.where("object_name = 'silver/fact_encounter' and rule = 'non_negative_cost'") \
        .collect()[0]["rejected_share"] == 0.2

    nights = monitor.runs(store.read(audit.TABLE)).collect()
    assert [(r["run_name"], r["status"]) for r in nights] == [("night", "success")] and nights[0]["duration_s"] >= 1
    layers = {r[0] for r in store.read(audit.TABLE).select("layer").distinct().collect()}
    assert layers == {"run", "silver", "gold", "kpi"} and store.read(audit.TABLE).where("run_id is null").count() == 0

    facts_before = tuples(store.read("fact_encounter"))
    nightly.run(cfg)
    assert tuples(store.read("fact_encounter")) == facts_before
    assert tuples(store.read("dim_patient"), "patient_bk") == [("UNKNOWN",), ("p1",)]
    assert tuples(store.read("kpi_daily_hospital").drop("refreshed_at")) == cube

    later = nightly.Config(spark, store, date(2020, 6, 2), datetime(2020, 6, 2), bronze(spark, "Utah"),
                           cfg.hospital_seed)
    nightly.run(later)
    dim = store.read("dim_patient").where("patient_bk = 'p1'").orderBy("effective_from").collect()
    assert [r["is_current"] for r in dim] == [False, True]
    t = {n: store.read(n) for n in views.ENCOUNTER_TABLES}
    seen = {r["encounter_id"]: r["patient_governorate"] for r in views.encounter_enriched(t).collect()}
    assert seen["e1"] == dim[1]["governorate"]                 # old facts keep their patient
    assert fe["e1"]["patient_version_sk"] == dim[0]["patient_version_sk"] != dim[1]["patient_version_sk"]
    named = {r["encounter_id"]: r["patient_id"] for r in views.encounter_enriched(t).collect()}
    assert named["e3"] == "UNKNOWN" and len(named) == 3
    assert store.read("quarantine/silver/dim_patient").where("_quarantine_run = 20200601000000").count() == 1


def test_feeds_delivered_twice_count_once_and_facts_prune_by_month(cfg, spark, store):
    for name in ("synthea_conditions", "synthea_medications", "synthea_procedures"):
        again = cfg.bronze[name].withColumn("_ingest_ts", F.lit(datetime(2020, 6, 2)))
        cfg.bronze[name] = cfg.bronze[name].unionByName(again)
    nightly.run(cfg)
    assert store.read("fact_prescription").count() == 1
    assert store.read("silver/procedures").count() == 1
    t = {n: store.read(n) for n in ("fact_claim", "dim_payer", "dim_hospital", "dim_date")}
    plan = queries.q12(t, date(2020, 6, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month_sk" in plan and "month_sk" in plan.split("PartitionFilters", 1)[1][:120]
    assert store.read("fact_encounter").select("gold_loaded_at").distinct().first()[0] == cfg.load_ts


def night(spark, lake, upto, since=None, asof=date(2020, 7, 1)):
    """Bronze of a network as delivered up to a day: corrections, late patients, moved and nested stays."""
    def stay(i, day, patient, start, stop, **more):
        return day, {"Id": i, "PATIENT": patient, "ORGANIZATION": "o1", "ENCOUNTERCLASS": "inpatient", "START": start, "STOP": stop,
                     "TOTAL_CLAIM_COST": "5.00", **more}

    rows = {
        "synthea_patients": [(1, {"Id": p, "FIRST": p, "BIRTHDATE": "1950-01-01", "GENDER": "F"}) for p in ("p1", "p2", "p4")]
        + [(2, {"Id": "p3", "FIRST": "late", "BIRTHDATE": "1960-01-01", "GENDER": "M"})],
        "provider_registry": [(1, {"npi": "0000000001", "first_name": "D", "last_name": "X", "primary_facility_code": "h1"}),
                              (3, {"npi": "0000000002", "first_name": "E", "last_name": "Y", "primary_facility_code": "h1"})],
        "synthea_encounters": [
            stay("a", 1, "p1", "2020-01-02 08:00:00", "2020-01-05 08:00:00", PROVIDER="0000000001"),
            stay("b", 1, "p1", "2020-01-20 08:00:00", "2020-01-22 08:00:00"),          # a readmission until a lasts longer
            stay("c", 1, "p3", "2020-02-02 08:00:00", "2020-02-03 08:00:00", PROVIDER="0000000002"),
            stay("d", 1, "p2", "2020-03-02 08:00:00", "2020-03-03 08:00:00"),          # moves to May, March is empty then
            stay("e", 1, "p4", "2020-04-01 08:00:00", "2020-04-02 08:00:00"),
            stay("f", 1, "p4", "2020-04-10 08:00:00", "2020-04-11 08:00:00"),          # no readmission once e is p2's
            stay("a", 2, "p1", "2020-01-02 08:00:00", "2020-03-01 08:00:00", PROVIDER="0000000001"),
            stay("d", 2, "p2", "2020-05-02 08:00:00", "2020-05-03 08:00:00"),
            stay("d", 3, "p2", "2020-06-02 08:00:00", "2020-05-03 08:00:00"),          # rejected, the one before stays
            stay("e", 3, "p2", "2020-04-01 08:00:00", "2020-04-20 08:00:00"),
            stay("g", 3, "p1", "2020-03-15 08:00:00", "2020-03-16 08:00:00")],
        "claims_raw": [(1, {"claim_id": "c1", "encounter_id": "g", "patient_id": "p1", "carrier": "Self-Pay", "status": "approved",
                            "service_date": "2020-03-15", "billed_amount": 10.0, "allowed_amount": 8.0, "paid_amount": 8.0,
                            "line_items": [("1", "v", 10.0, 1)]}),
                       (2, {"claim_id": "c2", "encounter_id": "a", "patient_id": "p1", "carrier": "AXA Egypt", "status": "denied",
                            "billed_amount": 7.0, "allowed_amount": 0.0, "paid_amount": 0.0})],
        "synthea_conditions": [(1, {"ENCOUNTER": "a", "PATIENT": "p1", "CODE": "I10", "START": "2020-01-02"}),
                               (3, {"ENCOUNTER": "f", "PATIENT": "p4", "CODE": "E11", "START": "2020-04-10"})],
        "synthea_medications": [(day, {"ENCOUNTER": "a", "PATIENT": "p1", "CODE": "314076", "START": "2020-01-02", "TOTALCOST": cost})
                                for day, cost in ((1, "5.00"), (1, "6.00"), (2, "5.00"))],
        "synthea_procedures": [(1, {"ENCOUNTER": "a", "PATIENT": "p1", "CODE": "99213", "START": "2020-01-02 09:00:00"})],
    }
    feeds = {"synthea_patients": "patients", "provider_registry": "providers", "synthea_encounters": "encounters", "claims_raw": "claims",
             "synthea_conditions": "conditions", "synthea_medications": "medications", "synthea_procedures": "procedures"}
    out = {}
    for name, given in rows.items():
        parts = [feed(spark, feeds[name], *[r for d, r in given if d == day], ts=datetime(2020, 6, day)) for day in range(1, upto + 1)]
        out[name] = parts[0]
        for part in parts[1:]:
            out[name] = out[name].unionByName(part)
    seed = spark.createDataFrame([("h1", "One", "C", "Cairo", "10", "0", "30.1", "31.1")], FEEDS["facilities"])
    return nightly.Config(spark, lake, asof, datetime(2020, 6, upto, 23), out, seed)


def test_a_chain_of_nights_equals_the_whole_run(spark, tmp_path, tuples):
    chain, whole = TableStore(spark, f"{tmp_path}/chain"), TableStore(spark, f"{tmp_path}/whole")
    days = {"lo": date(2020, 1, 1), "hi": date(2020, 6, 30)}
    nightly.run(night(spark, chain, 1), **days)
    first = {r["encounter_bk"]: r for r in chain.read("fact_encounter").collect()}
    assert first["b"]["is_readmission_30d"] and first["f"]["is_readmission_30d"] and first["c"]["patient_sk"] == -1
    kept = chain.files(f"{chain.path('fact_encounter')}/month_sk=202004")
    again = nightly.run_since(night(spark, chain, 2), datetime(2020, 6, 1))
    assert again["fact_encounter"] == ["2020-01", "2020-02", "2020-03", "2020-05"]     # April is not touched
    assert chain.files(f"{chain.path('fact_encounter')}/month_sk=202004") == kept
    nightly.run_since(night(spark, chain, 3), datetime(2020, 6, 2))
    nightly.run(night(spark, whole, 3), **days)
    for name in ("fact_encounter", "fact_claim", "fact_claim_line", "fact_prescription", "silver/fact_encounter",
                 "silver/medications", "bridge_encounter_diagnosis", "kpi_daily_hospital"):
        a, b = chain.read(name), whole.read(name)
        cols = sorted(c for c in a.columns if c not in ("gold_loaded_at", "refreshed_at", "_ingest_ts"))
        assert tuples(a, *cols) == tuples(b, *cols), name
    done = {r["encounter_bk"]: r for r in chain.read("fact_encounter").collect()}
    assert not done["b"]["is_readmission_30d"] and not done["f"]["is_readmission_30d"] and done["g"]["is_readmission_30d"]
    assert done["c"]["patient_sk"] != -1 and done["c"]["provider_sk"] != -1            # parents that came late
    assert chain.read("fact_claim").where("claim_bk = 'c1' and encounter_sk is not null").count() == 1
    assert chain.read("quarantine/silver/fact_encounter").count() == 1
    t = {n: chain.read(n) for n in views.ENCOUNTER_TABLES}
    assert views.encounter_enriched(t).count() == len(done)
    assert done["a"]["patient_version_sk"] in [r[0] for r in chain.read("dim_patient").select("patient_version_sk").collect()]


#: Two ten-digit ids whose 48-bit keys agree.
TWINS = ("0020208069", "0034090849")


def twins(spark, lake, upto):
    """Patients, providers and stays whose short keys collide in pairs; the second of each arrives on day 2."""
    def of(make):
        return [(day + 1, make(x, day)) for day, x in enumerate(TWINS)]

    rows = {
        "patients": of(lambda x, d: {"Id": x, "FIRST": f"n{d}", "BIRTHDATE": f"19{5 + d}0-01-01", "GENDER": "FM"[d], "STATE": "Ohio"}),
        "providers": of(lambda x, d: {"npi": x, "first_name": f"doc{d}", "last_name": "X", "primary_facility_code": "h1"}),
        "encounters": of(lambda x, d: {"Id": x, "PATIENT": x, "PROVIDER": x, "ORGANIZATION": "o1", "ENCOUNTERCLASS": "inpatient",
                                       "START": f"2020-0{d + 3}-01 08:00:00", "STOP": f"2020-0{d + 3}-02 08:00:00", "TOTAL_CLAIM_COST": "5.00"}),
        "claims": of(lambda x, d: {"claim_id": f"c{d}", "encounter_id": x, "patient_id": x, "provider_npi": x, "carrier": "Self-Pay", "status": "approved",
                                   "service_date": f"2020-0{d + 3}-01", "billed_amount": 10.0 + d, "allowed_amount": 8.0, "paid_amount": 4.0 + 4 * d}),
        "conditions": of(lambda x, d: {"ENCOUNTER": x, "PATIENT": x, "CODE": ("I10", "E11")[d], "START": "2020-03-01"}),
        "medications": of(lambda x, d: {"ENCOUNTER": x, "PATIENT": x, "CODE": "314076", "START": "2020-03-01", "TOTALCOST": "5.00"}),
        "procedures": of(lambda x, d: {"ENCOUNTER": x, "PATIENT": x, "CODE": "99213", "START": "2020-03-01 09:00:00"})}
    names = {t.feed.split("_", 1)[1] if t.feed.startswith("synthea") else {"claims_raw": "claims", "provider_registry": "providers"}[t.feed]: t.feed
             for t in nightly.TARGETS}
    out = {}
    for name, given in rows.items():
        parts = [feed(spark, name, r, ts=datetime(2020, 6, day)) for day, r in given if day <= upto]
        out[names[name]] = parts[0] if upto == 1 else parts[0].unionByName(parts[1])
    seed = spark.createDataFrame([("h1", "One", "C", "Cairo", "10", "0", "30.1", "31.1")], FEEDS["facilities"])
    return nightly.Config(spark, lake, date(2020, 7, 1), datetime(2020, 6, upto, 23), out, seed)


def test_keys_that_collide_are_told_apart(spark, tmp_path, tuples):
    assert spark.range(1).select(hash_sk(F.lit(TWINS[0])) == hash_sk(F.lit(TWINS[1]))).first()[0]
    chain, whole = TableStore(spark, f"{tmp_path}/chain"), TableStore(spark, f"{tmp_path}/whole")
    nightly.run(twins(spark, chain, 1))
    short = chain.read("fact_encounter").first()["encounter_sk"]
    assert short < surrogates.WIDE_FROM and chain.read("keys/encounter_bk").count() == 0
    again = nightly.run_since(twins(spark, chain, 2), datetime(2020, 6, 1))
    assert again["fact_encounter"] == ["2020-03", "2020-04"] == again["fact_claim"]     # the first stay has a new key as well
    nightly.run(twins(spark, whole, 2))
    for lake in (chain, whole):
        stays = {r["encounter_bk"]: r for r in lake.read("fact_encounter").collect()}
        assert len({r["encounter_sk"] for r in stays.values()}) == len({r["patient_sk"] for r in stays.values()}) == 2
        assert len({r["provider_sk"] for r in stays.values()}) == 2 and min(r["encounter_sk"] for r in stays.values()) >= surrogates.WIDE_FROM
        claims = {r["claim_bk"]: r for r in lake.read("fact_claim").collect()}
        for d, x in enumerate(TWINS):
            assert [claims[f"c{d}"][c] for c in ("encounter_sk", "patient_sk", "provider_sk")] == \
                [stays[x][c] for c in ("encounter_sk", "patient_sk", "provider_sk")]
        for dim, bk, sk in (("dim_patient", "patient_bk", "patient_sk"), ("dim_provider", "provider_bk", "provider_sk")):
            assert dict(tuples(lake.read(dim).where(f"{bk} <> 'UNKNOWN'"), bk, sk)) == {x: stays[x][sk] for x in TWINS}
        names = ("fact_encounter", "fact_claim", "bridge_encounter_diagnosis", "dim_patient", "dim_diagnosis", "dim_hospital", "dim_date")
        t = {n: lake.read(n) for n in names}
        day = date(2020, 6, 1)
        q5 = queries.q05(t, day).collect()
        assert len(q5) == 1 and q5[0]["encounters"] == 2
        joined = t["fact_encounter"].join(t["fact_claim"].select("encounter_sk", "paid_amount"), "encounter_sk")
        assert [float(r["paid_amount"]) for r in joined.orderBy("encounter_bk").collect()] == [4.0, 8.0]
        sick = t["bridge_encounter_diagnosis"].join(t["fact_encounter"], "encounter_sk").join(t["dim_diagnosis"], "diagnosis_sk")
        assert tuples(sick, "encounter_bk", "icd10_code") == [(TWINS[0], "I10"), (TWINS[1], "E11")]
        people = t["dim_patient"].where("is_current")
        assert t["fact_encounter"].join(people, "patient_sk").count() == 2
    for name in ("fact_encounter", "fact_claim", "fact_prescription", "bridge_encounter_diagnosis", "keys/patient_bk"):
        cols = sorted(c for c in whole.read(name).columns if c not in ("gold_loaded_at", "patient_version_sk"))
        assert tuples(chain.read(name), *cols) == tuples(whole.read(name), *cols), name


def lake_of_twins(spark, store, *others):
    """A lake with the first stay alone and all rows of a few other Silver tables."""
    cfg, target = twins(spark, store, 2), nightly.ENCOUNTERS
    store.overwrite(dims.hospital_from_seed(cfg.hospital_seed), "dim_hospital")
    cfg.hospital_seed = None
    for other in others:
        store.overwrite(other.shape(cfg, cfg.feed(other.feed)), other.name, [other.part] if other.part else None)
    first = target.shape(cfg, cfg.feed(target.feed)).where(F.col("encounter_bk") == TWINS[0])
    store.overwrite(first.withColumn("is_readmission_30d", F.lit(False)), target.name, [target.part])
    return cfg


@pytest.mark.parametrize("others", [(), (nightly.CLAIMS, nightly.PATIENTS)])
def test_a_backfill_with_keys_that_collide_needs_no_other_tables(spark, store, tuples, others):
    cfg = lake_of_twins(spark, store, *others)
    # the second stay is in April; the first one's month holds a key that has become wide
    assert nightly.backfill(cfg, date(2020, 4, 1), date(2020, 4, 30)) == ["2020-03", "2020-04"]
    stays = {r["encounter_bk"]: r for r in store.read("fact_encounter").collect()}
    wide = dict(tuples(store.read("keys/encounter_bk"), "encounter_bk", "sk"))
    assert set(stays) == set(TWINS) == set(wide) and {x: r["encounter_sk"] for x, r in stays.items()} == wide
    assert min(wide.values()) >= surrogates.WIDE_FROM and len(set(wide.values())) == 2
    assert tuples(store.read("kpi_daily_hospital"), "date_sk", "encounter_count") == [(20200301, 1), (20200401, 1)]
    assert not any(store.exists(name) for name in ("bridge_encounter_diagnosis", "dim_provider", "fact_prescription", "dim_diagnosis"))
    assert store.exists("fact_claim") == store.exists("dim_patient") == bool(others)
    if others:
        claims = {r["claim_bk"]: r for r in store.read("fact_claim").collect()}
        people = dict(tuples(store.read("dim_patient"), "patient_bk", "patient_sk"))
        for d, x in enumerate(TWINS):
            assert claims[f"c{d}"]["encounter_sk"] == wide[x] and claims[f"c{d}"]["patient_sk"] == people[x] == stays[x]["patient_sk"]


def test_a_backfill_fails_where_only_gold_holds_keys_that_become_wide(spark, store):
    cfg = lake_of_twins(spark, store)
    store.overwrite(spark.range(1), "fact_claim")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        nightly.backfill(cfg, date(2020, 4, 1), date(2020, 4, 30))


def test_vitals_of_a_night(spark, store, tuples):
    def readings(*rows, ts):
        given = [{"event_id": e, "event_time": t, "device_id": "d", "patient_id": p, "hospital_code": "h1", "bed_number": "b1",
                  "heart_rate_bpm": hr} for e, t, p, hr in rows]
        return feed(spark, "vitals", *given, ts=ts).withColumn("_ingest_date", F.to_date("_ingest_ts"))

    seed = spark.createDataFrame([("h1", "One", "C", "Cairo", "10", "0", "30.1", "31.1")], FEEDS["facilities"])
    store.overwrite(dims.with_unknown(dims.hospital_from_seed(seed), "hospital_sk", "hospital_bk"), "dim_hospital")
    first = readings(("1", "2020-06-01T08:00:05.000Z", "p1", 140.0), ("2", "2020-06-02T08:00:05.000Z", "p1", 80.0),
                     ("3", "noon", "p1", 80.0), ts=datetime(2020, 6, 2, 9))
    second = readings(("1", "2020-06-01T08:00:05.000Z", "p1", 140.0), ("4", "2020-06-01T08:00:09.000Z", "p1", 60.0),
                      ("5", "2020-06-03T08:00:05.000Z", "p2", 80.0), ts=datetime(2020, 6, 3, 9))
    cfg = nightly.Config(spark, store, date(2020, 6, 3), datetime(2020, 6, 3), {"vitals_stream": first})
    assert nightly.run_vitals(cfg) == []
    kept = store.files(f"{store.path('fact_vital_signs_minute')}/date_sk=20200602")
    assert len(kept) and store.read("fact_vital_signs_minute").count() == 2
    cfg.bronze["vitals_stream"] = first.unionByName(second)
    assert nightly.run_vitals(cfg, datetime(2020, 6, 2, 10)) == [20200601, 20200603]
    got = tuples(store.read("fact_vital_signs_minute"), "date_sk", "sample_count", "anomaly_event_count")
    assert got == [(20200601, 2, 1), (20200602, 1, 0), (20200603, 1, 0)]
    assert store.files(f"{store.path('fact_vital_signs_minute')}/date_sk=20200602") == kept
    nightly.run_vitals(cfg)
    assert tuples(store.read("fact_vital_signs_minute"), "date_sk", "sample_count", "anomaly_event_count") == got
    assert nightly.run_vitals(cfg, datetime(2020, 6, 4)) == []
    t = {"fact_vital_signs_minute": store.read("fact_vital_signs_minute"), "dim_hospital": store.read("dim_hospital")}
    assert {r[0] for r in t["fact_vital_signs_minute"].join(t["dim_hospital"], "hospital_sk").select("hospital_name").collect()} == {"One"}


def test_backfill_compares_versions_of_its_own_stays_only(cfg, store, monkeypatch):
    nightly.run(cfg)
    seen, latest = [], nightly.dq.latest
    monkeypatch.setattr(nightly.dq, "latest", lambda df, *more: (seen.append({r[0] for r in df.select("encounter_bk").collect()}), latest(df, *more))[1])
    nightly.backfill(cfg, date(2020, 5, 10), date(2020, 5, 10))
    starts = store.read("silver/fact_encounter").where("date(start_at) = '2020-05-10'").select("encounter_bk").collect()
    assert seen == [{r[0] for r in starts}] and len(seen[0]) < store.read("silver/fact_encounter").count()


def test_backfill_touches_only_its_months(cfg, store, tuples):
    nightly.run_silver(cfg)
    nightly.run_gold(cfg)
    before = tuples(store.read("fact_encounter"))
    assert nightly.backfill(cfg, date(2020, 5, 10), date(2020, 5, 10)) == ["2020-05"]
    assert tuples(store.read("fact_encounter")) == before
    cfg.bronze["synthea_encounters"] = cfg.bronze["synthea_encounters"].where("Id <> 'e1'")
    assert nightly.backfill(cfg, date(2020, 5, 1), date(2020, 5, 1)) == ["2020-05"]
    after = {r["encounter_bk"]: r["is_readmission_30d"] for r in store.read("fact_encounter").collect()}
    assert after == {"e2": False, "e3": False}
    assert store.read("kpi_daily_hospital").agg(F.sum("encounter_count")).first()[0] == 2
