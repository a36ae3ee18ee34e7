"""The nightly run: Bronze to Silver to Gold, whole or for what has been delivered since, and backfills.

The three ways share their steps and end in the same rows. The whole run rewrites every table. The other two
start from some Bronze rows, update Silver by key, and rewrite only the months of Silver and Gold whose
rows can differ: months of new and replaced rows, of stays whose readmission flag follows from them, and of facts
whose parents have arrived or changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.functions.keys import record_hash
from wardlake.operators import audit, dims, dq, facts, rules, scd, silver, surrogates
from wardlake.plans import kpi
from wardlake.sources.tables import TableStore
from wardlake.streaming import vitals

FIRST_VALID = datetime(1900, 1, 1)
EVENT_MONTH = "event_month"
VITALS, VITAL_FACT = "vitals_stream", "fact_vital_signs_minute"


@dataclass
class Config:
    """Where the tables live and the day the run stands for.

    ``method`` deals organisations to facilities; ``run_id`` (a new one by default) and ``clock`` are those of the audit.
    """

    spark: SparkSession
    store: TableStore
    asof: date
    load_ts: datetime
    bronze: dict[str, DataFrame] = field(default_factory=dict)
    hospital_seed: DataFrame | None = None
    method: str = "crc32"
    run_id: str | None = None
    clock: Callable[[], datetime] = audit._utcnow

    def feed(self, name: str) -> DataFrame:
        return self.bronze[name] if name in self.bronze else self.store.read(name)


@dataclass(frozen=True)
class Target:
    """A Silver table: its feed, how a feed's rows get its columns, what must hold, its key and partition."""

    feed: str
    name: str
    shape: Callable[[Config, DataFrame], DataFrame]
    rules: Callable[[Config], dq.Rules]
    key: str
    part: str | None = None


def _events(conform: Callable[[DataFrame], DataFrame], at: str) -> Callable[[Config, DataFrame], DataFrame]:
    """Rows without an id: all their columns are the key, so a feed delivered again counts once and no two events become one."""
    def shape(_: Config, df: DataFrame) -> DataFrame:
        rows = conform(df)
        own = [c for c in rows.columns if c != silver.INGEST_TS]
        return rows.withColumn("row_bk", record_hash(*own)).withColumn(EVENT_MONTH, F.date_format(at, "yyyy-MM"))
    return shape


ENCOUNTERS = Target("synthea_encounters", "silver/fact_encounter",
                    lambda _, df: silver.derive_encounter(silver.conform_encounter(df)),
                    lambda _: rules.encounter(), "encounter_bk", "start_year_month")
CLAIMS = Target("claims_raw", "silver/fact_claim", lambda _, df: silver.derive_claim(silver.conform_claim(df)),
                lambda _: rules.claim(), "claim_bk", "service_year_month")
PATIENTS = Target("synthea_patients", "silver/dim_patient", lambda cfg, df: silver.conform_patient(df, cfg.asof),
                  lambda cfg: rules.patient(cfg.asof), "patient_bk")
PROVIDERS = Target("provider_registry", "silver/dim_provider", lambda _, df: silver.conform_provider(df),
                   lambda _: rules.provider(), "provider_bk")
CONDITIONS = Target("synthea_conditions", "silver/conditions", _events(silver.conform_condition, "onset_date"),
                    lambda _: [], "row_bk", EVENT_MONTH)
MEDICATIONS = Target("synthea_medications", "silver/medications", _events(silver.conform_medication, "start_date"),
                     lambda _: [], "row_bk", EVENT_MONTH)
PROCEDURES = Target("synthea_procedures", "silver/procedures", _events(silver.conform_procedure, "performed_at"),
                    lambda _: [], "row_bk", EVENT_MONTH)
TARGETS = (PATIENTS, PROVIDERS, ENCOUNTERS, CLAIMS, CONDITIONS, MEDICATIONS, PROCEDURES)
#: Silver tables whose keys other tables join on, without a bound on their number.
KEYED = (PATIENTS, PROVIDERS, ENCOUNTERS)


def _checked(cfg: Config, target: Target, rows: DataFrame) -> dq.Checked:
    return dq.apply(target.shape(cfg, rows), target.rules(cfg), cfg.load_ts)


def _latest(target: Target) -> Callable[[DataFrame], DataFrame]:
    return lambda clean: dq.latest(clean, [target.key], [silver.INGEST_TS])


def run_silver(cfg: Config) -> None:
    """Conform, check, deduplicate, derive; readmissions last, on clean rows only."""
    for target in TARGETS:
        latest = _latest(target)
        finish = latest if target is not ENCOUNTERS else lambda clean: silver.flag_readmission(_latest(ENCOUNTERS)(clean))
        audit.observed_silver(cfg.store, _checked(cfg, target, cfg.feed(target.feed)), finish, target.name,
                              [target.part] if target.part else None)


# --- what has changed --------------------------------------------------------------


def _months(*parts: DataFrame) -> list:
    """Distinct values of the one column of each; as many as the calendar has months."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return [row[0] for row in whole.distinct().collect()]


def _among(column: str, values: list) -> Column:
    """Membership as literals, so that it prunes partitions; None is the NULL partition."""
    some = F.col(column).isin([v for v in values if v is not None])
    return some | F.col(column).isNull() if None in values else some


def _keys(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def _upsert_months(cfg: Config, target: Target, new: DataFrame, gone: DataFrame | None = None) -> list:
    """Put ``new`` rows, one per key, into a Silver table partitioned by month; the months that were rewritten.

    Old rows with a key of ``new`` are replaced, those with a key of ``gone`` go. For encounters the flag of
    every stay of the patients concerned is found again, from few columns of their history, and months in
    which one differs are rewritten too.
    """
    store, key, part = cfg.store, target.key, target.part
    if not store.exists(target.name):
        months = _months(new.select(part))
        rows = silver.flag_readmission(new) if target is ENCOUNTERS else new
        store.replace_partitions(rows, target.name, part)
        return months
    old = store.read(target.name)
    # the keys are written once: Spark knows the size of a table, and need not shuffle all of Silver to compare with few keys
    out, path = store.stage(_keys(new, key) if gone is None else _keys(new, key).union(_keys(gone, key)).distinct())
    paths = [path]
    left = old.join(out, key, "left_semi")
    stay = old.join(out, key, "left_anti")
    months = [new.select(part), left.select(part)]
    if target is ENCOUNTERS:
        need = ["patient_bk", key, "start_at", "end_at", "is_inpatient", part]
        who, path = store.stage(_keys(new, "patient_bk").union(_keys(left, "patient_bk")).distinct())
        paths.append(path)
        was, kept = F.col("is_readmission_30d"), stay.withColumnRenamed("is_readmission_30d", "_kept")
        history = stay.select(*need, was.alias("_was")).unionByName(new.select(*need, F.lit(None).cast("boolean").alias("_was")))
        flags, path = store.stage(silver.flag_readmission(history.join(who, "patient_bk", "left_semi")).select(
            key, part, "_was", F.col("is_readmission_30d").alias("_is")))
        paths.append(path)
        months.append(flags.where(~F.col("_was").eqNullSafe(F.col("_is"))).select(part))
        months = _months(*months)
        rows = kept.unionByName(new.withColumn("_kept", F.lit(None).cast("boolean"))).where(_among(part, months))
        rows = (rows.join(flags.where(_among(part, months)).select(key, "_is"), key, "left")
                .withColumn("is_readmission_30d", F.coalesce("_is", "_kept")).select(*old.columns))
    else:
        months = _months(*months)
        rows = stay.unionByName(new).where(_among(part, months)).select(*old.columns)
    if months:
        store.replace_partitions(rows, target.name, part, months)
    for path in paths:
        store.drop(path)
    return months


def _update_silver(cfg: Config, target: Target, fresh: DataFrame, gone: DataFrame | None = None) -> tuple[list, DataFrame, str]:
    """Update one Silver table from Bronze rows: the months rewritten, and the keys of parents that are new, written aside."""
    store, done = cfg.store, []

    def write(rows: DataFrame) -> int:
        new, path = store.stage(rows)
        arrived = _keys(new, *(["encounter_bk"] if "encounter_bk" in new.columns else [target.key]))
        if target.key in arrived.columns and store.exists(target.name):
            arrived = arrived.join(_keys(store.read(target.name), target.key), target.key, "left_anti")
        done.extend(store.stage(arrived))
        if target.part:
            done.append(_upsert_months(cfg, target, new, gone))
        else:
            old = store.read(target.name).join(_keys(new, target.key), target.key, "left_anti") if store.exists(target.name) else None
            store.overwrite(new if old is None else old.unionByName(new), target.name)
            done.append([])
        written = new.count()
        store.drop(path)
        return written

    audit.observed_silver(store, _checked(cfg, target, fresh), _latest(target), target.name, write=write)
    arrived, path, months = done
    return months, arrived, path


# --- gold --------------------------------------------------------------------------


def _run_keys(cfg: Config) -> dict[Target, tuple[DataFrame, str]]:
    """Wide keys for business keys whose short ones agree, kept in ``keys/``; those new now, written aside.

    A key stays wide once it is.
    """
    store, out = cfg.store, {}
    for target in (t for t in KEYED if store.exists(t.name)):
        key, name, known = target.key, f"keys/{target.key}", store.read(target.name)
        short, path = store.stage(surrogates.crowded(known, key))
        rows = surrogates.members(known, key, short)
        if store.exists(name):
            old = store.read(name)
            out[target] = store.stage(rows.join(old.select(key), key, "left_anti"))
            if not out[target][0].isEmpty():
                store.overwrite(old.unionByName(out[target][0]), name)
        else:
            out[target] = store.stage(rows)
            store.overwrite(out[target][0], name)
        store.drop(path)
    return out


def _wide(cfg: Config) -> dict[str, DataFrame]:
    names = {target.key: f"keys/{target.key}" for target in KEYED}
    return {key: cfg.store.read(name) for key, name in names.items() if cfg.store.exists(name)}


def _lacks(cfg: Config, target: Target, gold: str) -> bool:
    """The lake has neither the Silver table nor the Gold table made from it; one with Gold alone can not change its keys and fails."""
    return not cfg.store.exists(target.name) and not cfg.store.exists(gold)


def _months_rekeyed(cfg: Config, fresh: dict[Target, tuple[DataFrame, str]]) -> dict[str, list]:
    """Months of the facts that hold a key which has become wide; none of a fact that the lake lacks."""
    some = {target: rows for target, (rows, _) in fresh.items() if not rows.isEmpty()}

    def months(name: str, target: Target, *parents: Target) -> list:
        if _lacks(cfg, target, name):
            return []
        found = [_months_of(cfg.store.read(target.name), target.part, p.key, [some[p]]) for p in parents if p in some]
        return [m for part in found for m in part]

    facts_of = [("fact_encounter", ENCOUNTERS, *KEYED), ("fact_claim", CLAIMS, *KEYED), ("fact_prescription", MEDICATIONS, PATIENTS, ENCOUNTERS)]
    return {name: months(name, *targets) for name, *targets in facts_of}


def _merge(cfg: Config, name: str, incoming: DataFrame, sk: str, key: str, version: str, attrs: list[str]) -> None:
    """A key's first version opens at the start of time, so facts that came before it find one; each version has a key of its own."""
    if cfg.store.exists(name):
        out = scd.merge2(cfg.store.read(name).drop(version), incoming, [key], attrs, cfg.load_ts, FIRST_VALID)
    else:
        out = scd.first_load(dims.with_unknown(incoming, sk, key), attrs, FIRST_VALID)
    out = surrogates.rekeyed(out, key, sk, _wide(cfg))
    audit.observed_overwrite(cfg.store, scd.with_version_sk(out, key, version), "gold", name)


def _run_dimensions(cfg: Config, some: bool = False) -> None:
    """All dimensions and the bridge. With ``some`` the lake may lack Silver tables, and what is made from those stays as it is."""
    store, read = cfg.store, cfg.store.read

    def due(*sources: Target) -> bool:
        return not some or all(store.exists(target.name) for target in sources)

    if cfg.hospital_seed is not None:
        seed = dims.with_unknown(dims.hospital_from_seed(cfg.hospital_seed), "hospital_sk", "hospital_bk")
        audit.observed_overwrite(store, seed, "gold", "dim_hospital")
    if due(PATIENTS):
        _merge(cfg, "dim_patient", dims.patient_incoming(read(PATIENTS.name)), "patient_sk", "patient_bk",
               "patient_version_sk", scd.PATIENT_ATTRS)
    if due(PROVIDERS):
        _merge(cfg, "dim_provider", dims.provider_incoming(read(PROVIDERS.name), _facilities(cfg)), "provider_sk",
               "provider_bk", "provider_version_sk", scd.PROVIDER_ATTRS)

    def coded() -> DataFrame:
        return read(CLAIMS.name).select("primary_icd10_code", "primary_diagnosis_description").unionByName(
            read(CONDITIONS.name).select(F.col("icd10_code").alias("primary_icd10_code"),
                                         F.col("description").alias("primary_diagnosis_description")))

    for name, sources, build, sk, bk in [
        ("dim_payer", [CLAIMS], lambda: dims.payer(read(CLAIMS.name)), "payer_sk", "payer_name"),
        ("dim_diagnosis", [CLAIMS, CONDITIONS], lambda: dims.diagnosis(coded()), "diagnosis_sk", "icd10_code"),
        ("dim_drug", [MEDICATIONS], lambda: dims.drug(read(MEDICATIONS.name)), "drug_sk", "rxnorm_code"),
        ("dim_procedure", [PROCEDURES], lambda: dims.procedure(read(PROCEDURES.name)), "procedure_sk", "cpt_code"),
    ]:
        if due(*sources):
            audit.observed_overwrite(store, dims.with_unknown(build(), sk, bk), "gold", name)
    if not store.exists("dim_date"):
        audit.observed_overwrite(store, dims.calendar(cfg.spark), "gold", "dim_date")
    bridge = "bridge_encounter_diagnosis"
    if not some or not _lacks(cfg, CONDITIONS, bridge):
        conditions = surrogates.attach(read(CONDITIONS.name), _wide(cfg))
        audit.observed_overwrite(store, facts.bridge_diagnosis(conditions), "gold", bridge)


def _facilities(cfg: Config) -> DataFrame:
    """The facilities without member -1, which no organisation is dealt to."""
    return cfg.store.read("dim_hospital").where(F.col("hospital_bk") != dims.UNKNOWN_BK)


def _parent(cfg: Config, name: str) -> DataFrame | None:
    return cfg.store.read(name) if cfg.store.exists(name) else None


def _encounter_facts(cfg: Config, stays: DataFrame) -> DataFrame:
    return facts.encounter(stays, _facilities(cfg), _parent(cfg, "silver/dim_patient"), _parent(cfg, "silver/dim_provider"),
                           _parent(cfg, "bridge_encounter_diagnosis"), cfg.method, _parent(cfg, "dim_patient"))


def _fact(cfg: Config, name: str, silver_name: str, part: str, day: str, build: Callable[[DataFrame], DataFrame],
          months: list | None) -> None:
    """A fact partitioned by month: all of it, or ``months`` of its Silver table ('yyyy-MM'), which without any is not read."""
    if months is not None and not months:
        return
    rows = cfg.store.read(silver_name)
    if months is not None:
        rows = rows.where(_among(part, months))
    df = build(surrogates.attach(rows, _wide(cfg))).withColumns({"gold_loaded_at": F.lit(cfg.load_ts), dates.MONTH: dates.month_of(day)})
    if months is None:
        audit.observed_overwrite(cfg.store, df, "gold", name, [dates.MONTH])
    else:
        keys = [None if v is None else int(v.replace("-", "")) for v in months]
        audit.observed(cfg.store, "gold", name, lambda watch: cfg.store.replace_partitions(df, name, dates.MONTH, keys, watch=watch))


def _run_facts(cfg: Config, stays: list | None = None, claims: list | None = None, drugs: list | None = None) -> None:
    """All facts, or given months of each."""
    encounters = cfg.store.read(ENCOUNTERS.name)
    _fact(cfg, "fact_encounter", ENCOUNTERS.name, ENCOUNTERS.part, "start_date_sk", lambda df: _encounter_facts(cfg, df), stays)
    _fact(cfg, "fact_claim", CLAIMS.name, CLAIMS.part, "service_date_sk", lambda df: facts.claim(df, encounters), claims)
    _fact(cfg, "fact_claim_line", CLAIMS.name, CLAIMS.part, "service_date_sk",
          lambda df: facts.claim_line(df.withColumn("service_date_sk", facts.date_sk("service_date")), ["service_date_sk"]), claims)
    _fact(cfg, "fact_prescription", MEDICATIONS.name, MEDICATIONS.part, "start_date_sk", facts.prescription, drugs)


def run_gold(cfg: Config) -> None:
    """Dimensions first, then facts that look their parents up."""
    for _, path in _run_keys(cfg).values():
        cfg.store.drop(path)
    _run_dimensions(cfg)
    _run_facts(cfg)


def _readings(df: DataFrame) -> DataFrame:
    """Bronze vitals of the batch or the stream reader, with their event time and day; without one a row is no reading."""
    rows = df if "event_ts" in df.columns else df.withColumn("event_ts", F.try_to_timestamp(F.col("event_time")))
    return rows.where(F.col("event_ts").isNotNull()).withColumn("_day", facts.date_sk("event_ts"))


def run_vitals(cfg: Config, since: datetime | None = None) -> list[int]:
    """Minutes of the bedside readings with resolved parents, by day; the days written anew.

    A reading delivered again counts once. With ``since`` only days with readings ingested later are built again,
    from the deliveries of those days and after.
    """
    store = cfg.store
    if VITALS not in cfg.bronze and not store.exists(VITALS):
        return []
    rows = _readings(cfg.feed(VITALS))
    days = None
    if since is not None:
        late = rows.where(F.col(silver.INGEST_TS) > F.lit(since)).select("_day")
        days = sorted(r[0] for r in late.distinct().collect())
        if not days:
            return []
        rows = rows.where(F.col("_day").isin(days))
        if "_ingest_date" in rows.columns:  # nothing is delivered before it happens
            first = date(days[0] // 10000, days[0] // 100 % 100, days[0] % 100)
            rows = rows.where(F.col("_ingest_date") >= F.lit(first))
    once = vitals.dedup(vitals.flag_anomalies(rows.drop("_day")))
    fact = vitals.fact_minutes(vitals.minute_aggregate(once, None), _facilities(cfg), _parent(cfg, "dim_patient"))
    if days is None:
        audit.observed_overwrite(store, fact, "gold", VITAL_FACT, ["date_sk"])
    else:
        audit.observed(store, "gold", VITAL_FACT, lambda watch: store.replace_partitions(fact, VITAL_FACT, "date_sk", days, watch=watch))
    return days or []


# --- runs --------------------------------------------------------------------------


def run(cfg: Config, lo: date | None = None, hi: date | None = None) -> None:
    """The whole night; with a range only the daily cube of those days is refreshed after."""
    with audit.run(cfg.store, "night", cfg.run_id, cfg.clock):
        run_silver(cfg)
        run_gold(cfg)
        run_vitals(cfg)
        start, end = lo or cfg.asof - timedelta(days=35), hi or cfg.asof
        kpi.refresh_daily(cfg.store, cfg.store.read("fact_encounter"), start, end,
                          refreshed_at=cfg.load_ts)


def _refresh_cube(cfg: Config, months: list[str]) -> None:
    """The cube of the months; neighbouring months are refreshed at once."""
    fact, runs = cfg.store.read("fact_encounter"), []
    for month in sorted(m for m in months if m is not None):
        first = date(int(month[:4]), int(month[5:]), 1)
        after = dates.shift(first, -1, "month")
        if runs and runs[-1][1] == first:
            runs[-1][1] = after
        else:
            runs.append([first, after])
    for first, after in runs:
        kpi.refresh_daily(cfg.store, fact, first, after - timedelta(days=1), refreshed_at=cfg.load_ts)


def _months_of(df: DataFrame, part: str, key: str, changed: list[DataFrame]) -> list:
    """Months of the rows whose ``key`` is in one of the written key tables."""
    found = [df.join(keys, key, "left_semi").select(part) for keys in changed if key in keys.columns]
    return _months(*found) if found else []


def run_since(cfg: Config, since: datetime) -> dict[str, list]:
    """A night over the Bronze rows ingested after ``since``; the months of each fact that were written anew.

    Ends in the rows that the whole run over all of Bronze gives (but for load times and the versions of
    dimensions, which are those of the nights). Late parents are found: encounters of a patient or provider that
    arrives now, and claims of an encounter that does, are resolved again.
    """
    with audit.run(cfg.store, "increment", cfg.run_id, cfg.clock):
        return _run_since(cfg, since)


def _run_since(cfg: Config, since: datetime) -> dict[str, list]:
    months, arrived, paths = {}, {}, []
    for target in TARGETS:
        fresh = cfg.feed(target.feed).where(F.col(silver.INGEST_TS) > F.lit(since))
        months[target], arrived[target], path = _update_silver(cfg, target, fresh)
        paths.append(path)
    fresh_keys = _run_keys(cfg)
    paths += [path for _, path in fresh_keys.values()]
    rekeyed = _months_rekeyed(cfg, fresh_keys)
    _run_dimensions(cfg)
    stays, claims = cfg.store.read(ENCOUNTERS.name), cfg.store.read(CLAIMS.name)
    again = {
        "fact_encounter": sorted({*months[ENCOUNTERS], *_months_of(stays, ENCOUNTERS.part, "patient_bk", [arrived[PATIENTS]]),
                                  *_months_of(stays, ENCOUNTERS.part, "provider_bk", [arrived[PROVIDERS]]),
                                  *_months_of(stays, ENCOUNTERS.part, "encounter_bk", [arrived[CONDITIONS]]),
                                  *rekeyed["fact_encounter"]}),
        "fact_claim": sorted({*months[CLAIMS], *_months_of(claims, CLAIMS.part, "encounter_bk", [arrived[ENCOUNTERS]]), *rekeyed["fact_claim"]},
                             key=lambda m: m or ""),
        "fact_prescription": sorted({*months[MEDICATIONS], *rekeyed["fact_prescription"]}, key=lambda m: m or ""),
    }
    _run_facts(cfg, again["fact_encounter"], again["fact_claim"], again["fact_prescription"])
    again[VITAL_FACT] = run_vitals(cfg, since if fresh_keys[PATIENTS][0].isEmpty() else None)
    _refresh_cube(cfg, again["fact_encounter"])
    for path in paths:
        cfg.store.drop(path)
    return again


def backfill(cfg: Config, lo: date, hi: date) -> list:
    """Process the encounters that start in ``lo`` to ``hi`` again, from all of Bronze; the months written anew. Other Silver tables may be missing.

    Rows of those days that Bronze no longer has, or that fail a rule now, go. Flags of later stays that
    follow from them are found again, and ``fact_encounter`` and the daily cube of the months concerned
    are rewritten with all their parents.
    """
    with audit.run(cfg.store, "backfill", cfg.run_id, cfg.clock):
        return _backfill(cfg, lo, hi)


def _backfill(cfg: Config, lo: date, hi: date) -> list:
    inside = ((F.col("start_at") >= F.lit(lo).cast("timestamp"))
              & (F.col("start_at") < F.lit(hi + timedelta(days=1)).cast("timestamp")))
    key, part = ENCOUNTERS.key, ENCOUNTERS.part
    clean = dq.apply(ENCOUNTERS.shape(cfg, cfg.feed(ENCOUNTERS.feed)), rules.encounter()).clean
    gone, wanted = None, clean.where(inside).select(key, F.lit(False).alias("_here"))
    if cfg.store.exists(ENCOUNTERS.name):  # a row that starts elsewhere now is processed as well
        gone = cfg.store.read(ENCOUNTERS.name).where(inside & F.col(part).between(lo.strftime("%Y-%m"), hi.strftime("%Y-%m")))
        wanted = wanted.union(gone.select(key, F.lit(True)))
    # of all of Bronze only rows of these keys are compared
    wanted, keys_path = cfg.store.stage(wanted.groupBy(key).agg(F.max("_here").alias("_here")))
    known = dq.latest(clean.join(wanted, key, "left_semi"), [key], [silver.INGEST_TS])
    known = known.join(wanted, key).where(inside | F.col("_here")).drop("_here")
    new, path = cfg.store.stage(known)
    months = _upsert_months(cfg, ENCOUNTERS, new, gone)
    fresh_keys = _run_keys(cfg)
    rekeyed = _months_rekeyed(cfg, fresh_keys)
    months = list({*months, *rekeyed["fact_encounter"]})
    if any(rekeyed.values()):
        _run_dimensions(cfg, some=True)
        _run_facts(cfg, months, rekeyed["fact_claim"], rekeyed["fact_prescription"])
    else:
        _fact(cfg, "fact_encounter", ENCOUNTERS.name, ENCOUNTERS.part, "start_date_sk", lambda df: _encounter_facts(cfg, df), months)
    for _, aside in fresh_keys.values():
        cfg.store.drop(aside)
    _refresh_cube(cfg, months)
    cfg.store.drop(path)
    cfg.store.drop(keys_path)
    return sorted(months)
