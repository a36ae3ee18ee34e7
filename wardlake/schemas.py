"""Explicit schemas of the source feeds and of the audit table, as DDL text."""

from __future__ import annotations

FEEDS: dict[str, str] = {
    "patients": """Id string, BIRTHDATE string, DEATHDATE string, FIRST string, LAST string,
        MARITAL string, RACE string, ETHNICITY string, GENDER string, ADDRESS string,
        CITY string, STATE string, ZIP string""",
    "encounters": """Id string, START string, STOP string, PATIENT string, ORGANIZATION string,
        PROVIDER string, ENCOUNTERCLASS string, DESCRIPTION string, BASE_ENCOUNTER_COST string,
        TOTAL_CLAIM_COST string, PAYER_COVERAGE string, REASONCODE string,
        REASONDESCRIPTION string""",
    "conditions": """START string, STOP string, PATIENT string, ENCOUNTER string, CODE string,
        DESCRIPTION string""",
    "medications": """START string, STOP string, PATIENT string, ENCOUNTER string, CODE string,
        DESCRIPTION string, DISPENSES string, TOTALCOST string""",
    "procedures": """START string, PATIENT string, ENCOUNTER string, CODE string,
        DESCRIPTION string, BASE_COST string""",
    "claims": """claim_id string, claim_number string, patient_id string, encounter_id string,
        provider_npi string, hospital_code string, carrier string, policy_number string,
        service_date string, submission_date string, decision_date string, status string,
        denial_reason string, primary_diagnosis_code string,
        primary_diagnosis_description string, billed_amount double, allowed_amount double,
        paid_amount double, patient_responsibility double, currency string,
        line_items array<struct<cpt_code:string,description:string,billed_amount:double,units:int>>""",
    "providers": """npi string, first_name string, last_name string, credential string,
        specialty string, primary_facility_code string, facility_name string, city string,
        license_number string, license_state string, license_expiry string, hire_date string,
        is_active boolean, phone string, email string""",
    "facilities": """hospital_code string, hospital_name string, city string, governorate string,
        bed_count string, is_clinic string, lat string, lon string""",
    "vitals": """event_id string, event_time string, device_id string, patient_id string,
        hospital_code string, bed_number string, heart_rate_bpm double, spo2_pct double,
        systolic_bp double, diastolic_bp double, respiratory_rate double, temperature_c double,
        anomaly_flag boolean, anomaly_kind string""",
}

AUDIT = """layer string, object_name string, rule string, rows_read bigint, rows_written bigint,
    rows_rejected bigint, started_at timestamp, finished_at timestamp, status string,
    error_message string, run_id string"""
AUDIT_COLUMNS = [part.split()[0] for part in AUDIT.split(",")]

# Payer names of the network and whether each is a government payer.
PAYERS = {
    "Misr Insurance": False, "Allianz Egypt": False, "AXA Egypt": False, "Bupa Global": False,
    "MetLife Egypt": False, "Self-Pay": False, "Health Insurance Org. (HIO)": True,
}

# Approximate centre (latitude, longitude) of each region.
REGION_CENTRES = {
    "Cairo": (30.0444, 31.2357), "Giza": (29.9870, 31.2118), "Alexandria": (31.2001, 29.9187),
    "Menoufia": (30.5972, 30.9876), "Sharqia": (30.7327, 31.7195), "Dakahlia": (31.0409, 31.3785),
    "Qalyubia": (30.4290, 31.2100), "Gharbia": (30.8760, 31.0335), "Beheira": (30.8480, 30.3436),
    "Aswan": (24.0889, 32.8998), "Luxor": (25.6872, 32.6396), "Suez": (29.9668, 32.5498),
    "Fayoum": (29.3084, 30.8428), "Minya": (28.1099, 30.7503), "Beni Suef": (29.0661, 31.0994),
    "Asyut": (27.1809, 31.1837), "Sohag": (26.5591, 31.6957),
}
DEFAULT_CENTRE = (26.8, 30.8)
