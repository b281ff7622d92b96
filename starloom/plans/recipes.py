"""What distinguishes one table of the star from another, as data.

Fixed values: attribute order feeds the surrogate key, and names, types and defaults are
part of the published star layout.
"""

from __future__ import annotations

from dataclasses import dataclass

from starloom.functions.defaults import Attribute as A
from starloom.functions.keys import UNKNOWN_ID

UNK = "Unknown"


@dataclass(frozen=True)
class CodeDimension:
    table: str
    entity: str
    key: str
    attributes: tuple
    require_any: bool = False


@dataclass(frozen=True)
class Bridge:
    table: str
    group_table: str
    entity: str
    group: str
    member: str
    attributes: tuple


@dataclass(frozen=True)
class EntityDimension:
    table: str
    entity: str
    key: str
    natural_id: str
    attributes: tuple


def code(prefix: str, source: str = "CODE", dtype: str = "bigint") -> A:
    return A(source, f"{prefix}_Code", dtype, 0)


def text(prefix: str, suffix: str, source: str) -> A:
    return A(source, f"{prefix}_{suffix}", "string", UNK)


def description(prefix: str) -> A:
    return text(prefix, "Description", "DESCRIPTION")


def cost(prefix: str) -> A:
    return A("BASE_COST", f"{prefix}_Base_Cost", "double", 0.0)


CODE_DIMENSIONS = {
    d.table: d
    for d in [
        CodeDimension("dim_allergies", "allergies", "Allergy_Key",
                      (code("Allergy"), text("Allergy", "System", "SYSTEM"), description("Allergy"))),
        CodeDimension("dim_care_plans", "careplans", "Care_Plan_Key",
                      (code("Care_Plan"), description("Care_Plan"))),
        CodeDimension("dim_conditions", "conditions", "Condition_Key",
                      (code("Condition"), description("Condition"))),
        CodeDimension("dim_devices", "devices", "Device_Key",
                      (code("Device"), description("Device"), text("Device", "UDI", "UDI"))),
        CodeDimension("dim_encounter_codes", "encounters", "Encounter_Code_Key",
                      (A("CODE", "Encounter_Code", "bigint", 0),
                       A("ENCOUNTERCLASS", "Encounter_Class", "string", UNK),
                       A("DESCRIPTION", "Encounter_Description", "string", UNK)),
                      require_any=True),
        CodeDimension("dim_encounter_reason_codes", "encounters", "Encounter_Reason_Code_Key",
                      (A("REASONCODE", "Encounter_Reason_Code", "bigint", 0),
                       A("REASONDESCRIPTION", "Encounter_Reason_Code_Description", "string", UNK)),
                      require_any=True),
        CodeDimension("dim_imaging_studies", "imaging_studies", "Imaging_Study_Key",
                      (code("Imaging_Study_Bodysite", "BODYSITE_CODE"),
                       text("Imaging_Study_Bodysite", "Description", "BODYSITE_DESCRIPTION"),
                       text("Imaging_Study_Modality", "Code", "MODALITY_CODE"),
                       text("Imaging_Study_Modality", "Description", "MODALITY_DESCRIPTION"))),
        CodeDimension("dim_immunizations", "immunizations", "Immunization_Key",
                      (code("Immunization"), description("Immunization"), cost("Immunization"))),
        CodeDimension("dim_medications", "medications", "Medication_Key",
                      (code("Medication"), description("Medication"), cost("Medication"))),
        CodeDimension("dim_observations", "observations", "Observation_Key",
                      (A("CODE", "Observation_Code", "string", "0"),
                       text("Observation", "Category", "CATEGORY"), description("Observation"))),
        CodeDimension("dim_procedures", "procedures", "Procedure_Key",
                      (code("Procedure"), description("Procedure"), cost("Procedure"))),
        CodeDimension("dim_supplies", "supplies", "Supply_Key",
                      (code("Supply"), description("Supply"),
                       A("QUANTITY", "Supply_Quantity", "bigint", 0))),
    ]
}


def _bridge(stem: str, prefix: str, dim: str) -> Bridge:
    recipe = CODE_DIMENSIONS[dim]
    return Bridge(f"bridge_{stem}_group", f"dim_{stem}_group", recipe.entity,
                  f"{prefix}_Group_Key", recipe.key, recipe.attributes)


BRIDGES = {
    b.table: b
    for b in [
        _bridge("allergy", "Allergy", "dim_allergies"),
        _bridge("care_plan", "Care_Plan", "dim_care_plans"),
        _bridge("condition", "Condition", "dim_conditions"),
        _bridge("device", "Device", "dim_devices"),
        _bridge("imaging_study", "Imaging_Study", "dim_imaging_studies"),
        _bridge("immunization", "Immunization", "dim_immunizations"),
        _bridge("medication", "Medication", "dim_medications"),
        _bridge("observation", "Observation", "dim_observations"),
        _bridge("procedure", "Procedure", "dim_procedures"),
        _bridge("supply", "Supply", "dim_supplies"),
    ]
}

GROUP_TABLES = {b.group_table: b.group for b in BRIDGES.values()}


def _natural_id(prefix: str) -> A:
    return A("ID", f"{prefix}_Id", "string", UNKNOWN_ID)


def _typed(prefix: str, rows: str) -> list[A]:
    """Parse ``SOURCE Suffix type default`` lines; ``-`` stands for the empty text."""
    out = []
    for line in rows.strip().splitlines():
        source, suffix, dtype, default = line.split()
        value: object = "" if default == "-" else default
        if dtype == "double":
            value = float(default)
        elif dtype == "bigint":
            value = int(default)
        out.append(A(source, f"{prefix}_{suffix}", dtype, value))
    return out


PATIENT = (_natural_id("Patient"), *_typed("Patient", """
    BIRTHDATE Birth_Date date 1900-01-01
    DEATHDATE Death_Date date 9999-12-31
    SSN SSN string Unknown
    DRIVERS Drivers string Unknown
    PASSPORT Passport string Unknown
    PREFIX Prefix string -
    FIRST First string Unknown
    MIDDLE Middle string -
    LAST Last string -
    SUFFIX Suffix string -
    MAIDEN Maiden string -
    MARITAL Marital string Unknown
    RACE Race string Unknown
    ETHNICITY Ethnicity string Unknown
    GENDER Gender string Unknown
    BIRTHPLACE BirthPlace string Unknown
    ADDRESS Address string Unknown
    CITY City string Unknown
    STATE State string Unknown
    COUNTY County string Unknown
    FIPS FIPS_County_Code string Unknown
    ZIP Zip string Unknown
    LAT Lat double 0.0
    LON Lon double 0.0
    HEALTHCARE_EXPENSES Healthcare_Expenses double 0.0
    HEALTHCARE_COVERAGE Healthcare_Coverage double 0.0
    INCOME Income double 0.0
"""))

ORGANIZATION = (_natural_id("Organization"), *_typed("Organization", """
    NAME Name string Unknown
    ADDRESS Address string Unknown
    CITY City string Unknown
    STATE State string Unknown
    ZIP Zip string Unknown
    LAT Lat double 0.0
    LON Lon double 0.0
    PHONE Phone string Unknown
    REVENUE Revenue double 0.0
    UTILIZATION Utilization bigint 0
"""))

PAYER = (_natural_id("Payer"), *_typed("Payer", """
    NAME Name string Unknown
    OWNERSHIP Ownership string Unknown
    ADDRESS Address string Unknown
    CITY City string Unknown
    STATE_HEADQUARTERED State_Headquartered string Unknown
    ZIP Zip string Unknown
    PHONE Phone string Unknown
    AMOUNT_COVERED Amount_Covered double 0.0
    AMOUNT_UNCOVERED Amount_Uncovered double 0.0
    REVENUE Revenue double 0.0
    COVERED_ENCOUNTERS Covered_Encounters bigint 0
    UNCOVERED_ENCOUNTERS Uncovered_Encounters bigint 0
    COVERED_MEDICATIONS Covered_Medications bigint 0
    UNCOVERED_MEDICATIONS Uncovered_Medications bigint 0
    COVERED_PROCEDURES Covered_Procedures bigint 0
    UNCOVERED_PROCEDURES Uncovered_Procedures bigint 0
    COVERED_IMMUNIZATIONS Covered_Immunizations bigint 0
    UNCOVERED_IMMUNIZATIONS Uncovered_Immunizations bigint 0
    UNIQUE_CUSTOMERS Unique_Customers bigint 0
    QOLS_AVG QOLS_Avg double 0.0
    MEMBER_MONTHS Member_Months bigint 0
"""))

# The provider dimension carries its organization's columns, joined in with prefix ORG_.
PROVIDER = (_natural_id("Provider"), *_typed("Provider", """
    NAME Name string Unknown
    GENDER Gender string Unknown
    SPECIALITY Speciality string Unknown
    ADDRESS Address string Unknown
    CITY City string Unknown
    STATE State string Unknown
    ZIP Zip string Unknown
    LAT Lat double 0.0
    LON Lon double 0.0
    ENCOUNTERS Utilization bigint 0
"""), *_typed("Organization", """
    ORG_NAME Name string Unknown
    ORG_ADDRESS Address string Unknown
    ORG_CITY City string Unknown
    ORG_STATE State string Unknown
    ORG_ZIP Zip string Unknown
    ORG_LAT Lat double 0.0
    ORG_LON Lon double 0.0
    ORG_PHONE Phone string Unknown
"""))

ENTITY_DIMENSIONS = {
    d.table: d
    for d in [
        EntityDimension("dim_organizations", "organizations", "Organization_Key",
                        "Organization_Id", ORGANIZATION),
        EntityDimension("dim_patients", "patients", "Patient_Key", "Patient_Id", PATIENT),
        EntityDimension("dim_payers", "payers", "Payer_Key", "Payer_Id", PAYER),
        EntityDimension("dim_providers", "providers", "Provider_Key", "Provider_Id", PROVIDER),
    ]
}

# Decimal layouts of the SQL-model twin, per target column.
DECIMAL_TWIN = {
    "Lat": "decimal(18,6)",
    "Lon": "decimal(18,6)",
    "Healthcare_Expenses": "decimal(18,2)",
    "Healthcare_Coverage": "decimal(18,2)",
    "Income": "bigint",
    "Revenue": "decimal(18,2)",
}

# Values the SQL-model twin puts in place of NULL where they differ.
TWIN_DEFAULTS = {
    "Birth_Date": "2100-01-01",
    "Death_Date": "2100-01-01",
    "FIPS_County_Code": "00000",
}
