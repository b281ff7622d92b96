"""Column layouts of the eighteen raw extracts.

Fixed values: file names, column names, column order and types must equal the
published extract layout, because headered files bind by position.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_FILES = {
    "allergies": "allergies.csv",
    "careplans": "careplans.csv",
    "claims": "claims.csv",
    "claims_transactions": "claims_transactions.csv",
    "conditions": "conditions.csv",
    "devices": "devices.csv",
    "encounters": "encounters.csv",
    "imaging_studies": "imaging_studies.csv",
    "immunizations": "immunizations.csv",
    "medications": "medications.csv",
    "observations": "observations.csv",
    "organizations": "organizations.csv",
    "patients": "patients.csv",
    "payer_transitions": "payer_transitions.csv",
    "payers": "payers.csv",
    "procedures": "procedures.csv",
    "providers": "providers.csv",
    "supplies": "supplies.csv",
}

RAW_LAYOUTS = {
    "allergies": """
        START date, STOP date, PATIENT string, ENCOUNTER string, CODE bigint, SYSTEM string,
        DESCRIPTION string, TYPE string, CATEGORY string, REACTION1 bigint, DESCRIPTION1 string,
        SEVERITY1 string, REACTION2 bigint, DESCRIPTION2 string, SEVERITY2 string""",
    "careplans": """
        ID string, START date, STOP date, PATIENT string, ENCOUNTER string, CODE bigint,
        DESCRIPTION string, REASONCODE bigint, REASONDESCRIPTION string""",
    "claims": """
        ID string, PATIENTID string, PROVIDERID string, PRIMARYPATIENTINSURANCEID string,
        SECONDARYPATIENTINSURANCEID string, DEPARTMENTID bigint, PATIENTDEPARTMENTID bigint,
        DIAGNOSIS1 bigint, DIAGNOSIS2 bigint, DIAGNOSIS3 bigint, DIAGNOSIS4 bigint,
        DIAGNOSIS5 bigint, DIAGNOSIS6 bigint, DIAGNOSIS7 bigint, DIAGNOSIS8 bigint,
        REFERRINGPROVIDERID string, APPOINTMENTID string, CURRENTILLNESSDATE timestamp,
        SERVICEDATE timestamp, SUPERVISINGPROVIDERID string, STATUS1 string, STATUS2 string,
        STATUSP string, OUTSTANDING1 double, OUTSTANDING2 double, OUTSTANDINGP double,
        LASTBILLEDDATE1 timestamp, LASTBILLEDDATE2 timestamp, LASTBILLEDDATEP timestamp,
        HEALTHCARECLAIMTYPEID1 bigint, HEALTHCARECLAIMTYPEID2 bigint""",
    "claims_transactions": """
        ID string, CLAIMID string, CHARGEID bigint, PATIENTID string, TYPE string, AMOUNT double,
        METHOD string, FROMDATE timestamp, TODATE timestamp, PLACEOFSERVICE string,
        PROCEDURECODE bigint, MODIFIER1 string, MODIFIER2 string, DIAGNOSISREF1 bigint,
        DIAGNOSISREF2 bigint, DIAGNOSISREF3 bigint, DIAGNOSISREF4 bigint, UNITS bigint,
        DEPARTMENTID bigint, NOTES string, UNITAMOUNT double, TRANSFEROUTID bigint,
        TRANSFERTYPE string, PAYMENTS double, ADJUSTMENTS double, TRANSFERS double,
        OUTSTANDING double, APPOINTMENTID string, LINENOTE string, PATIENTINSURANCEID string,
        FEESCHEDULEID bigint, PROVIDERID string, SUPERVISINGPROVIDERID string""",
    "conditions": """
        START date, STOP date, PATIENT string, ENCOUNTER string, SYSTEM string, CODE bigint,
        DESCRIPTION string""",
    "devices": """
        START timestamp, STOP timestamp, PATIENT string, ENCOUNTER string, CODE bigint,
        DESCRIPTION string, UDI string""",
    "encounters": """
        ID string, START timestamp, STOP timestamp, PATIENT string, ORGANIZATION string,
        PROVIDER string, PAYER string, ENCOUNTERCLASS string, CODE bigint, DESCRIPTION string,
        BASE_ENCOUNTER_COST double, TOTAL_CLAIM_COST double, PAYER_COVERAGE double,
        REASONCODE bigint, REASONDESCRIPTION string""",
    "imaging_studies": """
        ID string, DATE timestamp, PATIENT string, ENCOUNTER string, SERIES_UID string,
        BODYSITE_CODE bigint, BODYSITE_DESCRIPTION string, MODALITY_CODE string,
        MODALITY_DESCRIPTION string, INSTANCE_UID string, SOP_CODE string,
        SOP_DESCRIPTION string, PROCEDURE_CODE bigint""",
    "immunizations": """
        DATE timestamp, PATIENT string, ENCOUNTER string, CODE bigint, DESCRIPTION string,
        BASE_COST double""",
    "medications": """
        START timestamp, STOP timestamp, PATIENT string, PAYER string, ENCOUNTER string,
        CODE bigint, DESCRIPTION string, BASE_COST double, PAYER_COVERAGE double,
        DISPENSES bigint, TOTALCOST double, REASONCODE bigint, REASONDESCRIPTION string""",
    "observations": """
        DATE timestamp, PATIENT string, ENCOUNTER string, CATEGORY string, CODE string,
        DESCRIPTION string, VALUE string, UNITS string, TYPE string""",
    "organizations": """
        ID string, NAME string, ADDRESS string, CITY string, STATE string, ZIP bigint,
        LAT double, LON double, PHONE string, REVENUE double, UTILIZATION bigint""",
    "patients": """
        ID string, BIRTHDATE date, DEATHDATE date, SSN string, DRIVERS string, PASSPORT string,
        PREFIX string, FIRST string, MIDDLE string, LAST string, SUFFIX string, MAIDEN string,
        MARITAL string, RACE string, ETHNICITY string, GENDER string, BIRTHPLACE string,
        ADDRESS string, CITY string, STATE string, COUNTY string, FIPS bigint, ZIP bigint,
        LAT double, LON double, HEALTHCARE_EXPENSES double, HEALTHCARE_COVERAGE double,
        INCOME bigint""",
    "payer_transitions": """
        PATIENT string, MEMBERID string, START_DATE timestamp, END_DATE timestamp, PAYER string,
        SECONDARY_PAYER string, PLAN_OWNERSHIP string, OWNER_NAME string""",
    "payers": """
        ID string, NAME string, OWNERSHIP string, ADDRESS string, CITY string,
        STATE_HEADQUARTERED string, ZIP string, PHONE string, AMOUNT_COVERED double,
        AMOUNT_UNCOVERED double, REVENUE double, COVERED_ENCOUNTERS bigint,
        UNCOVERED_ENCOUNTERS bigint, COVERED_MEDICATIONS bigint, UNCOVERED_MEDICATIONS bigint,
        COVERED_PROCEDURES bigint, UNCOVERED_PROCEDURES bigint, COVERED_IMMUNIZATIONS bigint,
        UNCOVERED_IMMUNIZATIONS bigint, UNIQUE_CUSTOMERS bigint, QOLS_AVG double,
        MEMBER_MONTHS bigint""",
    "procedures": """
        START timestamp, STOP timestamp, PATIENT string, ENCOUNTER string, SYSTEM string,
        CODE bigint, DESCRIPTION string, BASE_COST double, REASONCODE bigint,
        REASONDESCRIPTION string""",
    "providers": """
        ID string, ORGANIZATION string, NAME string, GENDER string, SPECIALITY string,
        ADDRESS string, CITY string, STATE string, ZIP bigint, LAT double, LON double,
        ENCOUNTERS bigint, PROCEDURES bigint""",
    "supplies": """
        DATE date, PATIENT string, ENCOUNTER string, CODE bigint, DESCRIPTION string,
        QUANTITY bigint""",
}

POSTAL_COLUMNS = {"ZIP", "FIPS"}


def raw_schema(entity: str, postal_as_text: bool = True) -> T.StructType:
    """Schema of one raw extract.

    Postal and county codes are digits with meaningful leading zeros, so they are read
    as text unless ``postal_as_text=False`` asks for the numeric layout.
    """
    schema = T.StructType.fromDDL(RAW_LAYOUTS[entity])
    if not postal_as_text:
        return schema
    return T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in POSTAL_COLUMNS else f
            for f in schema.fields
        ]
    )
