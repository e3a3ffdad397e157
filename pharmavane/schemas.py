"""Declared schemas: landed JSON, raw all-string tables, and cleaned tables.

The raw layer is written and read with all-string columns, so one file can
never disagree with another about a type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the raw tables, in order.
PATIENT_COLUMNS = [
    "patientid", "patientagegroup", "patientonsetage", "patientonsetageunit",
    "patientsex", "patientweight", "serious", "seriousnessdeath",
    "seriousnesshospitalization", "seriousnessdisabling",
    "seriousnesslifethreatening", "seriousnessother", "receivedate",
    "receiptdate", "safetyreportid",
]

DRUG_COLUMNS = [
    "patientid", "medicinalproduct", "activesubstancename", "drugindication",
    "drugadministrationroute", "drugstartdate", "drugenddate", "drugdosagetext",
    "drugstructuredosagenumb", "drugstructuredosageunit",
    "drugtreatmentduration", "drugtreatmentdurationunit",
    "drugrecurreadministration",
]

REACTION_COLUMNS = ["patientid", "reactionmeddrapt", "reactionoutcome"]

RAW_COLUMNS = {
    "patient": PATIENT_COLUMNS,
    "drug": DRUG_COLUMNS,
    "reaction": REACTION_COLUMNS,
}

# Published on the report itself; some producers nest them under the patient.
REPORT_LEVEL_COLUMNS = [
    "serious", "seriousnessdeath", "seriousnesshospitalization",
    "seriousnessdisabling", "seriousnesslifethreatening", "seriousnessother",
    "receivedate", "receiptdate", "safetyreportid",
]

SERIOUSNESS_FLAGS = [
    "seriousnessdeath", "seriousnesshospitalization", "seriousnessdisabling",
    "seriousnesslifethreatening", "seriousnessother",
]

AGE = "patientage(yrs)"
DOSE = "drugstructuredosage(mg)"
DURATION = "drugtreatmentduration(days)"


def strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_SCHEMAS = {entity: strings(cols) for entity, cols in RAW_COLUMNS.items()}

_DRUG_ITEM = T.StructType(
    [
        T.StructField("medicinalproduct", T.StringType()),
        T.StructField("activesubstance", strings(["activesubstancename"])),
        *strings(DRUG_COLUMNS[3:]).fields,
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        *strings(REPORT_LEVEL_COLUMNS).fields,
        T.StructField(
            "patient",
            T.StructType(
                [
                    *strings(PATIENT_COLUMNS[1:]).fields,
                    T.StructField("drug", T.ArrayType(_DRUG_ITEM)),
                    T.StructField("reaction", T.ArrayType(strings(REACTION_COLUMNS[1:]))),
                ]
            ),
        ),
    ]
)

REPORT_FILE_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(REPORT_SCHEMA))])

INDEX_ENTRY_SCHEMA = strings(["display_name", "file", "size_mb"])

_INDEX_EVENT = T.StructType(
    [
        T.StructField("total_records", T.LongType()),
        T.StructField("partitions", T.ArrayType(INDEX_ENTRY_SCHEMA)),
    ]
)


def _nest(name: str, inner: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, inner)])


INDEX_SCHEMA = _nest("results", _nest("drug", _nest("event", _INDEX_EVENT)))
