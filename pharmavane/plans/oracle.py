"""For each query, equal SQL for DuckDB over the same tables."""

from __future__ import annotations

from pharmavane.functions import codes
from pharmavane.operators.questions import EVENT_TYPES
from pharmavane.plans import fixtures as fx
from pharmavane.plans.registry import CAP, SMALL_CAP, YEAR_CAP
from pharmavane.schemas import AGE, DOSE, DRUG_COLUMNS, DURATION, PATIENT_COLUMNS, SERIOUSNESS_FLAGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return _quoted(value) if isinstance(value, str) else str(value)


def _case(column: str, labels: dict) -> str:
    arms = " ".join(f"when {_literal(k)} then {_literal(v)}" for k, v in labels.items())
    return f"case {column} {arms} else null end"


def _int(column: str) -> str:
    whole = rf"regexp_extract({column}, '^\s*([+-]?\d+)(\.\d*)?\s*$', 1)"
    return f"try_cast(nullif({whole}, '') as int)"


def _float(column: str) -> str:
    return f"try_cast({column} as float)"


def _scaled(number: str, unit: str, factors: dict) -> str:
    arms = []
    for code, factor in factors.items():
        mult, div = factor if isinstance(factor, tuple) else (factor, 1)
        value = f"cast({number} as double)"
        if mult != 1:
            value += f" * cast({mult!r} as double)"
        if div != 1:
            value = f"({value}) / cast({div!r} as double)"
        arms.append(f"when {_literal(code)} then {value}")
    return f"case {unit} {' '.join(arms)} else null end"


def _complete(c: str) -> str:
    return f"case length({c}) when 4 then {c} || '0101' when 6 then {c} || '01' else {c} end"


def _floored(c: str) -> str:
    return f"case when ({_complete(c)}) >= '19000101' then {_complete(c)} end"


def _date(c: str) -> str:
    return (
        f"case when length({_floored(c)}) = 8 "
        f"then cast(try_strptime({_floored(c)}, '%Y%m%d') as date) end"
    )


def _year(c: str) -> str:
    return f"case when regexp_matches(substr({c}, 1, 4), '^[0-9]{{4}}$') then cast(substr({c}, 1, 4) as int) end"


_WEIGHT = (
    f"case when ({_float('patientweight')} >= 0.001 and {_float('patientweight')} < 1e7) "
    f"or {_float('patientweight')} = 0 then {_float('patientweight')} end"
)
_AGE_YEARS = (
    f"cast({_scaled(_int('patientonsetage'), _int('patientonsetageunit'), codes.AGE_TO_YEARS)} as float)"
)
_FLAGS = {n: f"coalesce({_int(n)} = 1, false)" for n in SERIOUSNESS_FLAGS}
_BAND = f"""case when "{AGE}" >= 81 then '81+' when "{AGE}" >= 71 then '71-80' when "{AGE}" >= 65 then '65-70' end"""
_REPORT = "coalesce('report:' || cast(safetyreportid as varchar), 'row:' || patientid)"


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} as "{name}"' for name, expr in columns.items())


_PATIENT = _cols(
    {
        "patientid": "patientid",
        "patientagegroup": _case("patientagegroup", codes.AGE_GROUPS),
        "patientsex": _case(_int("patientsex"), codes.SEXES),
        "patientweight": _WEIGHT,
        "serious": _case(_int("serious"), codes.SERIOUS),
        **_FLAGS,
        "receivedate": "receivedate",
        "receiptdate": "receiptdate",
        "safetyreportid": _int("safetyreportid"),
        AGE: _AGE_YEARS,
    }
)
_DRUG = _cols(
    {
        **{n: n for n in DRUG_COLUMNS[:4]},
        "drugadministrationroute": _case("drugadministrationroute", codes.ROUTES),
        "drugstartdate": _date("drugstartdate"),
        "drugenddate": _date("drugenddate"),
        "drugdosagetext": "drugdosagetext",
        DOSE: _scaled(_float("drugstructuredosagenumb"), "drugstructuredosageunit", codes.DOSE_TO_MG),
        DURATION: _scaled(
            _int("drugtreatmentduration"), "drugtreatmentdurationunit", codes.DURATION_TO_DAYS
        ),
        "drug_reaction_after_readministration": _case(
            _int("drugrecurreadministration"), codes.RECURRENCE
        ),
    }
)
_REACTION = _cols(
    {
        "patientid": "patientid",
        "reactionmeddrapt": "reactionmeddrapt",
        "reactionoutcome": _case("reactionoutcome", codes.OUTCOMES),
    }
)

_SIZE = "coalesce(cast(size_mb as double), 0)"
_KNOWN = "cast(size_mb as decimal(20,6))"
_KEY = "coalesce({}, chr(30))"


def _hash(columns: list[str]) -> str:
    return "sha256(" + " || chr(31) || ".join(_KEY.format(c) for c in columns) + ")"


_DRUG_KEY = _hash(["medicinalproduct", "activesubstancename", "drugadministrationroute"])
_REACTION_KEY = _hash(["reactionmeddrapt"])

# Named tables, each built on the ones before it.
_TABLES = {
    "raw_patient": fx.sql(fx.PATIENT, "orders"),
    "raw_drug": fx.sql(fx.DRUG, "lineitem"),
    "raw_reaction": fx.sql(fx.REACTION, "lineitem"),
    "files": fx.sql(fx.FILES, "part"),
    "placed": "select *, split_part(trim(coalesce(display_name, '')), ' ', 1) as partition_id from files",
    "years": (
        "select partition_id, count(*) as \"count\", "
        f"coalesce(round(cast(sum({_KNOWN}) as double), 2), 0) as size_mb, "
        "count(*) filter (where size_mb is null) as unsized, min(seq) as seq "
        "from placed group by partition_id"
    ),
    "patient": f"select {_PATIENT} from raw_patient",
    "drug": f"select {_DRUG} from raw_drug",
    "reaction": f"select {_REACTION} from raw_reaction",
    "person": f"select *, {_REPORT} as report, {_BAND} as age_band, {_year('receivedate')} as y from patient",
}


_FILED = (
    "select *, '200' || (cast(patientid as bigint) % 4) as year, 'file-' || (cast(patientid as bigint) % 6) as file_id "
    "from raw_reaction"
)


def _sql(body: str, *extra: tuple[str, str], recursive: bool = False) -> str:
    named = {**_TABLES, **dict(extra)}
    ctes = ",\n".join(f"{name} as ({text})" for name, text in named.items())
    return f"with {'recursive ' if recursive else ''}{ctes}\n{body}"


def _packed(source: str, cap: float, group: str, size: str = _SIZE) -> list[tuple[str, str]]:
    """Next-fit by walking each group's rows in order."""
    return [
        (
            "ordered",
            f"select *, {size} as z, {group} as g, "
            f"row_number() over (partition by {group} order by seq) as rn "
            f"from {source} where {size} <= {cap}",
        ),
        (
            "packed",
            "select g, rn, seq, z as run, 1 as batch_id from ordered where rn = 1 "
            "union all select o.g, o.rn, o.seq, "
            f"case when p.run + o.z > {cap} then o.z else p.run + o.z end, "
            f"case when p.run + o.z > {cap} then p.batch_id + 1 else p.batch_id end "
            "from packed p join ordered o on o.g = p.g and o.rn = p.rn + 1",
        ),
    ]


def _pack_sql(body: str, source: str, cap: float, group: str = "''", size: str = _SIZE, *extra) -> str:
    return _sql(body, *extra, *_packed(source, cap, group, size), recursive=True)


_FLAG_LABELS = ", ".join(f"bool_or({flag}) as {label}" for flag, label in EVENT_TYPES.items())
_TYPE_COUNTS = ", ".join(f"count(*) filter (where {label}) as {label}" for label in EVENT_TYPES.values())
_WIDE = [
    (
        "listed",
        f"select medicinalproduct, report, {_FLAG_LABELS} from drug join person using (patientid) "
        f'where "{AGE}" >= 65 group by 1, 2',
    ),
    ("wide", f"select medicinalproduct, {_TYPE_COUNTS} from listed group by 1"),
    (
        "long",
        " union all ".join(
            f"select medicinalproduct, '{t}' as event_type, {t} as n_reports from wide where {t} > 0"
            for t in EVENT_TYPES.values()
        ),
    ),
]


_BESIDE = [
    ("named", "select distinct report, medicinalproduct as item from drug join person using (patientid)"),
    (
        "beside",
        "select x.report, y.item as other from named x join named y on y.report = x.report and y.item <> x.item "
        "where x.item = 'PRODUCT 7'",
    ),
]


def _trend(source: str) -> str:
    return _sql(
        "select y as year, n_reports, n_serious, "
        "n_reports - p.n as change_reports, n_serious - p.s as change_serious "
        "from per_year left join (select y + 1 as y, n_reports as n, n_serious as s from per_year) p using (y)",
        (
            "per_year",
            "select y, count(*) as n_reports, count(*) filter (where s) as n_serious from "
            f"(select y, report, bool_or(serious) as s from {source} group by 1, 2) group by 1",
        ),
    )


def _top(name: str, k: int) -> str:
    return _sql(
        f"select {name}, count(distinct report) as n_reports from drug join person using (patientid) "
        f'where serious and "{AGE}" >= 65 and {name} is not null group by 1 order by 2 desc, 1 limit {k}'
    )


def _signal_sql(first: str, second: str, people: str, within: bool) -> str:
    link = "x.report = z.report and x.item < z.item" if within else "x.report = z.report"
    a, n1, n2, t = (f"cast({c} as double)" for c in ("n_reports", "n_first", "n_second", "n_total"))
    names = ("drug_a", "drug_b") if within else ("drug", "reaction")
    other = "select * from xs" if within else (
        f"select distinct report, reactionmeddrapt as item from reaction join {people} using (patientid)"
    )
    return _sql(
        f"select {first} as {names[0]}, {second} as {names[1]}, n_reports, n_first, n_second, n_total, "
        f"{n1} * {n2} / {t} as expected, {a} / nullif({n1} * {n2} / {t}, 0) as observed_expected, "
        f"({a} / {n1}) / nullif(({n2} - {a}) / nullif({t} - {n1}, 0), 0) as prr, "
        f"({a} * ({t} - {n1} - {n2} + {a})) / nullif(({n1} - {a}) * ({n2} - {a}), 0) as ror from counted",
        (
            "xs",
            f"select distinct report, medicinalproduct as item from drug join {people} using (patientid)",
        ),
        ("zs", other),
        (
            "pairs",
            f"select x.item as a, z.item as b, count(*) as n_reports from xs x join zs z on {link} "
            "group by 1, 2 having count(*) >= 3",
        ),
        (
            "counted",
            "select pairs.*, (select count(*) from xs where item = a) as n_first, "
            "(select count(*) from zs where item = b) as n_second, "
            f"(select count(distinct report) from {people}) as n_total from pairs",
        ),
    )


def _report_rows(body: str) -> str:
    return f"sha256({fx.REPORT_FILE} || '|' || cast({fx.REPORT_POS} as varchar)) as patientid, {body}"


def _report_drugs() -> str:
    parts = []
    for entry in fx.REPORT_DRUGS:
        fields = ", ".join(
            f"{entry.get(n, 'cast(null as varchar)')} as {n}" for n in DRUG_COLUMNS[1:]
        )
        parts.append(f"select {_report_rows(fields)} from orders where {entry['when']}")
    return " union all ".join(parts)


def _bad(checks: dict[str, str]) -> str:
    arms = ", ".join(
        f"case when {n} is not null and ({parsed}) is null then '{n}' end" for n, parsed in checks.items()
    )
    return f"concat_ws(',', {arms})"


_BAD_DRUG = _bad(
    {
        "drugstructuredosagenumb": _float("drugstructuredosagenumb"),
        "drugtreatmentduration": _int("drugtreatmentduration"),
        "drugrecurreadministration": _int("drugrecurreadministration"),
        "drugstartdate": _date("drugstartdate"),
        "drugenddate": _date("drugenddate"),
    }
)
_BAD_PATIENT = _bad(
    {
        **{n: _int(n) for n in ("patientonsetage", "patientonsetageunit", "patientsex")},
        "patientweight": _float("patientweight"),
        "serious": _int("serious"),
        **{n: _int(n) for n in ("seriousnessdeath", "seriousnesshospitalization", "seriousnessdisabling")},
        **{n: _int(n) for n in ("seriousnesslifethreatening", "seriousnessother")},
        "receivedate": _date("receivedate"),
        "receiptdate": _date("receiptdate"),
        "safetyreportid": _int("safetyreportid"),
    }
)
_PATIENT_KEYS = ", ".join(
    ["patientid", "report as report_id", f"{_date('receivedate')} as date_key", "age_band", "serious", *SERIOUSNESS_FLAGS]
)
_INTS = {"patientonsetage", "patientonsetageunit", "patientsex", "serious", "safetyreportid", *SERIOUSNESS_FLAGS}


def _cast_patient() -> str:
    columns = {
        n: _int(n) if n in _INTS else _float(n) if n == "patientweight" else n for n in PATIENT_COLUMNS
    }
    return _sql(f"select {_cols(columns)} from raw_patient")


def _cast_drug() -> str:
    columns = {n: n for n in DRUG_COLUMNS}
    columns["drugstructuredosagenumb"] = _float("drugstructuredosagenumb")
    columns["drugrecurreadministration"] = _int("drugrecurreadministration")
    del columns["drugtreatmentduration"]
    columns["drugtreatmentdurationnumb"] = _int("drugtreatmentduration")
    return _sql(f"select {_cols(columns)} from raw_drug")


def _dose_sql(factors: dict) -> str:
    number = _float("drugstructuredosagenumb")
    return _sql(
        "select patientid, drugstructuredosageunit as unit, "
        f'{_scaled(number, "drugstructuredosageunit", factors)} as "{DOSE}" from raw_drug'
    )


def _dates() -> str:
    out = ["patientid", "drugstartdate", "drugenddate"]
    for n in ("drugstartdate", "drugenddate"):
        out += [
            f"{_complete(n)} as {n}_complete", f"{_floored(n)} as {n}_floored", f"{_date(n)} as {n}_parsed"
        ]
    return _sql(f"select {', '.join(out)} from raw_drug")


def oracle_sql() -> dict[str, str]:
    return {
        "clean_patient": _sql("select * from patient"),
        "clean_drug": _sql("select * from drug"),
        "clean_reaction": _sql("select * from reaction"),
        "cast_patient": _cast_patient(),
        "cast_drug": _cast_drug(),
        "cast_reaction": _sql("select * from raw_reaction"),
        "clean_by_path": _sql("select * from reaction"),
        "decode_age_group": _sql(
            f"select patientid, {_case('patientagegroup', codes.AGE_GROUPS)} as age_group from raw_patient"
        ),
        "age_years": _sql(
            f"select patientid, {_int('patientonsetageunit')} as patientonsetageunit, "
            f'{_AGE_YEARS} as "{AGE}" from raw_patient'
        ),
        "decode_sex": _sql(f"select patientid, {_case(_int('patientsex'), codes.SEXES)} as sex from raw_patient"),
        "weight_valid": _sql(f"select patientid, {_WEIGHT} as patientweight from raw_patient"),
        "seriousness_flags": _sql(
            f"select patientid, {_case(_int('serious'), codes.SERIOUS)} as serious, {_cols(_FLAGS)} from raw_patient"
        ),
        "partial_dates": _dates(),
        "decode_route": _sql(
            "select patientid, drugadministrationroute as route_code, "
            f"{_case('drugadministrationroute', codes.ROUTES)} as route from raw_drug"
        ),
        "decode_route_join": _sql(
            "select patientid, drugadministrationroute as route_code, "
            f"{_case('drugadministrationroute', codes.ROUTES)} as route from raw_drug"
        ),
        "dose_mg": _dose_sql(codes.DOSE_TO_MG),
        "dose_mg_standard_units": _dose_sql(codes.DOSE_TO_MG_STANDARD),
        "duration_days": _sql(
            "select patientid, drugtreatmentdurationunit as unit, "
            f"{_scaled(_int('drugtreatmentduration'), 'drugtreatmentdurationunit', codes.DURATION_TO_DAYS)} "
            f'as "{DURATION}" from raw_drug'
        ),
        "decode_recurrence": _sql(
            f"select patientid, {_int('drugrecurreadministration')} as drugrecurreadministration, "
            f"{_case(_int('drugrecurreadministration'), codes.RECURRENCE)} as recurrence from raw_drug"
        ),
        "decode_outcome": _sql(
            f"select patientid, reactionoutcome as code, {_case('reactionoutcome', codes.OUTCOMES)} as outcome "
            "from raw_reaction"
        ),
        "start_years": _sql(
            f"select distinct {_year('drugstartdate')} as year from raw_drug where drugstartdate is not null order by 1"
        ),
        "start_year_counts": _sql(
            f"select {_year('drugstartdate')} as year, count(*) as \"count\" from raw_drug "
            "where drugstartdate is not null group by 1"
        ),
        "bad_year_rows": _sql("select * from raw_drug where drugstartdate = '10041227'"),
        "age_group_counts": _sql('select patientagegroup, count(*) as "count" from patient group by 1'),
        "distinct_dates": _sql("select distinct receivedate from raw_patient"),
        "patient_count": _sql("select count(*) as n_patients from patient"),
        "first_rows": _sql("select * from patient order by patientid limit 20"),
        "older_serious": _sql(f'select * from patient where serious and "{AGE}" >= 65'),
        "index_files": _sql(
            "select p_partkey as dataset, p_partkey * 12 as total_records, cast(0 as bigint) as seq, "
            f"{fx.FILES['display_name']} as display_name, {fx.FILES['file']} as file, "
            f"{fx.FILES['size_mb']} as size_mb from part union all "
            "select p_partkey, p_partkey * 12, cast(1 as bigint), "
            f"{fx.FILES['display_name']}, concat('second-', p_name), cast(p_size as varchar) "
            "from part where p_partkey % 2 = 0"
        ),
        "manifest_by_year": _sql("select * from years"),
        "manifest_file_lists": _sql(
            "select partition_id, (o - 1) // 40 as list_no, cast(count(*) as int) as n_files, "
            "string_agg(file, ',' order by o) as files from numbered group by 1, 2",
            ("numbered", "select *, row_number() over (partition by partition_id order by seq) as o from placed"),
        ),
        "manifest_total": _sql(
            f"select round(cast(sum({_KNOWN}) as double), 2) as total_size_mb from files"
        ),
        "manifest_select": _sql("select * from years where partition_id in ('2004', '2010', '2012')"),
        "files_per_year": _sql('select partition_id, "count" as n_files from years order by 1, 2'),
        "prefix_count": _sql("select count(*) as n_files from files where substr(display_name, 1, 4) = '2023'"),
        "name_parts": _sql(
            "select seq, partition_id, split_part(display_name, ' ', 1) || split_part(display_name, ' ', 2) "
            "as year_quarter, cast(regexp_extract(display_name, '([0-9]+)\\)$', 1) as int) as part_total, "
            "coalesce(cast(size_mb as double), -1) as part_size_mb from placed"
        ),
        "part_names": _sql(
            "select seq, partition_id, 'drug-event-part-' || row_number() over (partition by partition_id order by seq) "
            "|| '-of-' || total as part_name from "
            "(select *, count(*) over (partition by partition_id) as total from placed) where seq % 7 <> 0"
        ),
        "path_parts": _sql(
            "select 'data/pq/drug/' || partition_id || '/' || file as path, partition_id as year, "
            "split_part(file, '.', 1) as stem from placed"
        ),
        "batch_nextfit": _pack_sql(
            "select p.seq, file, batch_id from packed p join files using (seq)", "files", CAP
        ),
        "batch_by_year": _pack_sql(
            "select g as partition_id, seq, batch_id from packed", "placed", YEAR_CAP, "partition_id"
        ),
        "batch_oversized": _sql(f"select * from files where {_SIZE} > {SMALL_CAP}"),
        "batch_summary": _pack_sql(
            "select batch_id, count(*) as n_items, "
            f"round(cast(sum({_KNOWN}) as double), 2) as total_size_mb "
            "from packed join files using (seq) group by 1",
            "files",
            SMALL_CAP,
        ),
        "run_plan": _pack_sql(
            'select partition_id, "count", size_mb, batch_id from packed join years using (seq)',
            "chosen",
            6_000,
            "''",
            "size_mb",
            ("chosen", "select * from years where partition_id in ('2005', '2006', '2007', '2011', '2015', '2016')"),
        ),
        "oversized_year_batches": _pack_sql(
            "select g as partition_id, file, batch_id from packed join files using (seq)",
            "large",
            2_500,
            "partition_id",
            _SIZE,
            ("large", "select * from placed where partition_id in (select partition_id from years where size_mb > 2500)"),
        ),
        "report_patient": f"select {_report_rows(', '.join(f'{fx.PATIENT[n]} as {n}' for n in PATIENT_COLUMNS[1:]))} from orders",
        "report_drug": _report_drugs(),
        "report_reaction": f"select {_report_rows(', '.join(fx.select_list(fx.REPORT_REACTION)))} from orders",
        "zip_scan": (
            "select sha256(concat(path, '|', cast(row_number() over (partition by path order by o_orderkey) - 1 as varchar))) "
            f"as patientid, {', '.join(f'{fx.PATIENT[n]} as {n}' for n in PATIENT_COLUMNS[1:])} "
            f"from (select *, {fx.ZIP_FILE} as path from (select *, o_orderkey as pos from orders))"
        ),
        "large_scan": (
            "select sha256(concat(path, '|', cast(row_number() over (partition by path order by o_orderkey) - 1 as varchar))) "
            f"as patientid, {', '.join(f'{fx.PATIENT[n]} as {n}' for n in PATIENT_COLUMNS[1:])} "
            f"from (select *, {fx.LARGE_FILE} as path from (select *, o_orderkey as pos from orders))"
        ),
        "misshapen_reports": (
            f"select * from (select source_file, pos, {fx.ODD_REPORT} as report_json from "
            f"(select {fx.REPORT_FILE} as source_file, {fx.REPORT_POS} as pos from orders)) where report_json is not null"
        ),
        "scan_faults": "select 'report-' || o_orderkey as source_file, "
        "case when o_orderkey % 10 = 0 then 'fault' else 'good' end as state from orders",
        "unparsed_reports": f"select {fx.REPORT_FILE} as source_file, {fx.REPORT_POS} as pos from orders "
        "where o_orderkey % 10 = 0",
        "roundtrip_write": _sql(
            "select *, substr(receivedate, 1, 4) as year from patient where substr(receivedate, 1, 4) in ('1996', '1998')"
        ),
        "landed_index": _sql(
            "select (select count(*) from files) as total_records, row_number() over (order by seq) - 1 as seq, "
            "display_name, file, size_mb from files"
        ),
        "ingested_files": _sql(f"select * from ({_FILED})"),
        "replaced_files": _sql(
            f"select *, true as dropped from ({_FILED}) where file_id not in ('file-0', 'file-1') "
            "or file_id = 'file-1' and reactionoutcome <> '1'"
        ),
        "published_rows": _sql(
            "select substr(receivedate, 1, 4) as year, count(*) as n_rows, "
            "(select count(*) from raw_patient) as n_written from raw_patient group by 1"
        ),
        "tree_scan": _sql("select * from raw_reaction"),
        "listed_files": _sql(f"select distinct year, cast(2 as bigint) as n_files from ({_FILED})"),
        "labels_in_memory": _sql(
            f"select patientid, reactionmeddrapt, {_case('reactionoutcome', codes.OUTCOMES)} as outcome from raw_reaction"
        ),
        "native_reports": _sql("select * exclude (patientid) from raw_patient"),
        "year_filter": _sql(
            "select patientid, substr(receivedate, 1, 4) as year from raw_patient "
            "where substr(receivedate, 1, 4) in ('1997', '1999')"
        ),
        "years_present": _sql("select distinct substr(receivedate, 1, 4) as year from raw_patient"),
        "copy_files": _sql("select * from raw_reaction"),
        "union_drifted": _sql(
            "select patientid, patientonsetage, "
            "case when cast(patientid as bigint) % 2 = 0 then patientsex end as patientsex from raw_patient"
        ),
        "union_merged": _sql(
            "select patientid, reactionmeddrapt, case when reactionoutcome = '5' then reactionoutcome end "
            "as reactionoutcome from raw_reaction"
        ),
        "typed_dates": _sql(
            f"select patientid, {_date('receivedate')} as receivedate, {_date('receiptdate')} as receiptdate from raw_patient"
        ),
        "lineage": _sql(
            "select patientid, 'batch-1' as batch_id, 'orders' as source_stem, true as is_stamped from raw_patient"
        ),
        "quarantine": _sql(
            f"select * from (select *, {_BAD_DRUG} as bad_columns from raw_drug) where bad_columns <> ''"
        ),
        "quarantine_patient": _sql(
            f"select * from (select *, {_BAD_PATIENT} as bad_columns from noted) where bad_columns <> ''",
            ("noted", f"select * replace ({fx.NOTED_FLAG} as seriousnessdeath) from raw_patient"),
        ),
        "quarantine_good": _sql(f"select * from raw_patient where {_BAD_PATIENT} = ''"),
        "report_drugs": _sql(
            f'select patientid, serious, "{AGE}", medicinalproduct, "{DOSE}" from patient join drug using (patientid)'
        ),
        "report_reactions": _sql(
            "select patientid, patientsex, serious, reactionmeddrapt, reactionoutcome "
            "from patient join reaction using (patientid)"
        ),
        "orphans": _sql(
            "select * from reaction where patientid not in (select patientid from patient where patientagegroup = 'Adult')"
        ),
        "patients_without_drug": _sql(
            "select patientid, patientsex from patient where patientid not in (select patientid from drug)"
        ),
        "patients_with_drug": _sql(
            "select patientid, patientsex from patient where patientid in (select patientid from drug)"
        ),
        "orphans_by_filter": _sql(
            "select * from reaction where patientid not in (select patientid from patient where patientid not like '%7')"
        ),
        "patients_with_drug_by_filter": _sql(
            "select patientid, patientsex from patient where patientid in "
            "(select patientid from drug where year(drugstartdate) <= 1995)"
        ),
        "dim_patient": _sql("select * exclude (report, y) from person"),
        "dim_drug": _sql(
            f"select distinct {_DRUG_KEY} as drug_key, medicinalproduct, activesubstancename, drugadministrationroute from drug"
        ),
        "dim_reaction": _sql(f"select distinct {_REACTION_KEY} as reaction_key, reactionmeddrapt from reaction"),
        "dim_date": _sql(
            "select d as date_key, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, "
            "cast(month(d) as int) as month, cast(day(d) as int) as day from "
            "(select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d from "
            "(select cast(min(drugstartdate) as timestamp) as lo, cast(max(drugstartdate) as timestamp) as hi from drug))"
        ),
        "fact_drug": _sql(
            f"select m.* exclude (patientid), p.* from mentions m join (select {_PATIENT_KEYS} from person) p using (patientid)",
            (
                "mentions",
                f"select patientid, {_DRUG_KEY} as drug_key, count(*) as n_mentions, min(drugstartdate) as first_start, "
                f'max(drugenddate) as last_end, max("{DOSE}") as max_dose_mg from drug group by 1, 2',
            ),
        ),
        "fact_reaction": _sql(
            f"select m.* exclude (patientid), p.* from mentions m join (select {_PATIENT_KEYS} from person) p using (patientid)",
            (
                "mentions",
                f"select patientid, {_REACTION_KEY} as reaction_key, count(*) as n_mentions, "
                "count(*) filter (where reactionoutcome = 'Fatal') as n_fatal from reaction group by 1, 2",
            ),
        ),
        "modelled_years": _sql(
            f"select m.* exclude (patientid), p.* from mentions m join "
            f"(select {_PATIENT_KEYS}, substr(receivedate, 1, 4) as year from person) p using (patientid)",
            (
                "mentions",
                f"select patientid, {_REACTION_KEY} as reaction_key, count(*) as n_mentions, "
                "count(*) filter (where reactionoutcome = 'Fatal') as n_fatal from reaction group by 1, 2",
            ),
        ),
        "report_pairs": _sql("select report, other from beside", *_BESIDE),
        "report_pairs_of_long_lists": _sql("select other, count(*) as n_reports from beside group by 1", *_BESIDE),
        "top_serious_meds": _top("medicinalproduct", 10),
        "top_serious_substances": _top("activesubstancename", 5),
        "event_types_by_drug": _sql("select * from long", *_WIDE),
        "event_types_wide": _sql("select * from wide", *_WIDE),
        "event_type_rank": _sql(
            "select medicinalproduct, event_type, n_reports, cast(n_reports as double) / "
            "sum(n_reports) over (partition by medicinalproduct) as share, "
            "cast(rank() over (partition by medicinalproduct order by n_reports desc) as int) as event_rank from long",
            *_WIDE,
        ),
        "yearly_trend": _trend("person"),
        "yearly_trend_gaps": _trend(
            "(select * replace (case when y % 3 = 0 then y + 30 else y end as y) from person)"
        ),
        "yearly_trend_of_drug": _trend(
            "(select * from person where patientid in (select patientid from drug where medicinalproduct = 'PRODUCT 7'))"
        ),
        "rolling_serious_share": _sql(
            "select *, cast(rolling_serious as double) / rolling_reports as serious_share from "
            "(select *, cast(sum(n_reports) over w as bigint) as rolling_reports, "
            "cast(sum(n_serious) over w as bigint) as rolling_serious from per_year "
            "window w as (partition by medicinalproduct order by year range between 2 preceding and current row))",
            (
                "per_year",
                "select medicinalproduct, y as year, count(*) as n_reports, count(*) filter (where s) as n_serious from "
                "(select medicinalproduct, y, report, bool_or(serious) as s from drug join person using (patientid) "
                "group by 1, 2, 3) group by 1, 2",
            ),
        ),
        "age_band_risk": _sql(
            f"select *, cast(n_serious as double) / n_reports as serious_share, cast(death as double) / n_reports as death_share "
            f"from (select age_band, count(*) as n_reports, count(*) filter (where serious) as n_serious, {_TYPE_COUNTS} from "
            f"(select age_band, report, bool_or(serious) as serious, {_FLAG_LABELS} from person where age_band is not null "
            "group by 1, 2) group by 1)"
        ),
        "drug_pairs": _sql(
            "select x.item as drug_a, z.item as drug_b, count(*) as n_reports from xs x join xs z "
            "on x.report = z.report and x.item < z.item group by 1, 2 having count(*) >= 3",
            ("xs", "select distinct report, medicinalproduct as item from drug join person using (patientid)"),
        ),
        "drug_pair_signal": _signal_sql("a", "b", "person", True),
        "older_pair_signal": _signal_sql("a", "b", f'(select * from person where "{AGE}" >= 65)', True),
        "drug_reaction_signal": _signal_sql("a", "b", "person", False),
    }
