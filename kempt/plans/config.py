"""Run a configuration written in the loan-ETL JSON format with kempt operators.

That format has one switch per step in three sections (cleansing, massaging,
transforming) and takes each step's parameters from top-level keys.  Here:

* :func:`steps_from_config` turns the switches that change the frame into a
  step list for :func:`kempt.plans.pipeline.run_pipeline`, in the order each
  stage runs them;
* :func:`reports_from_config` turns the switches that only compute and show
  something (validation, describe, filters for display, pivots, ...) into named
  report DataFrames, computed lazily from the frame they are given.

A switch that is on but becomes neither a step nor a report (unknown name, missing
parameters, or inputs a configuration cannot hold, such as a second table) raises
``ConfigError``, unless the caller lists it in ``allow``; :func:`unsupported_switches`
lists them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.functions.columns import SPECIAL_CHARS, col, q
from kempt.operators import cleanse, derive, quality, relate, stats

# Section names and the switches of each section, in the order the
# stages run them (the massaging stage runs transform_data before subset_extraction,
# the transforming stage its own order, not the numbering).
CLEANSING = "cleansing_config"
MASSAGING = "massaging"
TRANSFORMING = "transforming"
CLEANSING_ORDER = [
    "remove_duplicates", "handle_missing_values", "standardize_data", "correct_typos_and_inaccuracies",
    "handle_outliers", "handle_inconsistent_data", "handle_incomplete_records", "convert_data_types",
    "normalize_data", "standardize_categorical_data", "validate_data",
    "address_inconsistencies_in_date_time_formats", "remove_irrelevant_information", "handle_encoding_issues",
    "deal_with_inconsistent_units", "resolve_data_integration_issues", "validate_references_and_foreign_keys",
    "geocode_and_address_validation", "handle_special_characters_and_symbols",
    "conform_to_data_privacy_regulations",
]
MASSAGING_ORDER = [
    "data_validation", "data_verification", "data_conversion", "data_formatting", "parse_address",
    "data_cleaning", "data_enrichment", "data_standardization", "data_deduplication", "data_imputation",
    "data_normalization", "concatenate_columns", "redact_sensitive_info", "data_filtering", "data_sampling",
    "transform_data", "subset_extraction", "reconcile_data", "aggregate_data", "data_versioning",
]
TRANSFORMING_ORDER = [
    "data_aggregation", "data_filtering", "data_sorting", "data_joining_and_merging", "data_splitting",
    "data_reshaping", "data_transposition", "data_imputation", "data_duplication", "data_extraction",
    "data_binning", "data_encoding", "data_normalization", "data_scaling", "data_agg_timeframes",
    "data_sampling", "data_parsing", "data_redundancy_removal", "data_transform_by_cal", "data_conversion",
]
VALIDATION = "validation_config"
VALIDATION_SWITCHES = [
    "schema_validation", "datatypes_validation", "duplicates", "row_coulumn_count", "check_uppercase",
    "null_count_validation", "decimal_validation", "spelling_validation", "standardization_check", "special_char_check",
]
# Positions in schema.columns that the massaging stage uses by number.
CONCAT_AT, REDACT_AT, RECONCILE_AT, GROUP_AT, MEAN_AT = (4, 28), (1,), (13, 11), 3, 10
# Fixed value: the column kept out of the special-character strip in the cleansing stage.
STRIP_EXEMPT = ["age"]


class ConfigError(ValueError):
    pass


def _at(c: Mapping, *positions: int) -> list[str] | None:
    """Columns of the configuration's own column list by position."""
    names = (c.get("schema") or {}).get("columns") or []
    return [names[p] for p in positions] if len(names) > max(positions) else None


def _on(config: Mapping, section: str, switch: str) -> bool:
    return bool((config.get(section) or {}).get(switch))


def _step(op: str, **params) -> dict:
    return {"op": op, "params": params}


# --------------------------------------------------------------------------- frame-changing steps
def _cleansing_step(switch: str, c: Mapping) -> dict | None:
    if switch == "remove_duplicates":
        return _step("dedupe")
    if switch == "handle_missing_values":
        return _step("blank_to_null")
    if switch == "standardize_data":
        return _step("upper_strings")
    if switch == "correct_typos_and_inaccuracies" and "typing_error_inaccuracies" in c:
        return _step("map_values", mapping=c["typing_error_inaccuracies"])
    if switch == "handle_outliers" and "columns_to_winsorize" in c:
        return _step("winsorize", cols=c["columns_to_winsorize"], threshold=float(c.get("threshold", 3)))
    if switch == "handle_inconsistent_data" and "inconsistant_column" in c:
        return _step("round_cols", cols=c["inconsistant_column"], scale=2)
    if switch == "handle_incomplete_records" and "null_threshold" in c:
        return _step("drop_incomplete", min_non_null=int(c["null_threshold"]))
    if switch == "convert_data_types" and "columns2convert_data" in c:
        return _step("cast_cols", types={col: "string" for col in c["columns2convert_data"]})
    if switch == "normalize_data":
        return _step("trim_strings")
    if switch == "standardize_categorical_data" and "standardizing_column" in c:
        return _step("map_values", mapping=c["standardizing_column"])
    if switch == "address_inconsistencies_in_date_time_formats" and "datetime_columns" in c:
        return _step("parse_dates", formats={col: "yyyy" for col in c["datetime_columns"]})
    if switch == "remove_irrelevant_information" and "irrelevant_columns" in c:
        return _step("drop_cols", cols=c["irrelevant_columns"])
    if switch == "handle_encoding_issues":
        return _step("reencode", charset=c.get("Text_encoding", "utf-8"))
    if switch == "deal_with_inconsistent_units" and "inconsistant_unit_column" in c:
        return _step("round_to_int", cols=c["inconsistant_unit_column"])
    if switch == "resolve_data_integration_issues" and "integration_issue_col" in c:
        return _step("map_values", mapping=c["integration_issue_col"])
    if switch == "handle_special_characters_and_symbols":
        return _step("strip_special", exclude=STRIP_EXEMPT)
    if switch == "conform_to_data_privacy_regulations" and "hashing_privacy" in c:
        hp = c["hashing_privacy"]
        return _step("hash_cols", cols=hp["columns_to_hash"], bits=int(hp.get("hash_length", 256)))
    return None


def _massaging_step(switch: str, c: Mapping) -> dict | None:
    if switch == "data_conversion" and "columns2convert_data" in c:
        return _step("cast_cols", types={col: "string" for col in c["columns2convert_data"]})
    if switch == "data_formatting":
        return _step("upper_strings")
    if switch == "parse_address" and c.get("address"):
        return _step("parse_address", column=c["address"][0])
    if switch == "data_cleaning" and "typing_error_inaccuracies" in c:
        return _step("map_values", mapping=c["typing_error_inaccuracies"])
    if switch == "data_enrichment" and "enrichment" in c:
        return _step("derive", exprs=c["enrichment"])
    if switch == "data_standardization":
        return _step("strip_special")
    if switch == "data_deduplication":
        return _step("dedupe")
    if switch == "data_imputation" and "to_imputation" in c:
        return _step("impute", spec=c["to_imputation"])
    if switch == "data_normalization" and "rounding_after_cleaning" in c:
        return _step("round_to_int", cols=c["rounding_after_cleaning"])
    if switch == "concatenate_columns" and _at(c, *CONCAT_AT):
        return _step("concat_cols", cols=_at(c, *CONCAT_AT), out=c.get("concatenated_column", "new_col_name"))
    if switch == "concatenate_columns" and "concatenate_columns_1" in c:
        cols = c["concatenate_columns_1"]
        return _step("concat_cols", cols=cols, out=c.get("concatenated_column", "_".join(cols)))
    if switch == "redact_sensitive_info" and ("columns_to_redact" in c or _at(c, *REDACT_AT)):
        return _step("redact", cols=c.get("columns_to_redact") or _at(c, *REDACT_AT), mode="add")
    if switch == "transform_data" and {"column_name", "new_column_name"} <= set(c.get("data_transformation") or {}):
        d = c["data_transformation"]
        return _step("derive", exprs={d["new_column_name"]: f"{q(d['column_name'])} / 2"})
    return None


def _transforming_step(switch: str, c: Mapping) -> dict | None:
    if switch == "data_filtering":
        return _step("drop_sparse_nulls", max_pct=1.0)
    if switch == "data_imputation" and "col_to_fillna" in c:
        return _step("impute", spec={col: "mean" for col in c["col_to_fillna"]})
    if switch == "data_scaling" and "scaling_columns" in c:
        return _step("min_max", cols=list(c["scaling_columns"]), suffix="")
    if switch == "data_agg_timeframes" and "transformation_columns" in c:
        return _step("derive", exprs=c["transformation_columns"])
    if switch == "data_redundancy_removal" and "redundancy_columns" in c:
        return _step("drop_cols", cols=c["redundancy_columns"])
    return None


_STAGES: list[tuple[str, list[str], Callable[[str, Mapping], dict | None]]] = [
    (CLEANSING, CLEANSING_ORDER, _cleansing_step),
    (MASSAGING, MASSAGING_ORDER, _massaging_step),
    (TRANSFORMING, TRANSFORMING_ORDER, _transforming_step),
]


def steps_from_config(config: Mapping, stages: tuple[str, ...] = (CLEANSING, MASSAGING, TRANSFORMING),
                      allow: Iterable[str] = ()) -> list[dict]:
    """Pipeline steps for the switches that are on and change the frame."""
    _check(config, allow)
    out = []
    for section, order, build in _STAGES:
        if section not in stages:
            continue
        for switch in order:
            if _on(config, section, switch):
                step = build(switch, config)
                if step is not None:
                    out.append(step)
    return out


# --------------------------------------------------------------------------- reports
def _schema_from_config(c: Mapping) -> dict[str, str] | None:
    hs = c.get("hive_schema")
    if not hs:
        return None
    return {f["name"]: f["type"] for f in hs.get("fields", [])}


def _validate(df: DataFrame, c: Mapping) -> DataFrame:
    present = {x.lower() for x in df.columns}
    fmt = {k: r"^\d{4}$" for k in c.get("datetime_columns", []) if k.lower() in present}
    dom = {k: list(m) for k, m in (c.get("standardizing_column") or {}).items() if k.lower() in present}
    return quality.validate(df, fmt, dom)


def _converted(df: DataFrame, c: Mapping) -> DataFrame:
    for name in c["col_to_convert"]:
        df = cleanse.convert_unit(df, name, float(c.get("conversion_rate", 0.012)), out=f"{name}_usd", scale=2)
    return df


def _aggregated(df: DataFrame, c: Mapping) -> DataFrame:
    if "aggregate" in c:
        a = c["aggregate"]
        return relate.aggregate(df, [a["by"]], {a.get("out", "mean"): ("mean", a["col"])})
    return relate.aggregate(df, _at(c, GROUP_AT), {"Mean_Loan_Amount": ("mean", _at(c, MEAN_AT)[0])})


def _schema_names(df: DataFrame, c: Mapping) -> DataFrame:
    """Names only: whatever type a column has counts as expected."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    expected = {n: actual.get(n.lower(), "string") for n, wanted in c["data_schema"].items() if wanted}
    return quality.schema_diff(df, expected).select("column", "status")


def _spelling(df: DataFrame, c: Mapping) -> DataFrame:
    name = c.get("spelling_column", "Security_Type")
    found = quality.suggest_spelling(df.select(name), name, c["data_to_check"])
    return found.groupBy(*found.columns).count().filter(f"{q(name + '_distance')} IS NOT NULL")


_Need = Callable[[Mapping], object]
_Build = Callable[[DataFrame, Mapping], DataFrame | dict[str, DataFrame]]
_ALWAYS: _Need = lambda c: True


def _has(*keys: str) -> _Need:
    return lambda c: all(k in c for k in keys)


#: Switches that only compute and show something: what they need of the configuration, and the report.
REPORTS: dict[tuple[str, str], tuple[_Need, _Build]] = {
    (CLEANSING, "validate_data"): (_ALWAYS, _validate),
    (MASSAGING, "data_validation"): (_ALWAYS, _validate),
    (MASSAGING, "data_verification"): (_schema_from_config, lambda d, c: quality.schema_diff(d, _schema_from_config(c))),
    (MASSAGING, "data_filtering"): (_has("filter1"), lambda d, c: relate.where_cmp(
        d, c["filter1"]["col_to_filter"], ">", c["filter1"]["filter_value"])),
    (MASSAGING, "data_sampling"): (_ALWAYS, lambda d, c: relate.sample(d, float(c.get("sampling_fraction", 0.1)))),
    (MASSAGING, "subset_extraction"): (_has("Subset_column"), lambda d, c: relate.where_cmp(
        d, c["Subset_column"][0], "=", c["Subset_column"][1])),
    (MASSAGING, "reconcile_data"): (lambda c: "reconcile_columns" in c or _at(c, *RECONCILE_AT), lambda d, c: relate.reconcile_cols(
        d, *(c.get("reconcile_columns") or _at(c, *RECONCILE_AT)))),
    (MASSAGING, "aggregate_data"): (lambda c: "aggregate" in c or _at(c, GROUP_AT, MEAN_AT), _aggregated),
    (TRANSFORMING, "data_aggregation"): (_has("col_to_describe"), lambda d, c: stats.describe_cols(d, c["col_to_describe"])),
    (TRANSFORMING, "data_sorting"): (_has("col_to_sort"), lambda d, c: relate.sort_by(d, [(c["col_to_sort"], False)])),
    (TRANSFORMING, "data_splitting"): (_has("split_by_status"), lambda d, c: {
        str(v): part for v, part in relate.split_by(d, "Status", c["split_by_status"]).items()}),
    (TRANSFORMING, "data_reshaping"): (_has("reshaping_col"), lambda d, c: relate.pivot_table(
        d, c["reshaping_col"]["col"], c["reshaping_col"]["pivot_by"], c["reshaping_col"]["col_to_agg"])),
    (TRANSFORMING, "data_duplication"): (_ALWAYS, lambda d, c: quality.duplicate_stats(d)),
    (TRANSFORMING, "data_extraction"): (_has("col_to_extract"), lambda d, c: relate.project(d, c["col_to_extract"])),
    (TRANSFORMING, "data_binning"): (_has("cols_to_binning"), lambda d, c: {
        name: derive.bin_col(d, name, splits, labels) for name, (splits, labels) in c["cols_to_binning"].items()}),
    (TRANSFORMING, "data_encoding"): (_has("data_encoding"), lambda d, c: derive.encode_map(d, c["data_encoding"])),
    (TRANSFORMING, "data_normalization"): (_has("col_to_normalize"), lambda d, c: stats.min_max(
        d, c["col_to_normalize"], keep=[k for k in c.get("normalize_keep", []) if k in d.columns])),
    (TRANSFORMING, "data_sampling"): (_ALWAYS, lambda d, c: relate.sample(d, float(c.get("sampling_fraction", 0.1)))),
    (TRANSFORMING, "data_transform_by_cal"): (_has("bracket_column", "as_of"), lambda d, c: derive.age_from_bracket(
        d, c["bracket_column"], c["as_of"])),
    (TRANSFORMING, "data_conversion"): (_has("col_to_convert"), _converted),
    (VALIDATION, "schema_validation"): (_has("data_schema"), _schema_names),
    (VALIDATION, "datatypes_validation"): (_schema_from_config, lambda d, c: quality.schema_diff(d, _schema_from_config(c))),
    (VALIDATION, "spelling_validation"): (_has("data_to_check"), _spelling),
}
# Declared checks that go together into one quality report, and what they need.
CHECKS: dict[str, _Need] = {
    "duplicates": _ALWAYS, "row_coulumn_count": _ALWAYS, "check_uppercase": _ALWAYS, "null_count_validation": _ALWAYS,
    "decimal_validation": _has("dec_col_to_check"), "standardization_check": _has("std_col_to_check", "standardizing_column"),
    "special_char_check": _ALWAYS,
}
#: The two validations of a frame are one report.
_SAME = {(CLEANSING, "validate_data"): "validate", (MASSAGING, "data_validation"): "validate"}


def reports_from_config(df: DataFrame, config: Mapping, allow: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Report frames for the switches that are on and only compute and show something.

    Keys are ``<section>.<switch>`` (with ``.<part>`` for reports of several frames); each
    value is a lazy DataFrame over ``df``."""
    _check(config, allow)
    out: dict[str, DataFrame] = {}
    for (section, switch), (need, build) in REPORTS.items():
        if not _on(config, section, switch) or not need(config):
            continue
        name = _SAME.get((section, switch), f"{section}.{switch}")
        if name in out:
            continue
        got = build(df, config)
        out.update({f"{name}.{k}": v for k, v in got.items()} if isinstance(got, dict) else {name: got})
    checks = quality_checks_from_config(config, df)
    if checks:
        out[VALIDATION] = quality.quality_report(df, checks)
    return out


def stack_reports(reports: Mapping[str, DataFrame]) -> DataFrame:
    """All reports as one frame: report, item (the row's text columns), measure (a numeric or
    boolean column) and its value. A report of texts alone has the measure ``rows``, its rows by item."""
    out = None
    for name, df in reports.items():
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        texts = [c for c, t in kinds.items() if t == "string"]
        numbers = [c for c, t in kinds.items() if t in ("int", "bigint", "double", "float", "boolean") or t.startswith("decimal")]
        if not numbers:
            df, numbers = df.groupBy(*[col(c) for c in texts]).agg(F.count(F.lit(1)).alias("rows")), ["rows"]
        cells = F.array(*[F.struct(F.lit(c).alias("measure"), col(c).cast("double").alias("value")) for c in numbers])
        part = df.select(F.lit(name).alias("report"), F.concat_ws("|", *[col(c) for c in texts]).alias("item"), F.inline(cells))
        out = part if out is None else out.unionByName(part)
    return out


def quality_checks_from_config(c: Mapping, df: DataFrame) -> list[dict]:
    """The declared post-run checks (validation section) as quality_report checks."""
    v = c.get(VALIDATION) or {}
    out: list[dict] = []
    present = set(df.columns)
    if v.get("duplicates"):
        out.append({"check": "duplicates"})
    if v.get("row_coulumn_count"):
        out.append({"check": "row_count", "min": 1})
    for name in df.columns if v.get("null_count_validation") else []:
        out.append({"check": "not_null", "column": name})
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    for name in strings if v.get("check_uppercase") else []:
        out.append({"check": "uppercase", "column": name})
    for name in c.get("dec_col_to_check", []) if v.get("decimal_validation") else []:
        if name in present:
            out.append({"check": "decimal", "column": name, "scale": 2})
    for name in c.get("std_col_to_check", []) if v.get("standardization_check") else []:
        targets = list((c.get("standardizing_column") or {}).get(name, {}).values())
        if name in present and targets:
            out.append({"check": "allowed", "column": name, "values": targets})
    for name in strings if v.get("special_char_check") else []:
        out.append({"check": "special_chars", "column": name, "pattern": SPECIAL_CHARS})
    return out


def unsupported_switches(config: Mapping) -> list[str]:
    """Switches that are on but become neither a step nor a report: their names are unknown,
    their parameters are missing, or they need inputs a configuration cannot hold (a second
    table for joins and key checks, a gazetteer, a sink path for versions)."""
    missing = []
    builders = {section: (order, build) for section, order, build in _STAGES} | {VALIDATION: (VALIDATION_SWITCHES, None)}
    for section, (order, build) in builders.items():
        known = [*order, *[k for k in (config.get(section) or {}) if k not in order]]
        for switch in known:
            if not _on(config, section, switch):
                continue
            need = REPORTS.get((section, switch), (None, None))[0] or (CHECKS.get(switch) if section == VALIDATION else None)
            step = build(switch, config) if build else None
            if step is None and not (need and need(config)):
                missing.append(f"{section}.{switch}")
    return missing


def _check(config: Mapping, allow: Iterable[str]) -> None:
    left = [s for s in unsupported_switches(config) if s not in set(allow)]
    if left:
        raise ConfigError(f"switches without a step or a report: {', '.join(left)}")
