import pytest

from kempt.plans import config as cfg
from kempt.plans.pipeline import check_steps


def _config():
    return {
        "cleansing_config": {"remove_duplicates": True, "handle_outliers": True, "validate_data": True,
                             "validate_references_and_foreign_keys": True,
                             "conform_to_data_privacy_regulations": True, "standardize_data": False},
        "massaging": {"transform_data": True, "subset_extraction": True, "data_imputation": True,
                      "data_verification": True},
        "transforming": {"data_redundancy_removal": True, "data_filtering": True, "data_aggregation": True,
                         "data_duplication": True, "data_extraction": True},
        "columns_to_winsorize": ["x"], "threshold": 3,
        "hashing_privacy": {"columns_to_hash": ["id"], "hash_length": 256},
        "to_imputation": {"s": "NA"}, "redundancy_columns": ["gone"],
        "Subset_column": ["s", "a"], "col_to_describe": ["x"], "col_to_extract": ["id", "x"],
        "hive_schema": {"type": "struct", "fields": [{"name": "id", "type": "int", "nullable": True}]},
        "validation_config": {"duplicates": True, "null_count_validation": True},
    }


def test_steps_in_stage_order_and_valid():
    steps = cfg.steps_from_config(_config(), allow=cfg.unsupported_switches(_config()))
    assert [s["op"] for s in steps] == ["dedupe", "winsorize", "hash_cols", "impute", "drop_sparse_nulls",
                                        "drop_cols"]
    assert len(check_steps(steps)) == len(steps)


def test_unsupported_switches_are_listed():
    assert cfg.unsupported_switches(_config()) == ["cleansing_config.validate_references_and_foreign_keys",
                                                   "massaging.transform_data"]


def test_reports(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 2.0), (2, None, 3.0)], "id int, s string, x double")
    r = cfg.reports_from_config(df, _config(), allow=cfg.unsupported_switches(_config()))
    assert set(r) >= {"validate", "massaging.data_verification", "massaging.subset_extraction",
                      "transforming.data_aggregation", "transforming.data_duplication",
                      "transforming.data_extraction", "validation_config"}
    assert r["massaging.subset_extraction"].count() == 2
    assert r["transforming.data_duplication"].collect()[0]["surplus_rows"] == 1
    assert r["transforming.data_extraction"].columns == ["id", "x"]


def test_nothing_is_lost_silently(spark):
    for section, switch in [("cleansing_config", "normalize_numerical_features"), ("massaging", "aggregate_data"),
                            ("massaging", "reconcile_data"), ("transforming", "data_sorting"), ("transforming", "data_reshaping"),
                            ("validation_config", "schema_validation"), ("validation_config", "datatypes_validation"),
                            ("validation_config", "spelling_validation"), ("transforming", "no_such_switch")]:
        with pytest.raises(cfg.ConfigError, match=switch):
            cfg.steps_from_config({section: {switch: True}})
        assert cfg.steps_from_config({section: {switch: False}}) == []


def test_positional_columns_and_transform():
    names = [f"c{i}" for i in range(30)]
    c = {"massaging": {"concatenate_columns": True, "redact_sensitive_info": True, "transform_data": True},
         "schema": {"columns": names}, "data_transformation": {"column_name": "c2", "new_column_name": "half"}}
    steps = {s["op"]: s["params"] for s in cfg.steps_from_config(c)}
    assert steps["concat_cols"]["cols"] == ["c4", "c28"] and steps["redact"]["cols"] == ["c1"]
    assert steps["derive"]["exprs"] == {"half": "`c2` / 2"}


def test_positional_reports(spark):
    names = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame([tuple(range(14)), (*range(13), 11)], ", ".join(f"{n} int" for n in names))
    c = {"massaging": {"reconcile_data": True, "aggregate_data": True}, "schema": {"columns": names},
         "validation_config": {"schema_validation": True, "spelling_validation": True},
         "data_schema": {"c1": True, "gone": True}, "data_to_check": ["DIRECT"], "spelling_column": "s"}
    r = cfg.reports_from_config(df.selectExpr("*", "'DIRCT' AS s"), c)
    assert r["massaging.reconcile_data"].count() == 1
    assert r["massaging.aggregate_data"].first()["Mean_Loan_Amount"] == 10.0
    status = {x["column"]: x["status"] for x in r["validation_config.schema_validation"].collect()}
    assert status["c1"] == "match" and status["gone"] == "missing" and status["c2"] == "extra"
    assert r["validation_config.spelling_validation"].first()["s_suggestion"] == "DIRECT"
