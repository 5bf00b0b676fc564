import credit
import pytest
from pyspark.sql import functions as F

from riskloom.operators import validate
from riskloom.sources import contracts as c


@pytest.fixture(scope="module")
def table(spark):
    return credit.to_spark(spark, credit.applications(1200, seed=3))


def violations(df):
    return {r["check"]: r["violations"] for r in df.collect()}


def test_clean_table_passes(table):
    schema = violations(validate.schema_check(table, c.REQUIRED_COLUMNS, ["AMT_CREDIT", "DAYS_BIRTH"]))
    assert set(schema.values()) == {0}
    assert violations(validate.schema_check(table, ["nope"], ["CODE_GENDER"], c.MIN_COLUMNS)) == {
        "required:nope": 1, "numeric:CODE_GENDER": 1, "min_columns": 1,
    }
    rules = validate.application_rules(table.columns) + validate.binary_target(c.TARGET)
    assert set(violations(validate.rule_check(table, rules)).values()) == {0}
    assert violations(validate.content_check(table, [c.KEY, c.TARGET])) == {"all_null_rows": 0, "infinite_values": 0}
    assert validate.domain_rejects(table, c.KEY, c.DOMAINS).count() == 0
    keys = validate.key_check(table, c.KEY).first()
    assert (keys["rows"], keys["null_keys"], keys["duplicated_keys"], keys["extra_rows"]) == (1200, 0, 0, 0)


def test_broken_rows_are_counted(spark):
    df = spark.createDataFrame(
        [(1, -5.0, 1, "M"), (1, None, None, "Z"), (None, float("inf"), 3, None)],
        "SK_ID_CURR long, AMT_CREDIT double, TARGET int, CODE_GENDER string",
    )
    assert violations(validate.rule_check(df, validate.application_rules(df.columns)))["range:AMT_CREDIT"] == 1
    assert violations(validate.rule_check(df, validate.binary_target("TARGET"))) == {"target_binary": 1, "target_not_null": 1}
    keys = validate.key_check(df, "SK_ID_CURR").first()
    assert (keys["null_keys"], keys["duplicated_keys"], keys["extra_rows"]) == (1, 1, 1)
    assert violations(validate.content_check(df, ["SK_ID_CURR"]))["infinite_values"] == 1
    assert [tuple(r) for r in validate.domain_rejects(df, "SK_ID_CURR", c.DOMAINS).collect()] == [(1, "CODE_GENDER", "Z")]
    assert violations(validate.rate_check(df, "TARGET", *c.DEFAULT_RATE_RANGE)) == {"target_rate": 1}


def records(spark, *rows):
    names = ["SK_ID_CURR", "AMT_INCOME_TOTAL", "CODE_GENDER", "DAYS_BIRTH"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_records(spark):
    df = records(
        spark,
        ("1", "150000.5", "M", "-12000"),
        ("2", "not_a_number", "F", "-1"),
        ("3", "1e5", "INVALID", "-1.5"),
        ("4", None, None, "-9000.0"),
        (None, None, None, None),
        ("5", None, None, None),
    )
    checked = validate.check_records(df, c.APPLICATION_TYPES, c.DOMAINS)
    rejects = {(r["SK_ID_CURR"], r["column"], r["reason"]) for r in validate.rejected_records(checked, c.KEY).collect()}
    assert rejects == {
        ("2", "AMT_INCOME_TOTAL", "not_a_number"),
        ("3", "CODE_GENDER", "unknown_level"),
        ("3", "DAYS_BIRTH", "not_an_integer"),
        (None, None, "empty_record"),
    }
    valid = {r["SK_ID_CURR"]: r for r in validate.valid_records(checked, c.APPLICATION_TYPES).collect()}
    assert set(valid) == {1, 4, 5}
    assert (valid[1]["AMT_INCOME_TOTAL"], valid[4]["DAYS_BIRTH"]) == (150000.5, -9000)


def test_derived_schema_and_domains(table):
    types = {r["column"]: r["type"] for r in validate.type_table(table, [c.TARGET]).collect()}
    assert all(types[name] == c.APPLICATION_TYPES[name] for name in types)
    catalog = validate.domain_catalog(table, ["CODE_GENDER"])
    assert {r["value"] for r in catalog.collect()} <= set(c.DOMAINS["CODE_GENDER"])


def test_fingerprint(table):
    assert validate.table_fingerprint(table) == validate.table_fingerprint(table.repartition(7))
    changed = table.withColumn("AMT_CREDIT", F.when(F.col(c.KEY) == 100005, 1.0).otherwise(F.col("AMT_CREDIT")))
    assert validate.table_fingerprint(table) != validate.table_fingerprint(changed)


def test_infinity_is_no_number_and_nan_is_missing(spark):
    types = {"k": "int64", "x": "float64"}
    rows = spark.createDataFrame([("1", "inf"), ("2", "NaN"), ("3", "-Infinity"), ("4", "2.5")], "k string, x string")
    checked = validate.check_records(rows, types, {})
    assert sorted(r.k for r in validate.rejected_records(checked, "k").collect()) == ["1", "3"]
    assert sorted(tuple(r) for r in validate.valid_records(checked, types).collect()) == [(2, None), (4, 2.5)]


def test_minimum_row_count(spark):
    assert validate.size_check(spark.range(10)).first().violations == 1
    assert validate.size_check(spark.range(10), min_rows=10).first().violations == 0
