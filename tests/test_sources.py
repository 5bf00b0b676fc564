import json
import os

import credit
import pytest
from pyspark.sql import functions as F

from riskloom.sources import cache, contracts as c, sinks, tables


def test_csv_round_trip_and_missing(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("k,x\n1,2.5\n2,\n3,NaN\n4,inf\n")
    df = tables.read_csv(spark, path, tables.schema_of({"k": "int64", "x": "float64"}))
    assert [r["x"] for r in df.orderBy("k").collect()] == [2.5, None, None, None]
    assert dict(tables.read_csv(spark, path).dtypes)["k"] == "int"
    sinks.write_csv(df, str(tmp_path / "out"))
    assert tables.read_csv(spark, str(tmp_path / "out")).count() == 4


def test_parquet_needs_its_build_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run the build"):
        tables.read_parquet(spark, str(tmp_path / "none"), "run the build")


def test_conform(spark):
    df = spark.createDataFrame([(1, "7")], "b int, a string")
    out = tables.conform(df, tables.schema_of({"a": "int64", "z": "float64"}))
    assert out.dtypes == [("a", "bigint"), ("z", "double")] and tuple(out.first()) == (7, None)


def test_cache_builds_once_per_input_state(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "cache")
    assert cache.load_or_build(spark, path, build, "a").count() == 3
    assert cache.load_or_build(spark, path, build, "a").count() == 3
    assert len(calls) == 1
    cache.load_or_build(spark, path, build, "b")
    assert len(calls) == 2


def test_score_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.25, 9)], "SK_ID_CURR long, probability double, other int")
    sinks.write_scores(df, str(tmp_path / "s"), c.KEY)
    back = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert back.columns == ["SK_ID_CURR", "TARGET"] and back.first()["TARGET"] == "0.25"


def test_json_sink(spark, tmp_path):
    sinks.write_json(spark.createDataFrame([("auc", 0.5)], "metric string, value double"), str(tmp_path / "m"))
    assert json.loads((tmp_path / "m").read_text()) == {"metric": "auc", "value": 0.5}
    two = spark.createDataFrame([("é", None), ("b", 1.0)], "metric string, value double")
    sinks.write_json(two, str(tmp_path / "m"))  # replaces the first
    assert json.loads((tmp_path / "m").read_text("utf-8")) == [{"metric": "é", "value": None}, {"metric": "b", "value": 1.0}]
    sinks.write_json(two.limit(0), str(tmp_path / "none"))
    assert json.loads((tmp_path / "none").read_text()) == []
    sinks.write_json_lines(two, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2


def test_latin1_dictionary(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_bytes("Table,Row,Description\nt1,A,naïve é\nt2,B,no\n".encode("latin-1"))
    rows = tables.column_descriptions(spark, str(path), "t1").collect()
    assert [tuple(r) for r in rows] == [("A", "naïve é")]


def test_contracts():
    assert len(c.APPLICATION_TYPES) == 121 and len(c.MAIN_FEATURES) == 60
    kinds = list(c.APPLICATION_TYPES.values())
    assert (kinds.count("int64"), kinds.count("float64"), kinds.count("object")) == (40, 65, 16)
    assert set(c.DOMAINS) == {n for n, t in c.APPLICATION_TYPES.items() if t == "object"}


def test_synthetic_tables_are_normalised(spark):
    df = credit.to_spark(spark, credit.applications(50))
    assert df.where(F.isnan("OWN_CAR_AGE")).count() == 0 and df.where("OWN_CAR_AGE is null").count() > 0


def test_typed_csv_follows_its_header(spark, tmp_path):
    (tmp_path / "b.csv").write_text("STATUS,SK_ID_BUREAU,EXTRA\nC,7,x\n,8,\n")
    df = tables.read_csv(spark, str(tmp_path / "b.csv"), types=c.HISTORY_TYPES["bureau_balance"])
    assert df.dtypes == [("STATUS", "string"), ("SK_ID_BUREAU", "bigint"), ("EXTRA", "string")]
    assert [tuple(r) for r in df.collect()] == [("C", 7, "x"), (None, 8, None)]


def test_contract_file(spark, tmp_path):
    (tmp_path / "f.json").write_text('[\n "a", "b c"\n]')
    assert tables.read_names(spark, str(tmp_path / "f.json")) == ["a", "b c"]
    (tmp_path / "g.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        tables.read_names(spark, str(tmp_path / "g.json"))


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from riskloom import session

    class Conf:
        def get(self, *_):
            return None

    class Elsewhere:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere())
