"""Documents, CSV, landing folder, sinks, model store, incremental ingest."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwright import SeriesSpec
from panelwright.operators.checks import check_summary, forecast_checks
from panelwright.operators.quality import GENERAL_NAMES, SECTOR_NAMES, column_roles, export_rules, standard_names
from panelwright.sources import documents, sinks, tables
from panelwright.streaming import landing

LIST = '[{"Fecha":"2023-01-01","Valor":105.2},{"Fecha":"2023-02-01","Valor":105.8},{"Fecha":"2023-03-01","Valor":106.1}]'
CASES = {
    "list": (LIST, "direct_list", 3),
    "object": (f'{{"Data": {LIST}}}', "known_key", 3),
    "arrays": (f'[{{"Nombre":"A","Data":{LIST}}},{{"Nombre":"B","Data":[]}},{{"Nombre":"C","Data":{LIST}}}]', "array_of_objects", 6),
    "second key": (f'{{"Data":[],"Valores":{LIST}}}', "known_key", 3),
    "best": (f'{{"a":[1,2,3,4,5],"b":{LIST}}}', "best_list", 3),
    "long": ('{"a":[1,2,3,4,5,6,7,8,9,10,11,12,13,14],"b":[{"x":1},{"x":2}]}', "best_list", 14),
    "nested": ('{"Fecha":"2023-01-01","x":{"y":1}}', "normalise", 1),
    "text": ('"invalid_data"', None, 1),
    "broken": ('[{"Fecha":', None, 1),
    "empty": ("[]", None, 1),
}


def test_documents(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "name string, json string")
    records, quarantine = documents.parse_documents(df, "json")
    got = {r["name"]: (r["strategy"], r["n"]) for r in records.groupBy("name", "strategy").agg(F.count("*").alias("n")).collect()}
    assert got == {k: (s, n) for k, (_, s, n) in CASES.items() if s}
    assert {r["name"] for r in quarantine.collect()} == {k for k, v in CASES.items() if v[1] is None}
    values = documents.read_series(records.where("name = 'list'")).orderBy("t").collect()
    assert [r["value"] for r in values] == [105.2, 105.8, 106.1]


def test_every_series_of_a_document_is_read(spark):
    df = spark.createDataFrame([(CASES["arrays"][0],)], "json string")
    assert {r[0] for r in documents.parse_documents(df, "json")[0].select("series").distinct().collect()} == {"A", "C"}


def test_only_chosen_strategies(spark):
    df = spark.createDataFrame([(LIST,)], "json string")
    assert documents.parse_documents(df, "json", ["known_key"])[1].count() == 1
    with pytest.raises(ValueError):
        documents.parse_documents(df, "json", ["guess"])


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "none"), "a int")
    (tmp_path / "empty.csv").write_text("a\n")
    with pytest.raises(tables.EmptyInputError):
        tables.read_csv(spark, str(tmp_path / "empty.csv"), "a int")


def test_renames(spark):
    df = spark.createDataFrame([("2023-01-01", 1.0)], "Fecha string, Valor double")
    assert standard_names(df, GENERAL_NAMES).columns == ["fecha", "ipc_general"]
    wide = df.withColumnRenamed("Valor", "Alimentos y bebidas no alcohólicas")
    assert standard_names(wide, SECTOR_NAMES).columns == ["fecha", "ipc_alimentacion"]
    with pytest.raises(ValueError):
        standard_names(df.withColumn("Indice", F.lit(1.0)), GENERAL_NAMES)


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("2023-02-01", 1.23456), ("2023-01-01", 2.0)], "fecha string, ipc_general double")
    sinks.write_raw(df, str(tmp_path / "raw"), "general", "2024-01-01 00:00:00")
    back = tables.read_csv(
        spark, str(tmp_path / "raw"), "fecha string, ipc_general double, data_type string, extraction_date string"
    )
    assert sorted((r[0], r[1], r[2]) for r in back.collect()) == [
        ("2023-01-01", 2.0, "general"), ("2023-02-01", 1.2346, "general"),
    ]
    with pytest.raises(sinks.ExportRefused):
        sinks.write_raw(df.drop("ipc_general"), str(tmp_path / "no"), "general", "x")
    with pytest.raises(sinks.ExportRefused):
        sinks.write_raw(df.limit(0), str(tmp_path / "no"), "general", "x")


def test_export_rules_of_sparse_columns(spark):
    df = spark.createDataFrame([("2023-01-01", 1.0)] + [("2023-01-02", None)] * 9, "fecha string, v double")
    failed = {r["rule"] for r in export_rules(df, ["fecha"], "fecha").where("NOT passed").collect()}
    assert failed == {"at_most_80_percent_missing"}


def test_column_roles_ignore_integer_codes(spark):
    df = spark.createDataFrame([("2023-01-01", 19, 105.2)], "fecha string, FK_Periodo int, ipca double")
    roles = {r["column"]: r for r in column_roles(df).collect()}
    assert roles["fecha"]["is_date"] and not roles["FK_Periodo"]["is_date"]
    assert roles["ipca"]["is_value"] and roles["ipca"]["is_price_index"] and roles["ipca"]["is_target"]


FORECAST = [(date(2024, m, 1), v, v - 0.5, v + 0.5, "ar1", 0.95) for m, v in enumerate([2.1, 2.2, 2.0, 1.9, 2.1, 2.3], 1)]
SCHEMA = "t date, prediction double, lower double, upper double, model string, level double"


def test_forecast_files(spark, tmp_path):
    df = spark.createDataFrame(FORECAST, SCHEMA).withColumn("k", F.lit("a"))
    sinks.write_forecast_csv(df, str(tmp_path / "csv"), {"Model": "ar1"})
    text = "".join(f.read_text() for f in (tmp_path / "csv").glob("part-*"))
    assert "# Model: ar1" in text
    back = tables.read_csv(
        spark, str(tmp_path / "csv"), SCHEMA.replace("date", "string") + ", k string", comment="#"
    )
    assert sorted(r["prediction"] for r in back.collect()) == [1.9, 2.0, 2.1, 2.1, 2.2, 2.3]
    doc = sinks.forecast_documents(df, SeriesSpec("k", "t", "prediction", "month"), "now").first()["document"]
    assert '"t":"2024-01-01"' in doc and doc.index("2024-01-01") < doc.index("2024-06-01")


def test_forecast_checks(spark):
    good = spark.createDataFrame(FORECAST, SCHEMA).withColumn("k", F.lit("good"))
    bad = good.withColumns(
        {"k": F.lit("bad"), "prediction": F.when(F.month("t") == 3, float("nan")).otherwise(F.col("prediction") * 20)}
    )
    rows = {r["k"]: r for r in check_summary(forecast_checks(good.union(bad), ["k"]), ["k"]).collect()}
    assert rows["good"]["valid"] and rows["good"]["passed_checks"] == rows["good"]["total_checks"] == 7
    assert not rows["bad"]["valid"] and rows["bad"]["errors"] == 2


def test_dates_out_of_order(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(reversed(FORECAST))], "p int, " + SCHEMA)
    checks = {r["check"]: r["passed"] for r in forecast_checks(df, [], position="p").collect()}
    assert not checks["chronological_dates"] and not checks["regular_date_gaps"]


def test_new_files_are_read_once(spark, tmp_path):
    seen = []
    schema = spark.createDataFrame([], "a int").schema
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.csv").write_text(f"a\n{i}\n")
        landing.ingest_new_files(
            spark, str(tmp_path / "in"), schema, str(tmp_path / "state"), lambda d, b: seen.extend(r[0] for r in d.collect())
        )
    assert seen == [0, 1]


def test_json_leaves(spark):
    """Ten thousand different keys, all kinds of values, and texts that are none."""
    import json

    from panelwright.sources.documents import json_leaves

    docs = [
        (1, json.dumps({f"key{i}": {"n": i} for i in range(10_000)})),
        (2, '{"a": {"b": [1, {"c": "x"}, [], null]}, "d": true, "e": 2.5, "f": {}}'),
        (3, "[[1, 2], 3]"), (4, "7"), (5, "no json"), (6, None), (7, '{"": {"a.b": "t"}}'),
    ]
    got = {}
    for r in json_leaves(spark.createDataFrame(docs, "id int, json string"), "json").collect():
        got.setdefault(r["id"], {})[r["path"]] = r["value"]
    assert got[1] == {f"key{i}.n": str(i) for i in range(10_000)}
    assert got[2] == {"a.b[0]": "1", "a.b[1].c": "x", "a.b[2]": None, "a.b[3]": None, "d": "true", "e": "2.5", "f": None}
    assert got[3] == {"[0][0]": "1", "[0][1]": "2", "[1]": "3"} and got[4] == {"": "7"}
    assert set(got) == {1, 2, 3, 4, 7} and list(got[7].values()) == ["t"]
    with pytest.raises(ValueError):
        json_leaves(spark.createDataFrame([(1, "[[[1]]]")], "id int, json string"), "json", deepest=2)
    assert json_leaves(spark.createDataFrame([], "json string"), "json").count() == 0
