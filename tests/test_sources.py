import json

import pytest
import yaml

from tidemark.plans.tables import DAILY_ACTIVITY
from tidemark.sources import (
    jdbc_options,
    load_catalog,
    parse_source,
    read_catalog,
    read_source,
    register_format,
    schema_from_json,
    stage_source,
)


def test_catalog_skips_defaults_and_rejects_unknown(tmp_path):
    cfg = {"defaults": {"x": 1}, "csv": {"a": {"path": "/p", "schema": DAILY_ACTIVITY.jsonValue()}}}
    cat = load_catalog(cfg)
    assert list(cat) == ["a"] and cat["a"]["format"] == "csv" and cat["a"]["schema"] == DAILY_ACTIVITY
    with pytest.raises(ValueError, match="Unknown source format"):
        load_catalog({"avro": {"a": {"path": "/p"}}})
    with pytest.raises(ValueError, match="needs a 'schema'"):
        load_catalog({"csv": {"a": {"path": "/p"}}})
    with pytest.raises(ValueError, match="needs a 'path'"):
        load_catalog({"parquet": {"a": {"schema": "a INT"}}})


def test_catalog_from_yaml_and_json_schema_file(spark, tmp_path):
    schema_file = tmp_path / "s.json"
    schema_file.write_text(json.dumps(DAILY_ACTIVITY.jsonValue()))
    assert schema_from_json(schema_file) == DAILY_ACTIVITY
    cfg = tmp_path / "sources.yaml"
    cfg.write_text(yaml.safe_dump({"parquet": {"w": {"path": "/x", "schema": str(schema_file)}},
                                   "csv": {"w": {"path": "/y", "schema": "a INT"}}}, sort_keys=False))
    cat = load_catalog(cfg)
    assert cat["w"]["format"] == "csv"  # later duplicate name wins
    assert cat["w"]["schema"].simpleString() == "struct<a:int>"


def test_csv_and_parquet_round_trip(spark, scratch):
    rows = [("2024_01", 3), ("2024_02", 4)]
    df = spark.createDataFrame(rows, DAILY_ACTIVITY)
    csv_path, pq_path = scratch("csv"), scratch("pq")
    df.repartition(2).write.csv(csv_path)  # no header line, as Spark writes it
    df.write.parquet(pq_path)
    dfs = read_catalog(
        spark,
        {
            "csv": {"c": {"path": csv_path, "schema": DAILY_ACTIVITY.jsonValue()}},
            "parquet": {"p": {"path": pq_path, "schema": DAILY_ACTIVITY.jsonValue()}},
        },
    )
    for d in dfs.values():
        assert sorted(tuple(r) for r in d.collect()) == rows
        assert d.schema == DAILY_ACTIVITY


def test_csv_header_only_where_asked_for(spark, scratch):
    path = scratch("csv")
    spark.range(1000).selectExpr("cast(id as string) k", "1 n").repartition(4).write.option("header", "true").csv(path)
    entry = {"path": path, "schema": "k string, n int"}
    read = lambda e: read_catalog(spark, {"csv": {"c": e}})["c"].count()
    assert read(entry) == 1004 and read(entry | {"options": {"header": "true"}}) == 1000


def test_jdbc_options_checked_without_connecting():
    spec = parse_source(
        "jdbc",
        "orders",
        {"url": "jdbc:postgresql://db/x", "options": {"dbtable": "orders", "partitionColumn": "id",
                                                      "lowerBound": 0, "upperBound": 100, "numPartitions": 8}},
    )
    opts = jdbc_options(spec)
    assert opts["url"] == "jdbc:postgresql://db/x" and opts["numPartitions"] == "8"
    with pytest.raises(ValueError, match="dbtable"):
        jdbc_options(parse_source("jdbc", "x", {"url": "jdbc:x"}))
    with pytest.raises(ValueError, match="needs all"):
        jdbc_options(parse_source("jdbc", "x", {"url": "jdbc:x", "options": {"dbtable": "t", "partitionColumn": "id", "lowerBound": 0, "numPartitions": 3}}))
    assert jdbc_options(parse_source("jdbc", "x", {"url": "jdbc:x", "options": {"dbtable": "t", "numPartitions": 3}}))["numPartitions"] == "3"


def test_delta_without_package_is_a_clear_error(spark, scratch):
    spec = parse_source("delta", "d", {"path": scratch("delta")})
    with pytest.raises(ValueError, match="delta-spark"):
        read_source(spark, spec).collect()


def test_registered_format(spark, scratch):
    path = scratch("orc")
    spark.range(5).write.orc(path)
    register_format("orc_table", lambda session, source: session.read.orc(source["location"]))
    assert read_catalog(spark, {"orc_table": {"o": {"path": path}}})["o"].count() == 5


def _stage(spark, scratch, fmt, lines, schema, **options):
    path = scratch("raw")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    source = parse_source(fmt, "raw", {"path": path, "schema": schema, "options": options})
    return stage_source(spark, source, scratch("staged"))


def test_malformed_csv_records_are_kept_apart(spark, scratch):
    lines = ["1,a,2024-01-01", "x,b,2024-01-02", "3,c,not a date", "4,d", "5,e,2024-01-05,more", ",,", "7,g,2024-01-07"]
    staged = _stage(spark, scratch, "csv", lines, "id long, name string, day date", mode="DROPMALFORMED")
    assert (staged["rows"], staged["rejected"]) == (3, 4)
    assert [r.id for r in staged["good"].orderBy("id").collect()] == [None, 1, 7]
    assert sorted(r.record for r in staged["bad"].collect()) == sorted(lines[1:5])
    assert all("/raw-" in r.file for r in staged["bad"].collect())
    # A count over no column, which would parse nothing, agrees.
    assert staged["good"].count() == 3 and staged["bad"].count() == 4


def test_staging_without_good_or_bad_records(spark, scratch):
    none = _stage(spark, scratch, "csv", ["1,a"], "id long, name string")
    assert none["bad"].collect() == [] and none["good"].count() == 1
    every = _stage(spark, scratch, "csv", ["x,a"], "id long, name string")
    assert every["good"].collect() == [] and every["good"].columns == ["id", "name"] and every["bad"].count() == 1
    empty = _stage(spark, scratch, "csv", [], "id long, name string")
    assert (empty["rows"], empty["rejected"]) == (0, 0) and empty["good"].count() == 0


def test_malformed_json_records(spark, scratch):
    lines = ['{"id": 1, "name": "a"}', '{"id": "x"}', "{broken", '{"id": 4}']
    staged = _stage(spark, scratch, "json", lines, "id long, name string")
    assert (staged["rows"], staged["rejected"]) == (2, 2)
    assert sorted(r.id for r in staged["good"].collect()) == [1, 4]


def test_staging_refuses_other_sources(spark, scratch):
    with pytest.raises(ValueError, match="CSV and JSON"):
        stage_source(spark, parse_source("parquet", "p", {"path": "/x", "schema": "id long"}), scratch())
    with pytest.raises(ValueError, match="malformed records"):
        stage_source(spark, parse_source("csv", "p", {"path": "/x", "schema": "id long, _malformed boolean"}), scratch())
