from __future__ import annotations

import pytest
from plans_of import formatted
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.contract import TRIPS, Contract, ContractError
from tripwright.sources import files, records, tables

SMALL = Contract.of(
    {"Id": T.LongType(), "Place": T.LongType(), "Guests": T.DoubleType(), "At": T.TimestampType()},
    required=["Id", "Place"],
)


def part(spark, root, name, select):
    path = str(root / name)
    spark.sql(select).coalesce(1).write.parquet(path)
    return path


VARIANTS = {
    "a": "1 as Id, 2 as Place, 3D as Guests, timestamp'2024-01-01' as At",
    "b": "2L as Id, 2L as Place, 4L as Guests, timestamp_ntz'2024-01-02' as At",
    "c": "3L as ID, 2L as PLACE, 5L as GUESTS, timestamp'2024-01-03' as AT, 'x' as more",
    "d": "4L as Id, 2L as Place, timestamp'2024-01-04' as At",
}


@pytest.fixture
def drifting(spark, tmp_path):
    for name, columns in VARIANTS.items():
        part(spark, tmp_path, name, f"select {columns}")
    return tmp_path


def test_drifting_files_read_as_one_table(spark, drifting):
    df = tables.read_normalized(spark, str(drifting / "*"), SMALL)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.type) for f in SMALL.fields]
    got = df.select("Id", "Place", "Guests", F.dayofmonth("At")).orderBy("Id").collect()
    assert list(map(tuple, got)) == [
        (1, 2, 3.0, 1), (2, 2, 4.0, 2), (3, 2, 5.0, 3), (4, 2, None, 4)
    ]


def test_files_stored_alike_share_a_scan(spark, drifting):
    for i in range(5):
        part(spark, drifting, f"more{i}", f"select {VARIANTS['b']}")
    df = tables.read_normalized(spark, str(drifting / "*"), SMALL)
    assert df.count() == 9
    assert formatted(df).split("(1) Scan")[0].count("Scan parquet") == 4


def test_filters_and_columns_reach_every_scan(spark, drifting):
    df = tables.read_normalized(spark, str(drifting / "*"), SMALL).filter("Place > 1").select("Id")
    plan = formatted(df)
    assert plan.count("PushedFilters: [IsNotNull(") == 4
    for line in plan.splitlines():
        if line.startswith("ReadSchema"):
            assert "uests" not in line.lower() and ":timestamp" not in line


def test_a_required_column_missing_from_one_file_is_an_error(spark, drifting):
    part(spark, drifting, "e", "select 5L as Id")
    with pytest.raises(ContractError, match=r"/e/part-.*'Place'"):
        tables.read_normalized(spark, str(drifting / "*"), SMALL)


def test_names_clashing_by_case_are_an_error(spark, drifting):
    import pyarrow as pa
    import pyarrow.parquet as pq

    clash = pa.table({"Id": [1], "Place": [1], "Airport_fee": [1.0], "airport_fee": [1.0]})
    pq.write_table(clash, drifting / "clash.parquet")
    with pytest.raises(ContractError, match=r"clash.parquet.*'Airport_fee' and 'airport_fee'"):
        tables.read_normalized(spark, [str(drifting / "*"), str(drifting / "clash.parquet")], SMALL)


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(files.NoInputError, match="no files"):
        tables.read_normalized(spark, str(tmp_path))
    with pytest.raises(files.NoInputError):
        files.list_files(spark, [])
    with pytest.raises(ValueError, match="nothing"):
        tables.union_by_name([])


def test_listing_is_sorted_and_goes_deep_whatever_the_names(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    for name in ("b.parquet", "a b.parquet", "x/y/c.parq", "x/d", "_SUCCESS", ".hidden"):
        (tmp_path / name).write_bytes(b"")
    found = files.list_files(spark, str(tmp_path))
    assert [f.split(tmp_path.name + "/")[1] for f in found] == ["a b.parquet", "b.parquet", "x/d", "x/y/c.parq"]


def rows_of(df):
    return sorted(map(tuple, df.select("Id", "Place", "Guests").collect()))


@pytest.mark.parametrize("column", ["Guests", "Place"])
def test_columns_in_folder_names_are_read(spark, tmp_path, column):
    df = spark.sql("select id as Id, id % 3 as Place, cast(id % 2 as double) as Guests from range(30)")
    df.write.partitionBy(column).parquet(str(tmp_path / "t"))
    df.write.parquet(str(tmp_path / "u"))
    got = tables.read_normalized(spark, str(tmp_path), SMALL)
    assert rows_of(got) == sorted(rows_of(df) * 2)
    assert rows_of(got) == sorted(rows_of(spark.read.parquet(str(tmp_path / "t"))) * 2)


def test_names_with_pattern_characters_are_read(spark, tmp_path):
    part(spark, tmp_path, "m[1]{a,b}", "select 1L as Id, 2L as Place")
    (tmp_path / "deep").mkdir()
    (source,) = (tmp_path / "m[1]{a,b}").glob("*.parquet")
    (tmp_path / "deep" / "x[2].parq").write_bytes(source.read_bytes())
    assert tables.read_normalized(spark, str(tmp_path), SMALL).count() == 2


def test_a_file_that_is_no_parquet_is_an_error(spark, drifting):
    (drifting / "notes.txt").write_text("no parquet")
    with pytest.raises(files.NotParquetError, match="notes.txt"):
        tables.read_normalized(spark, str(drifting), SMALL)


def test_paths_with_spaces_are_read(spark, tmp_path):
    part(spark, tmp_path, "jan uary", "select 1L as Id, 2L as Place")
    assert tables.read_normalized(spark, str(tmp_path / "jan uary"), SMALL).count() == 1


def test_footers_out_of_reach_are_left_to_spark(spark, drifting, monkeypatch):
    import inspect

    before = tables.read_normalized(spark, str(drifting / "*"), SMALL).orderBy("Id").collect()
    out_of_reach = inspect.getsource(files.manifest).replace('scheme == "file"', 'scheme == "none"')
    out_of_reach = out_of_reach.replace("fs.FileSystem.from_uri(path)", "open('/none')")
    space = dict(vars(files))
    exec("from __future__ import annotations\n" + out_of_reach, space)
    monkeypatch.setattr(tables, "manifest", space["manifest"])
    after = tables.read_normalized(spark, str(drifting / "*"), SMALL).orderBy("Id").collect()
    assert before == after


def test_other_columns_make_no_layout_of_their_own(spark, tmp_path):
    part(spark, tmp_path, "few", "select 1L as Id, 2L as Place")
    more = ", ".join(f"{k} as extra{k}" for k in range(300))
    part(spark, tmp_path, "many", f"select 1L as Id, 2L as Place, {more}")
    manifest = files.manifest(spark, str(tmp_path), SMALL.names, SMALL.required)
    assert manifest.count() == 2 and [r.files for r in files.layout_runs(manifest)] == [2]


def side_by_side(spark, root, kinds):
    """One file per kind (how Guests is stored), named in order, in one folder."""
    root.mkdir()
    for k, kind in enumerate(kinds):
        path = part(spark, root, f"../made{k}", f"select {k}L as Id, {k % 5}L as Place, cast({k} as {kind}) as Guests")
        (file,) = (root.parent / f"made{k}").glob("*.parquet")
        file.rename(root / f"{k:03}.parquet")
        assert path
    return str(root)


def test_layouts_side_by_side_are_told_apart_by_ranges_of_names(spark, tmp_path, monkeypatch):
    """Types that cannot be read as one another: a file in the wrong scan would be an error."""
    kinds = ["int", "int", "double", "string", "string", "int", "double", "double", "string"]
    folder = side_by_side(spark, tmp_path / "mixed", kinds)
    want = [(k, k % 5, float(k)) for k in range(len(kinds))]
    df = tables.read_normalized(spark, folder, SMALL)
    assert rows_of(df) == want
    assert formatted(df).split("(1) Scan")[0].count("Scan parquet") == 3
    assert rows_of(df.filter("Place = 1 and Guests > 1")) == [(6, 1, 6.0)]
    monkeypatch.setattr(tables, "RANGES_PER_SCAN", 1)
    assert rows_of(tables.read_normalized(spark, folder, SMALL)) == want


def test_only_the_files_asked_for_are_read(spark, tmp_path):
    side_by_side(spark, tmp_path / "mixed", ["int", "int", "double", "double"])
    df = tables.read_normalized(spark, [f"{tmp_path}/mixed/000.parquet", f"{tmp_path}/mixed/00[23].parquet"], SMALL)
    assert [r[0] for r in rows_of(df)] == [0, 2, 3]


def test_values_in_folder_names_keep_their_characters(spark, tmp_path):
    places = Contract.of({"Id": T.LongType(), "Name": T.StringType()}, required=["Id", "Name"])
    names = ["a b", "c+d", "e%f", "g/h", "i=j", "007", "ü", None]
    df = spark.createDataFrame(list(enumerate(names)), "Id long, Name string")
    df.write.partitionBy("Name").parquet(str(tmp_path / "t"))
    got = tables.read_normalized(spark, str(tmp_path / "t"), places)
    assert dict(map(tuple, got.collect())) == dict(enumerate(names))


def test_a_hundred_thousand_files_bring_a_few_rows_to_the_driver(spark, tmp_path, monkeypatch):
    """Names, layouts and faults stay in Spark: the driver gets a row per change of layout."""
    import os

    from pyspark.sql import DataFrame

    for k, kind in enumerate(("bigint", "double")):
        path = part(spark, tmp_path, f"one{k}", f"select 1L as Id, 2L as Place, cast(1 as {kind}) as Guests")
        (source,) = (tmp_path / f"one{k}").glob("*.parquet")
        for folder in range(10):
            own = tmp_path / "many" / f"{k}" / f"f{folder}"
            own.mkdir(parents=True)
            for n in range(5000):
                os.link(source, own / f"{n}.parquet")
        assert path
    brought = []
    for name in ("collect", "toLocalIterator"):
        plain = getattr(DataFrame, name)

        def counted(self, *args, plain=plain, **more):
            rows = list(plain(self, *args, **more))
            brought.append(len(rows))
            return iter(rows) if plain.__name__ == "toLocalIterator" else rows

        monkeypatch.setattr(DataFrame, name, counted)
    df = tables.read_normalized(spark, str(tmp_path / "many"), SMALL)
    assert sum(brought) <= 2 + 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.undo()
    assert formatted(df).split("(1) Scan")[0].count("Scan parquet") == 2
    assert "file_path" not in formatted(df)


def test_union_refuses_a_part_that_lacks_a_column(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        tables.union_by_name([spark.sql("select 1 as a, 2 as b"), spark.sql("select 1 as a")])


def test_zone_text(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"EWR","Newark, NJ","EWR"\n264,"N/A","NV",N/A\n265,,"",N/A\nx,"Q","z","z"\n'
    )
    df = tables.read_zones(spark, str(tmp_path / "zones.csv"))
    assert df.schema["LocationID"].dataType == T.LongType()
    got = sorted(map(tuple, df.collect()), key=repr)
    assert got == sorted(
        [(1, "EWR", "Newark, NJ"), (264, "N/A", "NV"), (265, None, None), (None, "Q", "z")],
        key=repr,
    )
    named = tables.read_zones(spark, str(tmp_path / "zones.csv"), null_text="N/A")
    assert named.filter("LocationID = 264").head().Borough is None


def test_zone_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("Zone,borough,LOCATIONID\nz,b,7\n")
    assert tuple(tables.read_zones(spark, str(tmp_path / "zones.csv")).head()) == (7, "b", "z")
    (tmp_path / "short.csv").write_text("Zone,LocationID\nz,7\n")
    with pytest.raises(ContractError, match=r"short.csv.*Borough"):
        tables.read_zones(spark, str(tmp_path / "short.csv"))


def test_source_volume_counts_files_bytes_and_rows(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(100).repartition(3).write.parquet(str(path))
    row = files.source_volume(spark, {"t": str(path)}).head()
    size = sum(f.stat().st_size for f in path.glob("*.parquet"))
    assert (row.table_name, row.files, row.bytes, row.row_count) == ("t", 3, size, 100)
    assert "ReadSchema: struct<>" in formatted(files.source_volume(spark, {"t": str(path)}))
    with pytest.raises(files.NoInputError):
        files.source_volume(spark, {})


def test_metrics_documents_in_both_layouts(spark, tmp_path):
    (tmp_path / "one.json").write_text(
        '{\n "framework": "a",\n "agg_rows": 3,\n'
        ' "phases": {\n  "join_s": 1.5,\n  "total_s": 9\n }\n}'
    )
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.json").write_text(
        '{"run_id": "r1", "framework": "b", "phases": {"join_s": 2.0}}\n'
        '{"run_id": "r2", "framework": "b", "phases": {"join_s": 4.0}}\n'
    )
    (one,) = records.read_run_metrics(spark, str(tmp_path / "one.json")).collect()
    assert (one.framework, one.agg_rows, one.phases) == ("a", 3, {"join_s": 1.5, "total_s": 9.0})
    assert one.run_id.endswith("one.json") and one.input_rows is None
    many = records.read_run_metrics(spark, str(tmp_path / "lines")).collect()
    assert sorted((m.run_id, m.phases["join_s"]) for m in many) == [("r1", 2.0), ("r2", 4.0)]
    (tmp_path / "lines" / "y.json").write_text('{\n "framework": "c",\n "row_groups": 7\n}\n')
    mixed = {m.framework: m for m in records.read_run_metrics(spark, str(tmp_path / "lines")).collect()}
    assert len(mixed) == 2 and mixed["c"].extra == {"row_groups": "7"} and mixed["b"].extra == {}


def test_a_large_file_of_documents_is_read_in_many_tasks(spark, tmp_path):
    """Beside it a file that is one document over many lines, and a blank one."""
    line = '{"run_id": "r%d", "framework": "x", "input_rows": %d, "note": "' + "n" * 400 + '"}\n'
    with open(tmp_path / "many.json", "w") as out:
        out.write("\n  \n")
        out.writelines(line % (k, k) for k in range(40_000))
    (tmp_path / "one.json").write_text('\r\n{\r\n "run_id": "alone",\n\n "input_rows":\n 7\n}\n')
    (tmp_path / "blank.json").write_text(" \n\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = records.read_run_metrics(spark, str(tmp_path))
        tasks = df.filter("run_id <> 'alone'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 40_000
        assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 12_000
        assert df.agg(F.sum("input_rows")).head()[0] == sum(range(40_000)) + 7
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_malformed_metrics_document_is_an_error(spark, tmp_path):
    from pyspark.errors import PySparkException

    (tmp_path / "bad.json").write_text('{\n "framework": "a",\n')
    with pytest.raises(PySparkException, match="malformed metrics document"):
        records.read_run_metrics(spark, str(tmp_path / "bad.json")).select("framework").collect()


def test_log_paths_come_as_they_are_named(spark, tmp_path):
    (tmp_path / "top_run one+%41.log").write_text("[t] x")
    assert records.read_log_lines(spark, str(tmp_path)).head().path.endswith("/top_run one+%41.log")


def test_the_trip_contract_is_complete():
    assert len(TRIPS.names) == 10 and len(TRIPS.required) == 5
