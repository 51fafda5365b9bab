import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.cells import range_bucket, range_sorted, row_range, scan_cells, split_points, to_cells
from millrace.session import session_conf
from millrace.sinks import write_sink

W = [("r1", "a", "", "c1"), ("r2", None, "b", None), ("r3", None, None, ""), ("r4", "d", "e", "f")]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(W, ["row_key", "cf1:a", "cf2:B", "c"])


def test_cells(wide):
    assert rows(to_cells(wide)) == [
        ("r1", "cf1", "a", "a"),
        ("r1", "cf1", "c", "c1"),
        ("r2", "cf2", "B", "b"),
        ("r4", "cf1", "a", "d"),
        ("r4", "cf1", "c", "f"),
        ("r4", "cf2", "B", "e"),
    ]


def test_cells_of_other_types(spark):
    df = spark.createDataFrame([(1, 2.5, True)], "row_key int, `f:x` double, y boolean")
    assert rows(to_cells(df)) == [("1", "cf1", "y", "true"), ("1", "f", "x", "2.5")]


def test_row_key_is_required(spark):
    with pytest.raises(ValueError, match="row_key"):
        to_cells(spark.range(1))
    with pytest.raises(ValueError, match="family:qualifier"):
        to_cells(spark.createDataFrame([("a", 1)], ["row_key", "cf:"]))


def test_scan(wide):
    cells = to_cells(wide)
    assert rows(scan_cells(cells, "cf2:b,cf1:A")) == [("r1", "", "a"), ("r2", "b", ""), ("r4", "e", "d")]
    assert rows(scan_cells(cells, "cf2:b", "r1", "r4")) == [("r2", "b")]
    assert scan_cells(cells, "c", "r2").columns == ["row_key", "c"]
    assert rows(scan_cells(cells, "c", "r2")) == [("r4", "f")]
    with pytest.raises(ValueError):
        scan_cells(cells, "")


def test_row_range():
    assert row_range("0,1") == ("0", "1")
    assert row_range("0") == ("0", None)
    with pytest.raises(ValueError):
        row_range(" ")


@pytest.mark.parametrize("splits", [[], ["m"], ["b", "d", "f", "h"], [f"{i:03d}" for i in range(500)]])
def test_range_bucket(spark, splits):
    keys = ["", "a", "b", "bb", "c", "h", "z", "0005", "250", "499", "5"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    found = df.select("k", range_bucket(F.col("k"), splits).alias("n")).collect()
    assert {r["k"]: r["n"] for r in found} == {k: sum(s <= k for s in splits) for k in keys}


def test_range_sorted(spark):
    """Every partition is sorted and the hot range is spread over several."""
    df = spark.range(4000).selectExpr("if(id % 3 = 0, 'k500', concat('k', lpad(id % 1000, 3, '0'))) as row_key", "id")
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = range_sorted(df, ["k200", "k500", "k501"], then_by=["id"])
        parts = out.select(F.spark_partition_id().alias("p"), "range_bucket", "row_key", "id").collect()
    by_part = {}
    for r in parts:
        by_part.setdefault(r["p"], []).append(tuple(r)[1:])
    assert all(rows_ == sorted(rows_) for rows_ in by_part.values())
    assert len(parts) == 4000
    hot = {p for p, rows_ in by_part.items() if any(r[0] == 2 for r in rows_)}
    assert len(hot) > 1


def rows_scanned(df):
    """Rows the file scan of a frame handed on, from the metrics of its plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan).collectLeaves()
    scan = leaves.head()
    if "Stage" in scan.getClass().getName():
        scan = scan.plan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_split_points_balance_a_skewed_key(spark):
    frame = spark.range(8000).selectExpr("concat('row-', if(id % 4 = 0, lpad(id, 8, '0'), concat('7777', lpad(id, 6, '0')))) as row_key")
    points = split_points(frame, 8)
    assert len(points) == 7 and points == sorted(points)
    sizes = [r.n for r in range_sorted(frame, points).groupBy("range_bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * 1000
    mixed = spark.range(8000).selectExpr("concat(char(33 + id % 90), sha2(string(id), 256)) as row_key")
    sizes = [r.n for r in range_sorted(mixed, split_points(mixed, 8)).groupBy("range_bucket").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * 1000
    hot = spark.range(900).selectExpr("if(id < 800, 'é', concat('z', id)) as row_key")
    assert len(split_points(hot, 5)) <= 4
    for few in (frame.limit(0), frame.where("row_key is null"), frame.limit(1)):
        assert split_points(few, 5) == []


def test_scans_skip_row_groups(spark, folder):
    wide = spark.range(20_000).selectExpr("lpad(id * 7919 % 20000, 6, '0') as row_key", "cast(id as string) as `cf1:v`")
    base = {"paths": f"{folder}/sorted", "fileType": "parquet", "parquet.block.size": "20000"}
    write_sink(wide, {"type": "hbase", "options": {**base, "write_mode": "hfile", "splits": "auto:4"}})
    sorted_cells = spark.read.parquet(f"{folder}/sorted")
    found = scan_cells(sorted_cells, "cf1:v", "001000", "001010")
    assert found.count() == 10 and rows_scanned(sorted_cells.where("row_key >= '001000' and row_key < '001010'")) < 15_000
    write_sink(wide.repartition(8), {"type": "hbase", "options": {**base, "paths": f"{folder}/dealt"}})
    dealt = spark.read.parquet(f"{folder}/dealt")
    assert [r.row_key for r in scan_cells(dealt, "cf1:v", keys=["001003"]).collect()] == ["001003"]
    assert rows_scanned(dealt.where("row_key in ('001003')")) < 10_000
