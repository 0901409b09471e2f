import pytest
from pyspark.sql import functions as F

from promptloom.operators import positions
from promptloom.operators.merge import merge_completions
from promptloom.operators.positions import number_by_key, number_by_scan


@pytest.mark.parametrize("buckets", [1, 2, 5, 16])
@pytest.mark.parametrize("key", ["id", "-id", "cast(pow(id, 3) as bigint)", "cast(id as double) / 7"])
def test_numbers_follow_the_key(spark, buckets, key):
    df = spark.range(1000, numPartitions=6).select(F.expr(key).alias("k"), "id").repartition(5)
    got = number_by_key(df, "k", buckets).orderBy("k").collect()
    assert [r.row_id for r in got] == list(range(1000))


def test_numbering_spreads_rows_evenly(spark):
    # A third of the keys are close together; ranges follow the quantiles, not the values.
    df = spark.range(9000).select(F.expr("if(id < 3000, id, id * 1000000)").alias("k"))
    bounds = sorted(df.agg(F.percentile_approx("k", [i / 8 for i in range(1, 8)], F.lit(800))).first()[0])
    sizes = [r["count"] for r in df.groupBy(positions._range_of(F.col("k"), bounds)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 9000 / 8


def test_numbering_of_nothing(spark):
    assert number_by_key(spark.range(0), "id").collect() == []


def write_files(spark, folder, rows_per_file):
    start = 0
    for i, rows in enumerate(rows_per_file):
        spark.range(start, start + rows, numPartitions=1).write.parquet(f"{folder}/{i:03d}")
        start += rows
    return spark.read.option("recursiveFileLookup", True).parquet(str(folder))


@pytest.mark.parametrize("broadcast_limit", [1 << 20, 0])
def test_scan_order_over_files(spark, tmp_path, monkeypatch, broadcast_limit):
    monkeypatch.setattr(positions, "MAX_BROADCAST_BYTES", broadcast_limit)
    df = write_files(spark, tmp_path, [3, 1000, 1, 50, 7])
    got = number_by_scan(df).collect()
    assert sorted((r.id, r.row_id) for r in got) == [(i, i) for i in range(1061)]


def test_scan_order_over_splits_of_one_file(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20000, numPartitions=1).select(F.format_string("row %08d", "id").alias("value")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = spark.read.text(path)
        assert df.rdd.getNumPartitions() > 5
        got = number_by_scan(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r.value == f"row {r.row_id:08d}" for r in got) and len(got) == 20000


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_other_formats_are_numbered_in_the_jvm(spark, tmp_path, kind):
    df = spark.range(5000).select("id", F.format_string("row %05d", "id").alias("value"))
    for start in (0, 2000):
        part = df.filter((F.col("id") >= start) & (F.col("id") < start + (2000 if not start else 3000)))
        part.coalesce(1).write.format(kind).save(str(tmp_path / f"{start:05d}"))
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "9000"}
    before = {name: spark.conf.get(name) for name in settings}
    reader = spark.read.schema("id bigint, value string").option("recursiveFileLookup", True).format(kind)
    found = []
    for bytes_of_a_split in ("9000", "40000"):
        for name, value in (settings | {"spark.sql.files.maxPartitionBytes": bytes_of_a_split}).items():
            spark.conf.set(name, value)
        try:
            numbered = number_by_scan(reader.load(str(tmp_path)))
            plan = numbered._jdf.queryExecution().executedPlan().toString()
            found.append(sorted((r.id, r.row_id) for r in numbered.collect()))
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)
        assert "Python" not in plan and "ExistingRDD" not in plan
    assert found[0] == found[1] == [(i, i) for i in range(5000)]


def test_rows_without_files(spark):
    numbered = number_by_scan(spark.range(0, 1000, numPartitions=7)).collect()
    assert [(r.id, r.row_id) for r in sorted(numbered)] == [(i, i) for i in range(1000)]


@pytest.mark.parametrize("kind", ["parquet", "text"])
@pytest.mark.parametrize("before, after", [("2", "32"), ("32", "2")])
def test_numbers_do_not_depend_on_the_splits(spark, tmp_path, kind, before, after):
    path, size = str(tmp_path / "rows"), 300_000
    made = spark.range(size, numPartitions=1).select(F.format_string("row %08d", "id").alias("value"))
    (made.write.option("parquet.block.size", 200_000).parquet(path) if kind == "parquet" else made.write.text(path))
    settings = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(settings[1], "1")
        spark.conf.set(settings[0], before)
        numbered = number_by_scan(spark.read.format(kind).load(path))
        spark.conf.set(settings[0], after)
        wrong = numbered.filter(F.col("value") != F.format_string("row %08d", "row_id"))
        assert (numbered.count(), wrong.count()) == (size, 0)
    finally:
        for name in settings:
            spark.conf.unset(name)


@pytest.fixture
def completions(spark):
    return spark.range(10).select(F.col("id").alias("row_id"), F.format_string("c%d", "id").alias("completion"))


def test_merge_by_position(spark, completions, tmp_path):
    data = spark.range(0, 100, 10).withColumn("inference", F.lit("old")).withColumn("other", F.lit(1))
    merged = merge_completions(data.repartition(4), completions, key="id")
    assert merged.columns == data.columns
    assert {r.id: r.inference for r in merged.collect()} == {i * 10: f"c{i}" for i in range(10)}
    data.coalesce(1).write.parquet(str(tmp_path / "d"))
    scanned = merge_completions(spark.read.parquet(str(tmp_path / "d")), completions, output_column="answer")
    assert scanned.columns == [*data.columns, "answer"]
    assert {r.id: r.answer for r in scanned.collect()} == {i * 10: f"c{i}" for i in range(10)}


@pytest.mark.parametrize("n", [9, 11])
def test_wrong_number_keeps_only_the_completions(spark, completions, n, caplog):
    merged = merge_completions(spark.range(n), completions, key="id")
    assert merged.columns == ["inference"]
    assert sorted(r[0] for r in merged.collect()) == sorted(f"c{i}" for i in range(10))
    assert f"10 completions for {n} rows" in caplog.text


def test_completions_must_be_a_table(spark):
    with pytest.raises(TypeError):
        merge_completions(spark.range(1), ["x"], key="id")
