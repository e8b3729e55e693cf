"""What the planner makes of the operators."""

from pyspark.sql import functions as F

from checks.views import Inputs
from shelfwright.functions import fields
from shelfwright.operators import joins, paging, ranking
from shelfwright.plans import final, maintain
from shelfwright.session import materialise, scratch_dir
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Plan after adaptive execution."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(ranking.with_position(Inputs(spark, SMALL).feed.select("ord", "category"), "ord", ["category"]))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    assert "p_name" not in plan and "p_retailprice" not in plan


def test_page_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "captures")
    spark.range(50).select(F.col("id").cast("int").alias("page"), F.lit("x").alias("payload")).write.parquet(path)
    plan = plan_of(paging.page_range(spark.read.parquet(path), skip=10, limit=5))
    assert "GreaterThanOrEqual(page,11)" in plan and "LessThanOrEqual(page,15)" in plan


def test_category_prunes_partitions(spark, tmp_path):
    from shelfwright.sources.stage_files import read_table, write_stage
    path = str(tmp_path / "t")
    write_stage(Inputs(spark, SMALL).feed, path, ["id", "category"], fmt="parquet", by_category=True)
    plan = plan_of(read_table(spark, path, ["id", "category"], category="cat3"))
    assert "PartitionFilters: [isnotnull(category" in plan and "= cat3" in plan


def test_no_cross_joins_and_no_python_in_relational_plans(spark):
    v = Inputs(spark, SMALL)
    for df in (
        final.build_final(v.shelf, v.shelf_mapping), maintain.renumber(v.feed, v.mapping)[0],
        final.inserted_documents(final.documents(v.import_rows), v.target), maintain.sync_listing(v.listing, v.mapping),
    ):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_positions_sort_no_scope_in_one_window(spark):
    plan = plan_of(ranking.with_position(Inputs(spark, SMALL).feed.select("ord", "category"), "ord", ["category"]))
    row_numbers = [line for line in plan.splitlines() if "row_number()" in line]
    assert row_numbers and all("_chunk" in line for line in row_numbers)


def test_hot_lookup_key_is_split(spark, tmp_path):
    """A key with a third of the rows is read by several join tasks."""
    path = str(tmp_path / "left")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    left = spark.range(300000).select(F.col("id").alias("ord"), key.alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
    left.repartition(16).write.parquet(path)
    left = spark.read.parquet(path)
    right = left.select("k").distinct().withColumn("v", F.length("k"))
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        joined = joins.lookup(left, right, [("k", "k")], fields.present("k"), "ord", "found")
        assert "skew=true" in final_plan(joined.select("ord", "found.v"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_blank_keys_do_not_meet_in_one_partition(spark):
    left = spark.range(8000).select(F.col("id").alias("ord"), F.lit("").alias("k"))
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.lookup(left, right, [("k", "k")], fields.present("k"), "ord", "found")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 8000 / 8


def test_scratch_tables_lie_in_the_checkpoint_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    df = materialise(spark.range(3).toDF("id"), "test")
    assert all(scratch_dir(spark) in f for f in df.inputFiles())
    if configured:
        assert scratch_dir(spark).startswith(configured.rstrip("/"))
