import re
import uuid

from pyspark.sql import functions as F

from punctual.plans import lookup
from punctual.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_id_reads_one_bucket(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.range(20_000).select((F.col("id") * 7).alias("leg_id"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    stored = files.write_for_lookup(df, name, str(tmp_path / "t"), "leg_id", 16)
    try:
        assert stored.count() == 20_000
        found = lookup.by_id(stored, 7 * 4711)
        assert "SelectedBucketsCount: 1 out of 16" in plan(found)
        assert [tuple(row) for row in found.collect()] == [(7 * 4711, "v4711")]
        assert lookup.by_id(stored, 5).count() == 0
        read = found.select(F.input_file_name()).distinct().count()
        assert read == 1 and len(list((tmp_path / "t").glob("*.parquet"))) == 16
        counts = [row["count"] for row in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
        assert max(counts) < 20_000 / 8
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_join_by_key_moves_no_row_of_the_table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    df = spark.range(5000).select(F.col("id").alias("leg_id"), (F.col("id") % 9).alias("v"))
    stored = files.write_for_lookup(df, name, str(tmp_path / "t"), "leg_id", 8)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        ids = spark.range(0, 5000, 11).withColumnRenamed("id", "leg_id").repartition(3)
        found = lookup.by_ids(stored, ids)
        text = plan(found)
        assert len(re.findall("FileScan", text)) == 1 and "SortMergeJoin" in text
        # From the join to the scan of the table there is no exchange; the ids have theirs.
        table_side = text[text.index("SortMergeJoin") :].split("FileScan")[0]
        assert "Exchange" not in table_side
        assert found.count() == len(range(0, 5000, 11))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.sql(f"DROP TABLE {name}")
