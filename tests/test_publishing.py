"""Tables that are replaced as a whole: failures between all stages leave the version before."""

import pytest
from pyspark.sql import functions as F

from connlens.sources import expire, publish, published, publishing


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_rerun_replaces(spark, tmp_path):
    path = f"{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        published(spark, path)
    for version in (1, 2):
        df = spark.range(100 * version).selectExpr("id", "id % 3 AS part", "'x y=/%' AS odd")
        assert publish(df, path, ["part", "odd"]) == version
        again = published(spark, path)
        assert again.schema.names == df.schema.names and rows(again) == rows(df)
    assert published(spark, path, 1).count() == 100


def test_a_failing_task_leaves_the_version_before(spark, tmp_path):
    path = f"{tmp_path}/table"
    publish(spark.range(10), path)
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert published(spark, path).count() == 10


@pytest.mark.parametrize("stage", ["files", "write", "rename"])
def test_a_writer_killed_between_stages(spark, tmp_path, monkeypatch, stage):
    path = f"{tmp_path}/table"
    publish(spark.range(10), path)
    reader = published(spark, path)

    class Killed(BaseException):
        pass

    def die(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(publishing._Folder, stage, die)
        with pytest.raises(Killed):
            publish(spark.range(20), path)
    assert published(spark, path).count() == reader.count() == 10
    assert publish(spark.range(20), path) == 2
    assert published(spark, path).count() == 20 and reader.count() == 10


def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/table"
    publish(spark.range(1), path)
    real, calls = publishing._versions, []

    def late(folder):
        calls.append(1)
        return [] if len(calls) == 1 else real(folder)  # the other writer has committed meanwhile

    with monkeypatch.context() as patch:
        patch.setattr(publishing, "_versions", late)
        assert publish(spark.range(2), path) == 2
    assert published(spark, path, 1).count() == 1 and published(spark, path).count() == 2


def test_empty_tables_and_expiry(spark, tmp_path):
    path = f"{tmp_path}/table"
    empty = spark.range(5).filter("id < 0").selectExpr("id", "id % 2 AS part")
    publish(empty, path, ["part"])
    assert published(spark, path).schema.names == ["id", "part"] and published(spark, path).count() == 0
    for n in (1, 2, 3):
        publish(spark.range(n), path)
    spark.range(9).write.parquet(f"{path}/data-left-by-a-killed-writer")
    assert expire(spark, path, keep=2) == 2  # the unlisted folder is too young
    assert published(spark, path).count() == 3 and published(spark, path, 3).count() == 2
    assert expire(spark, path, keep=2, hours=0.0) == 1
    assert published(spark, path).count() == 3
