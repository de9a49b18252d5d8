import os

import pytest
from pyspark.sql import functions as F

from sparkloom.dataset import Dataset
from sparkloom.errors import ValidationError
from sparkloom.sources import files

from conftest import SF_SMALL


def test_create_dataset_default_schema(spark):
    ds = files.create_dataset(spark, "new")
    assert ds.df.count() == 0
    assert [f.name for f in ds.df.schema.fields] == ["id", "image_data", "metadata", "timestamp"]
    assert not ds.df.schema["id"].nullable


def test_save_load_roundtrip_with_metadata(spark, tmp_out):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    path = os.path.join(tmp_out, "nation_out")
    ds = Dataset(src, "nation", {"owner": "tests", "rows": 25})
    files.save_dataset(files.filter_dataset(ds, "n_regionkey = 1"), path)
    back = files.load_dataset(spark, path)
    assert back.name == "nation_out"
    assert back.metadata == {"owner": "tests", "rows": 25}
    assert back.df.count() == src.filter("n_regionkey = 1").count()


def test_save_modes(spark, tmp_out):
    src = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    path = os.path.join(tmp_out, "modes")
    files.save_dataset(src, path, mode="error")
    with pytest.raises(Exception):
        files.save_dataset(src, path, mode="error")
    files.save_dataset(src, path, mode="ignore")
    assert spark.read.parquet(path).count() == 5
    files.save_dataset(src, path, mode="append")
    assert spark.read.parquet(path).count() == 10
    files.save_dataset(src, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValidationError):
        files.save_dataset(src, path, mode="sometimes")


def test_csv_roundtrip(spark, tmp_out):
    src = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    path = os.path.join(tmp_out, "csv")
    files.save_dataset(src, path, "csv", options={"header": "true"})
    back = files.load_csv(spark, path, schema=src.schema)
    assert sorted(back.collect()) == sorted(src.collect())


def test_delta_without_provider_is_a_clear_error(spark, tmp_out):
    with pytest.raises(ValidationError, match="not available"):
        files.load_dataset(spark, tmp_out, "delta")
    with pytest.raises(ValidationError):
        files.load_dataset(spark, tmp_out, "xml")


def test_read_table_forms(spark):
    spark.read.parquet(f"{SF_SMALL}/region.parquet").createOrReplaceTempView("region_view")
    assert files.read_table(spark, "region_view").count() == 5
    assert files.read_table(spark, f"parquet.`{SF_SMALL}/region.parquet`").count() == 5


def test_parse_json_column(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = files.parse_json_column(ev, "props", "k int", into="meta")
    assert out.filter(F.col("meta.k").isNull()).count() == 0


def test_sidecar_follows_the_data(spark, tmp_out):
    src = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    path = os.path.join(tmp_out, "followed")
    files.save_dataset(Dataset(src, "a", {"v": 1}), path)
    files.save_dataset(Dataset(src, "b", {"v": 2}), path, mode="ignore")
    assert files.read_metadata(spark, path) == {"v": 1}
    files.save_dataset(src, path)
    assert files.read_metadata(spark, path) == {}
