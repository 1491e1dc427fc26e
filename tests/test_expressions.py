"""Name, path, format and status expressions over columns of inputs."""

import pytest
from pyspark.sql import functions as F

from metaspark.functions import names, paths, status
from metaspark.functions.text import allowed, job_name, snake_case


def apply(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_first_extension(spark):
    given = ["s3://bucket/folder/file.csv", "s3://bucket/folder/file.csv.tar", "s3://bucket/folder/file"]
    assert apply(spark, paths.first_extension, given) == ["csv", "csv", None]


def test_first_dot_format_differs_from_suffix_format(spark):
    given = ["file.csv", "file.csv.tar", "file.tsv.tar", "part.snappy.parquet", "file"]
    first = apply(spark, lambda c: paths.file_format(c, "first_dot"), given)
    assert first == ["csv", "csv", "tsv", "snappy", None]
    assert apply(spark, paths.file_format, given) == ["csv", "tar", "tar", "parquet", None]
    with pytest.raises(ValueError):
        paths.file_format(F.col("v"), "other")


@pytest.mark.parametrize("folder", ["", "very/long/path/to/"])
@pytest.mark.parametrize(
    "ending,expected",
    [("csv", "csv"), ("csv.gz", "csv"), ("csv.bz2", "csv"), ("tsv", "tsv"), ("tsv.gz", "tsv"), ("tsv.bz2", "tsv"),
     ("parquet", "parquet"), ("snappy.parquet", "parquet"), ("csv.zip", None), ("txt", None)],
)
def test_suffix_format(spark, folder, ending, expected):
    assert apply(spark, paths.suffix_format, [f"{folder}file.with.dots.in.name.{ending}"]) == [expected]


def test_all_suffixes(spark):
    given = ["file.csv", "/path/to/file.csv.gz", "noext", ".hidden", "trailing.", "a.b.c", "dir.x/plain", "..a.b"]
    assert apply(spark, paths.all_suffixes, given) == [".csv", ".csv.gz", "", "", "", ".b.c", "", ".b"]


def test_object_name(spark):
    given = ["bucket/path/to/file.csv", "bucket/path/to/", "/my-b.1_x/k", "only", "bu cket/a/b"]
    expected = ["path\\\\to\\\\file.csv", "path\\\\to", "k", "only", "a\\\\b"]
    assert apply(spark, paths.object_name, given) == expected


def test_url_parts(spark):
    given = ["s3://b/k/x.csv?versionId=1#f", "s3a://b", "s3n://b//k", "https://h.example/en/1/"]
    assert apply(spark, paths.url_bucket, given) == ["b", "b", "b", "h.example"]
    assert apply(spark, paths.url_key, given) == ["k/x.csv", "", "k", "en/1/"]
    assert apply(spark, paths.strip_protocol, ["s3://b/k", "s3a://b/k", "s3n://b/k", "gs://b/k", "b/k"]) == [
        "b/k", "b/k", "b/k", "gs://b/k", "b/k",
    ]


def test_join_prefix(spark):
    df = spark.createDataFrame([("/b/", "/p/q/"), ("b", ""), ("b", None)], "b string, p string")
    got = [r[0] for r in df.select(paths.join_prefix(F.col("b"), F.col("p"))).collect()]
    assert got == ["b/p/q", "b", "b"]


def test_prefixes_and_parent(spark):
    assert apply(spark, paths.prefixes, ["a/b/c", "a", "a/b"]) == [["a", "a/b"], [], ["a"]]
    assert apply(spark, paths.parent_path, ["a/b/c", "a"]) == ["a/b", None]


def test_arn(spark):
    given = ["arn:aws:sm:eu:1:artifact/x", "arn:aws:sm:eu:1:context/y/z"]
    assert apply(spark, paths.arn_resource_kind, given) == ["artifact", "context"]
    assert apply(spark, paths.arn_tail, given) == ["x", "z"]


def test_snake_case(spark):
    given = ["DataSetArnsID", "Name", "already_snake", "SerDeInfo", "ARN", "KmsKeyId", "x"]
    expected = ["data_set_arns_id", "name", "already_snake", "ser_de_info", "arn", "kms_key_id", "x"]
    assert apply(spark, snake_case, given) == expected


def test_filter_searches_inside_the_name(spark):
    given = ["team/events", "team/events_pii", "team/other"]
    got = apply(spark, lambda c: allowed(c, ["events"], ["_pii"]), given)
    assert got == [True, False, False]
    assert apply(spark, lambda c: allowed(c), given) == [True, True, True]
    assert apply(spark, lambda c: allowed(c, [".*.parquet"], ["dev_.*"]), ["a.parquet", "dev_a.parquet"]) == [True, False]


def test_job_name(spark):
    given = ["abc-0a1-train-model-2022-aws-training-job", "plain-name", "p-1-x-2-aws-processing-job", "p-1-x-aws-other-job"]
    assert apply(spark, job_name, given) == ["train-model", "plain-name", "x", "p-1-x-aws-other-job"]


def test_statuses(spark):
    given = ["STARTING", "RUNNING", "STOPPING", "STOPPED", "SUCCEEDED", "FAILED", "ERROR", "TIMEOUT", "new", None]
    assert apply(spark, status.job_run_status, given) == [
        "UNKNOWN", "UNKNOWN", "UNKNOWN", "ABORTED", "SUCCESS", "FAILED", "FAILED", "FAILED", "UNKNOWN", "UNKNOWN",
    ]
    given = ["creating", "running", "stopped", "failed", "failed-move", "other"]
    assert apply(spark, status.task_status, given) == ["UNKNOWN", "RUNNING", "ABORTED", "FAILED", "BROKEN", "UNKNOWN"]
    assert apply(spark, status.table_kind, ["EXTERNAL_TABLE", "VIRTUAL_VIEW", "x"]) == ["TABLE", "VIEW", "UNKNOWN"]


def test_names(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(names.object_key_name("b", "k/x")) == "//s3/cloud/aws/buckets/b/keys/k/x"
    assert get(names.account_source("glue", "1", "eu")) == "//glue/cloud/aws/account/1/region/eu"
    assert get(names.feature_source("1", "eu")) == "//aws/1/region/eu/sagemaker/featurestore"
    assert get(names.bi_object_name("1", "eu", F.lit("b"), F.lit("k"))) == "//s3/cloud/aws/account/1/region/eu/bucket/b/key/k"
    assert get(names.child_field_name(F.lit("r"), "keys", F.lit("string"))) == "r/keys/string"
