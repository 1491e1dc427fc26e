"""Resource-name builders: pure Column templates, no generator state.

A resource name is ``//<system>/<server path>/<level>/<value>/...``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def path_of(base: Column, **levels: Column | str) -> Column:
    """``base/<level>/<value>/...`` in the order the levels are given."""
    pieces: list[Column] = [base]
    for level, value in levels.items():
        pieces += [F.lit(level), _part(value)]
    return F.concat_ws("/", *pieces)


def account_source(system: str, account: Column | str, region: Column | str) -> Column:
    """Source name of an account-scoped service."""
    return path_of(F.lit(f"//{system}/cloud/aws"), account=account, region=region)


def host_source(system: Column | str, host: Column | str) -> Column:
    """Source name of a database server."""
    return F.concat(F.lit("//"), _part(system), F.lit("/host/"), _part(host))


def bucket_name(bucket: Column | str) -> Column:
    return path_of(F.lit("//s3/cloud/aws"), buckets=bucket)


def custom_bucket_name(endpoint: Column | str, bucket: Column | str) -> Column:
    """Bucket on an S3-compatible endpoint."""
    return path_of(F.concat(F.lit("//s3-custom/"), _part(endpoint)), buckets=bucket)


def object_key_name(bucket: Column | str, key: Column | str) -> Column:
    return path_of(bucket_name(bucket), keys=key)


def bi_object_name(account: Column | str, region: Column | str, bucket: Column, key: Column) -> Column:
    """Upstream object of a BI dataset; this template has its own level names."""
    return path_of(F.lit("//s3/cloud/aws"), account=account, region=region, bucket=bucket, key=key)


def feature_source(account: Column | str, region: Column | str) -> Column:
    return F.concat(
        F.lit("//aws/"), _part(account), F.lit("/region/"), _part(region), F.lit("/sagemaker/featurestore")
    )


def child_field_name(parent: Column, segment: Column | str, name: Column) -> Column:
    """Name of a nested field: ``<parent>/<keys|values|subcolumns>/<name>``."""
    return F.concat_ws("/", parent, _part(segment), name)
