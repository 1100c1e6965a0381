"""Storage locations by backend."""

from __future__ import annotations


def warehouse_path(backend: str, prefix: str = "warehouse", **options: str) -> str:
    """URI of a folder on local disk, S3, Azure or Google Cloud Storage."""
    prefix = prefix.strip("/")
    if backend == "local":
        return f"file://{options['root'].rstrip('/')}/{prefix}"
    if backend == "s3":
        return f"s3a://{options['bucket']}/{prefix}"
    if backend == "azure":
        account, container = options["storage_account"], options["container"]
        return f"abfss://{container}@{account}.dfs.core.windows.net/{prefix}"
    if backend == "gcs":
        return f"gs://{options['bucket']}/{prefix}"
    raise ValueError(f"unknown storage backend: {backend}")


def storage_conf(backend: str, **options: str) -> dict[str, str]:
    """Spark settings for a backend whose endpoint or region is not the default."""
    if backend != "s3":
        return {}
    conf = {}
    if options.get("region"):
        conf["spark.hadoop.fs.s3a.endpoint.region"] = options["region"]
    if options.get("endpoint_url"):
        conf["spark.hadoop.fs.s3a.endpoint"] = options["endpoint_url"]
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return conf
