"""Sessions, memory checks and object store settings."""

from __future__ import annotations

from pathlib import Path

import pyspark
from pyspark.sql import SparkSession

#: Settings of the object store connectors; anonymous reads, tuned for column files read by many tasks.
S3A_CONF = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
    "spark.hadoop.fs.s3a.experimental.input.fadvise": "random",
    "spark.hadoop.fs.s3a.readahead.range": "64K",
    "spark.hadoop.fs.s3a.connection.maximum": "200",
    "spark.hadoop.fs.s3a.threads.max": "64",
}
GCS_CONF = {
    "spark.hadoop.fs.gs.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem",
    "spark.hadoop.fs.AbstractFileSystem.gs.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFS",
}
CONNECTORS = {"s3": (("hadoop-aws", "aws-java-sdk-bundle"), S3A_CONF), "gcs": (("gcs-connector",), GCS_CONF)}


def connector_conf(store: str, jars: Path) -> dict[str, str]:
    """Settings for an object store ('s3' or 'gcs') whose connector's jars, of any version, lie in a folder; a missing one is an error."""
    names, conf = CONNECTORS[store]
    found = []
    for name in names:
        own = sorted([*jars.glob(f"{name}.jar"), *jars.glob(f"{name}-*.jar")])
        if not own:
            raise FileNotFoundError(f"no {name} jar in {jars}")
        found.append(str(own[-1]))
    return conf | {"spark.jars": ",".join(found), "spark.driver.extraClassPath": ",".join(found)}


def check_memory(**gigabytes: int) -> None:
    """Every heap needs a gigabyte at least."""
    for name, gb in gigabytes.items():
        if gb < 1:
            raise ValueError(f"{name} must be at least 1 GB, not {gb}")


def session(
    app: str = "phaseloom",
    master: str | None = None,
    driver_gb: int = 1,
    executor_gb: int = 1,
    shuffle_partitions: int | None = None,
    gcs_key_file: str | None = None,
    store: str | None = None,
    jars: str | None = None,
) -> SparkSession:
    """A session with adaptive execution, ANSI mode and UTC; unset numbers are left to the cluster's own configuration.

    store: 's3' or 'gcs', with its connector's jars in the folder `jars` (Spark's own jars without one).
    """
    check_memory(driver_gb=driver_gb, executor_gb=executor_gb)
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.driver.memory", f"{driver_gb}g")
        .config("spark.executor.memory", f"{executor_gb}g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if gcs_key_file:
        if not Path(gcs_key_file).is_file():
            raise FileNotFoundError(gcs_key_file)
        builder = builder.config("spark.hadoop.google.cloud.auth.service.account.json.keyfile", gcs_key_file)
    if store:
        for key, value in connector_conf(store, Path(jars) if jars else Path(pyspark.__file__).parent / "jars").items():
            builder = builder.config(key, value)
    return builder.getOrCreate()
