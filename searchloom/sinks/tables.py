"""Plain parquet outputs keyed by run, and staging of intermediate frames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from searchloom.session import new_work_dir, work_root


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """The frame written to the shared work folder and read back.

    Cuts the lineage in storage every executor can reach, so that later steps neither
    repeat the parse nor depend on executors that are gone.
    """
    path = new_work_dir(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(records: DataFrame) -> DataFrame:
    """Stream records dealt over all cores before they are parsed.

    A batch of a few files of one row group each would be parsed by as many tasks, however many cores there are.
    """
    cores = records.sparkSession.sparkContext.defaultParallelism
    tasks = max(2 * cores, 0 if records.isStreaming else records.rdd.getNumPartitions())
    return records.repartition(tasks, "partition", "offset", "key")


def dealt(rows: DataFrame) -> DataFrame:
    """Shard rows dealt over all cores before they are parsed.

    A scan has as many busy tasks as its files have row groups: many small rows in few groups would be parsed by a few
    cores, however many there are. Moving a row costs a small part of its parse. The number of tasks is given, as one
    that follows from bytes leaves cores idle: the rows are few bytes and much work.
    """
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "shard_table", "id")


def release(*frames: DataFrame) -> None:
    """Delete the folders of staged frames that nothing reads any more; frames that were not staged are left alone."""
    for df in frames:
        spark = df.sparkSession
        below = f"{work_root(spark)}/searchloom/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if below in f}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_run(df: DataFrame, root: str, run: str) -> str:
    """Write the output of one run; writing it again replaces it.

    Only for output that follows from the run alone, as that of a stream batch does.
    """
    path = f"{root.rstrip('/')}/run={run}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_run(df: DataFrame, root: str, run: str) -> str:
    """Add the output of one attempt under a name of its own; nothing written before changes.

    A repeated or competing attempt can so never replace rows another one counted on.
    """
    path = f"{root.rstrip('/')}/run={run}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return path


def read_runs(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    """All rows of all runs; empty when nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root + "/run=*")):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(root).drop("run")


def write_kafka(records: DataFrame, servers: str, **options: str) -> None:
    """Publish (topic, key, value) to Kafka; keys of one message stay in one partition. Needs the connector on the class path."""
    writer = records.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers)
    # all replicas have a record before it counts, and a retry does not write it twice
    for name, value in {"kafka.acks": "all", "kafka.enable.idempotence": "true", **options}.items():
        writer = writer.option(name, value)
    writer.save()
