"""A Parquet table keyed by uuid: partitioned into slices, bucketed within them, and rewritten slice by slice."""

import hashlib

from pyspark.sql import functions as F


def slice_of(key, slices):
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def staged(df, path):
    """Write an intermediate table and go on from it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files(spark, path):
    """The file system of a path, as Spark knows it, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


class Snapshot:
    """The table's current rows, one for each uuid.

    All slices share one set of buckets by uuid, so two snapshots of the same buckets, or a snapshot and a batch, join
    without shuffling the snapshot. Writing replaces the slices it is given by Spark's dynamic partition overwrite; it
    is not atomic over slices, so what is applied must bear being applied again (see IndexStore, EventStore).
    """

    def __init__(self, spark, folder, columns, slices, buckets):
        self.spark, self.folder, self.slices = spark, folder, slices
        self.columns = dict(columns)
        self.table = f"tidemark_{hashlib.md5(folder.encode()).hexdigest()}"
        body = ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())
        self._create = (
            f"create table if not exists {self.table} (uuid string, {body}, slice int) using parquet "
            f"options (partitionOverwriteMode 'dynamic') partitioned by (slice) clustered by (uuid) into {buckets} buckets location '{folder}'")

    def exists(self):
        system, path = files(self.spark, self.folder)
        return system.exists(path)

    def ensure(self):
        """Create the table where it is absent, and make it known to this session's catalog."""
        known = self.spark.catalog.tableExists(self.table)
        if not known:
            there = self.exists()
            self.spark.sql(self._create)
            if there:
                self.spark.sql(f"alter table {self.table} recover partitions")
            else:
                self.write(self.spark.createDataFrame([], "uuid string"), range(self.slices))
        return self

    def read(self, slices=None):
        """Rows of all slices or of some."""
        rows = self.spark.table(self.table)
        if slices is not None:
            rows = rows.where(F.col("slice").isin([int(s) for s in slices]))
        return rows.where("uuid is not null").select("uuid", *self.columns)

    def write(self, rows, slices):
        """Replace the given slices by the rows, which lie in them. Each slice holds a row without uuid, so that one left
        without documents is overwritten too and every slice exists from the start."""
        absent = [F.lit(None).cast(kind).alias(c) for c, kind in self.columns.items()]
        own = {name: (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name) for name, kind in self.columns.items()}
        body = rows.select("uuid", *own.values(), slice_of("uuid", self.slices).alias("slice"))
        marks = self.spark.createDataFrame([(int(s),) for s in slices], "slice int").coalesce(1).select(F.lit(None).cast("string").alias("uuid"), *absent, "slice")
        body.unionByName(marks).write.mode("overwrite").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
