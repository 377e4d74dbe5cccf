"""A folder of Parquet files whose valid ones are listed in versions, and the merge of its small files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from eventloom.streaming.live import BATCH, BatchTable

VERSION = "file_version"
LISTING = "file string, uri string, bytes long, folder string"


class FileSet:
    """Rows in Parquet files below ``path``, partitioned by ``by``. Readers see the files that the last committed version lists.

    A change writes its new files into a folder of its own (``file_version=N``), then the list of all valid files, then a
    commit. Without the commit nothing has changed, and the next change takes the same number and replaces what was left.
    Files are never rewritten in place, so a reader of an earlier version is not disturbed. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> None:
        self.spark, self.root, self.schema, self.by = spark, f"{path}/files", schema, tuple(by)
        self.lists = BatchTable(spark, f"{path}/lists", LISTING)
        self.plans = BatchTable(spark, f"{path}/plans", f"{LISTING}, part long")
        self.commits = BatchTable(spark, f"{path}/commits", "files long")

    def version(self) -> int:
        """Number of the last committed version, -1 if there is none."""
        last = self.commits.batches().agg(F.max(BATCH)).first()[0]
        return -1 if last is None else last

    def files(self) -> DataFrame:
        """``file``, ``uri``, ``bytes`` and ``folder`` (partition folder) of each valid file."""
        return self.lists.batch(self.version())

    def _write(self, rows: DataFrame, version: int) -> DataFrame:
        """Write the files of a version and list them; file contents are not read for that."""
        folder = f"{self.root}/{VERSION}={version}"
        writer = rows.select(*self.schema.names).write.option("partitionOverwriteMode", "static").mode("overwrite")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(folder)
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
        below = F.regexp_extract("path", f"/{VERSION}={version}/(?:(.*)/)?[^/]+$", 1)
        return listed.select(F.col("path").alias("file"), F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"), below.alias("folder"))

    def _commit(self, files: DataFrame, version: int) -> None:
        self.lists.put(files, version)
        count = self.lists.batch(version).agg(F.count(F.lit(1)).alias("files"))
        self.commits.put(count, version)

    def _read(self, files: DataFrame) -> DataFrame:
        names = [r["file"] for r in files.select("file").collect()]  # the list that a scan holds in any case
        schema = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*names)

    def read(self) -> DataFrame:
        """All rows of the last version."""
        return self._read(self.files()).select(*self.schema.names)

    def add(self, rows: DataFrame) -> None:
        """Append rows as a new version."""
        now = self.version()
        new = self._write(rows, now + 1)
        self._commit(self.lists.batch(now).unionByName(new), now + 1)

    def plan(self, small: int, target: int) -> DataFrame:
        """Which files to merge: those below ``small`` bytes, with the number of their group within their partition folder.

        Files are laid end to end, smallest first, and cut every ``target`` bytes; a file belongs where it begins, so a
        group has less than ``target + small`` bytes. A group of one file is left alone.
        """
        upto = Window.partitionBy("folder").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("bytes").over(upto), F.lit(0))
        grouped = self.files().filter(F.col("bytes") < small).withColumn("part", F.floor(before / target))
        return grouped.withColumn("n", F.count("*").over(Window.partitionBy("folder", "part"))).filter("n > 1").drop("n")

    def merge_small(self, small: int = 32 << 20, target: int = 128 << 20) -> int:
        """Rewrite each group of small files (see ``plan``) as one file; returns how many files were merged.

        Only small files are read. Others stay in the list as they are, by name and byte. Nothing to merge changes nothing.
        """
        now = self.version()
        self.plans.put(self.plan(small, target), now + 1)
        merged = self.plans.batch(now + 1)
        count = merged.count()
        if not count:
            return 0
        group = merged.select(F.col("uri").alias("_uri"), F.concat_ws("#", "folder", "part").alias("_group"))
        rows = self._read(merged).select("*", F.col("_metadata.file_path").alias("_uri")).join(group, "_uri")
        groups = merged.select("folder", "part").distinct().count()
        new = self._write(rows.repartition(groups, "_group"), now + 1)
        self._commit(self.lists.batch(now).join(merged, "file", "left_anti").unionByName(new), now + 1)
        return count
