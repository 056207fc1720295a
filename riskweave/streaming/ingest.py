"""Incremental landing, overlap dedup, continuous upsert and flagging."""

from functools import reduce

from pyspark.sql import functions as F

from riskweave.operators.merge import flag_kev
from riskweave.operators.ranking import latest


def land_stream(spark, path, schema, fmt="json", files_per_trigger=1000):
    """File stream over landed records with a fixed schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def dedup_stream(df, keys, delay="2 days", event_time="modified_at"):
    """Drop repeats of a key that arrive within the overlap window."""
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(
        event_time, delay).dropDuplicatesWithinWatermark(keys)


COMMIT = "version bigint, stream string, batch bigint, kind string, n bigint"


class KeyedTable:
    """A keyed parquet table as a log: every batch writes its own rows, a reader takes the newest version of each key.

    `rows/_kind=delta/_version=N` holds the rows of one batch, `rows/_kind=base/_version=N` all keys as of version N,
    `commits` one row for each finished write with the stream and the batch it came from. A version counts once its
    commit is there, so a batch cut off half way leaves nothing to be seen and is written anew under the same version,
    and a batch that runs again after its commit does nothing. What is written grows with the batch. Once the rows of
    the deltas outnumber those of the base by `ratio`, the next base is written, so a row is rewritten a bounded number of
    times on average. Folders of versions before the base are not read; remove them when no reader is left on them. One
    writer at a time.
    """

    def __init__(self, spark, path, schema, keys, ratio=1.0, least=16):
        empty = spark.createDataFrame([], schema)
        self.spark, self.path, self.keys, self.ratio, self.least = spark, path.rstrip("/"), list(keys), ratio, least
        self.columns = empty.columns
        self.stored = empty.select("*", F.lit("").alias("_kind"), F.lit(0).cast("bigint").alias("_version")).schema
        spark.createDataFrame([], self.stored).write.mode("ignore").partitionBy("_kind", "_version").parquet(self.path + "/rows")
        spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(self.path + "/commits")

    def commits(self):
        return self.spark.read.schema(COMMIT).parquet(self.path + "/commits")

    def _state(self):
        """(newest version, version of the base, rows of the base, deltas since, their rows)."""
        done = self.commits()
        base = done.filter("kind = 'base'").agg(F.max(F.struct("version", "n")).alias("b")).first()["b"] or (-1, 0)
        since = done.filter((F.col("kind") == "delta") & (F.col("version") > base[0])).agg(
            F.max("version"), F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        return max(base[0], -1 if since[0] is None else since[0]), base[0], base[1], since[1], since[2]

    def read(self, version=None):
        """Newest row of every key, or the newest as of a version not older than the base; rows without a key are all kept."""
        last, base, *_ = self._state()
        last = last if version is None else version
        kind, at = F.col("_kind"), F.col("_version")
        files = self.spark.read.schema(self.stored).parquet(self.path + "/rows").filter(
            ((kind == "base") & (at == base)) | ((kind == "delta") & (at > base) & (at <= last)))
        return latest(files.withColumn("_solo", self._solo()), [*self.keys, "_solo"], ["_version"]).select(*self.columns)

    def _solo(self):
        """0 where the key is whole; rows with a NULL in it never match, so each gets a number of its own."""
        keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        return F.when(keyless, F.monotonically_increasing_id() + 1).otherwise(F.lit(0))

    def _write(self, rows, kind, version, stream, batch):
        rows.select(*self.columns, F.lit(kind).alias("_kind"), F.lit(version).cast("bigint").alias("_version")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_kind", "_version").parquet(self.path + "/rows")
        n = self.spark.read.schema(self.stored).parquet(self.path + "/rows").filter(
            (F.col("_kind") == kind) & (F.col("_version") == version)).count()
        self.spark.createDataFrame([(version, stream, batch, kind, n)], COMMIT).coalesce(1).write.mode("append").parquet(
            self.path + "/commits")

    def merge(self, batch, number, order=(), finish=lambda df: df, stream="main"):
        """Latest-wins upsert of batch `number` of a stream: a key's row with the largest `order` replaces the stored one.

        Columns that the batch lacks keep their stored value. Returns whether anything was done.
        """
        if not self.commits().filter((F.col("stream") == stream) & (F.col("batch") == number)).isEmpty():
            return False
        new = batch
        if order:
            new = latest(new.withColumn("_solo", self._solo()), [*self.keys, "_solo"], list(order)).drop("_solo")
        lacking = [c for c in self.columns if c not in new.columns]
        if lacking:
            new = new.join(self.read().select(*self.keys, *lacking), self.keys, "left")
        last, base, held, deltas, rows = self._state()
        self._write(finish(new), "delta", last + 1, stream, number)
        if deltas + 1 >= self.least and rows > self.ratio * held:
            self.compact()
        return True

    def compact(self):
        """Write all keys as of now as the next base."""
        last, base, *_ = self._state()
        if last > base:
            self._write(self.read(), "base", last, None, None)


def upsert_stream(df, table, order, checkpoint, kev=None):
    """Continuous latest-wins upsert; with a catalogue, the rows of a batch are flagged in the same step.

    `kev` is a catalogue or a function that reads it as of now. Rows that no later batch brings are flagged by
    `catalogue_stream` when the catalogue grows.
    """
    known = kev if callable(kev) else lambda: kev

    def merge(batch, number):
        table.merge(batch, number, order, (lambda rows: flag_kev(rows, known())) if kev is not None else lambda rows: rows)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def catalogue_stream(ids, table, checkpoint, key="cve_id", flag="is_kev"):
    """New catalogue ids as a second stream: stored rows with one of them and without the flag get it, no others are written."""

    def mark(batch, number):
        new = batch.select(F.upper(key).alias("_id")).filter("_id IS NOT NULL").distinct()
        rows = table.read().filter(F.coalesce(F.col(flag), F.lit(0)) != 1)
        found = rows.join(new, F.col(key) == F.col("_id"), "left_semi")
        kind = found.schema[flag].dataType
        table.merge(found.withColumn(flag, F.lit(1).cast(kind)), number, stream="catalogue")

    return ids.writeStream.foreachBatch(mark).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def flag_kev_stream(df, kev):
    """Stream-static left join: is_kev = 1 where the CVE is in the catalogue."""
    return flag_kev(df, kev)


def append_stream(df, path, checkpoint):
    """Write a stream to parquet until the input there now is used up."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
