"""Where results go: sorted and partitioned Parquet, one file for each airport, blob archives, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, date: str | None = None, numbers: tuple[str, ...] = ("t", "lat", "lon", "alt")) -> None:
    """Rows by (icao, t) in files that follow icao's order, differences for numbers, dictionaries for strings; below date=... if date is given.

    A date that is written replaces that date only.
    """
    order = [*([date] if date else []), "icao", "t"]
    out = df.repartitionByRange(*order[:-1]).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
    for c in numbers:
        out = out.option(f"parquet.enable.dictionary#{c}", "false")
    if date:
        out = out.partitionBy(date).option("partitionOverwriteMode", "dynamic")
    out.parquet(path)


def epoch_date(seconds: Column | str) -> Column:
    """The UTC date, as yyyy-MM-dd, in a session whose zone is UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def write_airports(rows: DataFrame, path: str, name: str = "data_0.parquet") -> None:
    """One file for each airport, airport=X/data_0.parquet, by icao and t inside.

    All of an airport's rows meet in one task by contract; rows clash in a task only with other airports of its partition. Spark's own
    file names are changed after the commit; a rename that is repeated finds nothing to do.
    """
    spark = rows.sparkSession
    placed = rows.repartition("airport").sortWithinPartitions("airport", "icao", "t")
    placed.write.mode("overwrite").option("compression", "zstd").partitionBy("airport").parquet(path)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(root):
        if folder.isDirectory():
            for f in files.listStatus(folder.getPath()):
                if f.getPath().getName().startswith("part-"):
                    files.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(folder.getPath(), name))


def dates_manifest(dates: DataFrame) -> DataFrame:
    """One row, manifest: {"dates": [...], "latest": ...} as JSON; latest is null without dates."""
    found = dates.select(F.regexp_replace("date", "^date=", "").alias("date")).agg(F.sort_array(F.collect_set("date")).alias("dates"), F.max("date").alias("latest"))
    return found.select(F.to_json(F.struct("dates", "latest"), {"ignoreNullFields": "false"}).alias("manifest"))


def expired(dates: DataFrame, keep: int = 30) -> DataFrame:
    """Dates beyond the newest `keep`."""
    newest = dates.select("date").distinct().orderBy(F.desc("date")).limit(keep)
    return dates.select("date").distinct().join(F.broadcast(newest), "date", "left_anti")


def tag_date(tag: Column | str) -> Column:
    """yyyy-MM-dd of a release's tag that begins vYYYY.MM.DD; empty where there is none."""
    parts = [F.regexp_extract(tag, r"v(\d{4})\.(\d{2})\.(\d{2})", k) for k in (1, 2, 3)]
    return F.when(parts[0] == "", F.lit("")).otherwise(F.concat_ws("-", *parts))


def write_blobs(archive: DataFrame, path: str) -> DataFrame:
    """icao, bytes of the files <icao>.tz written below path, a folder that all executors share."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    def run(batches):
        files, folder = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        files.create_dir(folder)
        for batch in batches:
            for icao, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_output_stream(f"{folder}/{icao}.tz.part") as out:
                    out.write(blob)
                files.move(f"{folder}/{icao}.tz.part", f"{folder}/{icao}.tz")
            yield pa.record_batch({"icao": batch.column(0), "bytes": pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64())})

    return archive.select("icao", "blob").mapInArrow(run, "icao string, bytes long")


def read_blobs(spark, path: str) -> DataFrame:
    """icao and blob of the archive files below path that begin with the magic."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tz").option("recursiveFileLookup", "true").load(path)
    return found.where(F.substring("content", 1, 4) == F.lit(b"TZ01")).select(F.regexp_extract("path", r"([^/]+)\.tz$", 1).alias("icao"), F.col("content").alias("blob"))


def archive_manifest(archive: DataFrame, tolerances: dict[str, float]) -> DataFrame:
    """One row, manifest: tolerances, count and the aircraft of an archive, as JSON."""
    aircraft = archive.agg(F.count("*").alias("count"), F.sort_array(F.collect_list(F.struct("icao", "n_points"))).alias("aircraft"))
    limits = F.struct(*[F.lit(v).alias(k) for k, v in tolerances.items()])
    return aircraft.select(F.to_json(F.struct(limits.alias("tolerances"), "count", "aircraft")).alias("manifest"))
