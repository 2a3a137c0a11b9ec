"""Trace documents: JSON, plain or gzipped under any name, into samples; what can't be read goes to quarantine with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBER = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def files(spark: SparkSession, path: str, glob: str = "trace_full_*.json", sample: int | None = None, seed: int = 0) -> DataFrame:
    """path, name and content of the trace files below path, each once; with sample that many, drawn by a hash of their paths."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    found = found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return found if sample is None else found.orderBy(F.xxhash64("path", F.lit(seed)), "path").limit(sample)


def documents(found: DataFrame) -> DataFrame:
    """path, name, doc (VARIANT) and error. Compression shows in the first bytes, not in the name."""
    import pyarrow as pa

    def run(batches):
        import gzip
        import zlib

        for batch in batches:
            texts, errors = [], []
            for data in batch.column(2).to_pylist():
                try:
                    texts.append((gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode())
                    errors.append(None)
                except (OSError, EOFError, zlib.error, UnicodeDecodeError) as e:
                    texts.append(None)
                    errors.append(f"unreadable: {type(e).__name__}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                names=["path", "name", "text", "error"],
            )

    text = found.select("path", "name", "content").mapInArrow(run, "path string, name string, text string, error string")
    r = text.select("path", "name", F.try_parse_json("text").alias("doc"), "error")
    return r.withColumn("error", F.coalesce("error", F.when(F.col("doc").isNull(), "not JSON")))


def _number(v: str) -> str:
    """A JSON number, not a number in a string."""
    return f"CASE WHEN regexp_like(schema_of_variant({v}), '{NUMBER}') THEN try_variant_get({v}, '$', 'double') END"


def _at(k: int) -> str:
    return f"try_variant_get(p, '$[{k}]', 'variant')"


def samples(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, quarantine). samples: icao, base_ts, seq, t, lat, lon, gnd, baro, gate_ft, geom, gs, trk, vr, src. quarantine: path and error.

    A document with a point that is too short, or has no time or position, is left out as a whole. Its aircraft is its icao, else a part of the file's
    name, else ??????. gate_ft is what the gates take for the altitude: baro, or a whole number in a string, which is no altitude anywhere else.
    """
    fine = docs.where("error is null")
    each = fine.select(
        "path",
        F.coalesce(F.try_variant_get("doc", "$.icao", "string"), F.nullif(F.substring("name", 12, 6), F.lit("")), F.lit("??????")).alias("icao"),
        F.coalesce(F.try_variant_get("doc", "$.timestamp", "double"), F.lit(0.0)).cast("long").alias("base_ts"),
        F.expr("posexplode_outer(try_variant_get(doc, '$.trace', 'array<variant>'))").alias("seq", "p"),
    )
    vr = f"coalesce({_number(_at(11))}, {_number(_at(7))})"
    r = each.select(
        "path", "icao", "base_ts", F.col("seq").cast("long").alias("seq"),
        F.expr(_number(_at(0))).alias("t"), F.expr(_number(_at(1))).alias("lat"), F.expr(_number(_at(2))).alias("lon"),
        F.expr(f"coalesce(schema_of_variant({_at(3)}) = 'STRING' AND try_variant_get(p, '$[3]', 'string') = 'ground', false)").alias("gnd"),
        F.expr(_number(_at(3))).alias("baro"), F.expr(f"coalesce({_number(_at(3))}, CASE WHEN regexp_like(try_variant_get(p, '$[3]', 'string'), '^\\\\s*[+-]?[0-9]+\\\\s*$') THEN try_cast(trim(try_variant_get(p, '$[3]', 'string')) AS double) END)").alias("gate_ft"), F.expr(_number(_at(10))).alias("geom"), F.expr(_number(_at(4))).alias("gs"), F.expr(_number(_at(5))).alias("trk"), F.expr(vr).alias("vr"),
        F.expr(f"CASE WHEN schema_of_variant({_at(9)}) = 'STRING' THEN try_variant_get(p, '$[9]', 'string') ELSE try_variant_get(p, '$[9].type', 'string') END").alias("src"),
        F.expr("size(try_variant_get(p, '$', 'array<variant>'))").alias("_n"),
    )
    bad = F.when(F.col("seq").isNull(), "no trace").when(
        F.col("t").isNull() | F.col("lat").isNull() | F.col("lon").isNull(), "point without time or position",
    ).when(F.col("_n") < 8, "point too short")
    r = r.withColumn("error", bad)
    wrong = r.where("error is not null").groupBy("path").agg(F.min("error").alias("error"))
    return r.join(wrong.select("path"), "path", "left_anti").drop("path", "_n", "error"), docs.where("error is not null").select("path", "error").unionByName(wrong)


def aircraft(docs: DataFrame) -> DataFrame:
    """icao, reg, type, desc, base_ts of every readable document."""
    get = lambda k: F.try_variant_get("doc", f"$.{k}", "string")
    return docs.where("error is null").select(
        F.coalesce(get("icao"), F.nullif(F.substring("name", 12, 6), F.lit("")), F.lit("??????")).alias("icao"), get("r").alias("reg"),
        get("t").alias("type"), get("desc").alias("desc"),
        F.coalesce(F.try_variant_get("doc", "$.timestamp", "double"), F.lit(0.0)).cast("long").alias("base_ts"),
    )


def airports(spark: SparkSession, path: str) -> DataFrame:
    """pos, ident, lat, lon, elev (whole feet, null if blank) of an airports table with a header; rows without numbers for the position are left out.
    pos orders the rows of one file."""
    r = spark.read.option("header", "true").csv(path)
    r = r.select(
        "ident", F.expr("try_cast(latitude_deg AS double)").alias("lat"), F.expr("try_cast(longitude_deg AS double)").alias("lon"),
        F.expr("cast(try_cast(elevation_ft AS double) AS int)").alias("elev"),
    )
    return r.withColumn("pos", F.monotonically_increasing_id()).where("ident is not null and lat is not null and lon is not null")
