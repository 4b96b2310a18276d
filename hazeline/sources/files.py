"""CSV and JSON scans and writes with explicit options.

Each function is the reader or writer call a Spark user writes; schemas
are passed explicitly wherever the format allows, so no inference pass
runs except where inference is the operator (``csv_inferred``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.schemas import GEOJSON, snapshot_schema


#: Rows of a compressed part file, which one task reads as a whole.
ROWS_PER_FILE = 500_000


def write_csv(df: DataFrame, path: str, encoding: str | None = None,
              partition_by: list[str] | None = None, compressed: bool = False) -> None:
    """Header, overwrite, one part file per task (a multi-part folder); compressed
    ones (gzip) of ROWS_PER_FILE rows at most."""
    w = df.write.mode("overwrite").option("header", "true")
    if compressed:
        w = w.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
    if encoding:
        w = w.option("encoding", encoding)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header scan, every column STRING."""
    return spark.read.csv(path, header=True)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header scan with type inference (one extra pass over the data)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def csv_typed(spark: SparkSession, path: str, schema: T.StructType,
              encoding: str | None = None) -> DataFrame:
    """Header scan with declared types; an unparsable field becomes NULL
    (PERMISSIVE) and the rest of the row is kept."""
    r = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
    if encoding:
        r = r.option("encoding", encoding)
    return r.csv(path)


def csv_dir(spark: SparkSession, path: str) -> DataFrame:
    """Read-back of a multi-part CSV folder (or one part file)."""
    return spark.read.format("csv").option("header", "true").load(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def snapshots(spark: SparkSession, path: str, fields=None) -> DataFrame:
    """Snapshot documents with the declared nested schema, limited to the
    ``data`` fields a reader needs (the rest of each document is skipped)."""
    return spark.read.schema(snapshot_schema(fields)).json(path)


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON FeatureCollection documents (a file, or a folder with one a file;
    pretty-printed, so ``multiLine``) to one row per feature: (SIG_ENG_NM, geometry). Coordinates declared STRING
    arrive as raw JSON text and are carried as an opaque payload."""
    fc = spark.read.schema(GEOJSON).option("multiLine", "true").json(path)
    f = fc.select(F.explode("features").alias("f"))
    return f.select(F.col("f.properties.SIG_ENG_NM").alias("SIG_ENG_NM"),
                    F.col("f.geometry").alias("geometry"))


#: Features of one document: what one task builds and one task parses.
FEATURES_PER_DOCUMENT = 10_000


def write_geojson(boundaries: DataFrame, path: str,
                  per_document: int = FEATURES_PER_DOCUMENT) -> None:
    """A folder of pretty-printed FeatureCollection documents, one a file, of
    about ``per_document`` features each. A document is one JSON value and so is
    built in one task; any number of features takes as many documents. A small
    set is one document; an empty one is a document without features."""
    rows = boundaries.select("SIG_ENG_NM", "geometry")
    documents = max(1, -(-rows.count() // per_document))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("SIG_ENG_NM").alias("properties"),
                       F.struct(F.col("geometry.type").alias("type"),
                                F.parse_json(F.col("geometry.coordinates")).alias("coordinates")).alias("geometry"))
    number = F.pmod(F.xxhash64("SIG_ENG_NM", "geometry.type", "geometry.coordinates"), F.lit(documents))
    features = F.coalesce(F.collect_list("f"), F.array())
    body = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), features.alias("features")), {"pretty": "true"})
    dealt = rows.select(number.alias("n"), feature.alias("f"))
    dealt = dealt.groupBy("n") if documents > 1 else dealt.groupBy()
    (dealt.agg(body.alias("value")).select("value").write.mode("overwrite")
     .option("maxRecordsPerFile", 1).text(path))
