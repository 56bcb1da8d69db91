"""Sinks: pages, manifests and chunks as tables or JSON lines, replaced document by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from pagemill.storage import Scratch


def _valid(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.make_valid_utf8(value)
    if isinstance(kind, ArrayType) and _has_text(kind):
        return F.transform(value, lambda x: _valid(x, kind.elementType))
    if isinstance(kind, MapType) and _has_text(kind):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(_valid(e["key"], kind.keyType).alias("key"), _valid(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(kind, StructType) and _has_text(kind):
        return F.when(value.isNotNull(), F.struct(*(_valid(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return value


def _has_text(kind: DataType) -> bool:
    return "string" in kind.simpleString()


def sanitized(rows: DataFrame) -> DataFrame:
    """Every string, at any depth of arrays, structs and maps, with invalid UTF-8 replaced; nulls stay."""
    return rows.select(*(_valid(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema.fields))


#: Folders over which the documents of a table are spread.
BUCKETS = 256


def write_documents(rows: DataFrame, path: str, key: str = "doc_id", form: str = "parquet", order: tuple[str, ...] = ("page",), buckets: int = BUCKETS) -> None:
    """Replaces the documents in ``rows`` in a table of hash buckets of their ids; other documents stay.

    Only buckets that hold one of the documents are rewritten: their other rows are read and written again beside the new ones, first into a folder
    beside the table. A bucket's rows are spread over tasks by document and order, so one document of any size is no single
    task; rows of a document are ordered inside each file. The number of buckets is fixed for a table. Rows without a key are left out.
    """
    spark = rows.sparkSession
    kept = [c for c in order if c in rows.columns]
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    new = sanitized(rows).filter(F.col(key).isNotNull()).withColumn("bucket", bucket)
    work = Scratch(spark, "sink")
    new = work.cut(new, "new")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        old = spark.read.schema(new.schema).format(form).load(path)
        touched = new.select("bucket").distinct()  # at most as many rows as buckets
        stay = old.join(F.broadcast(touched), "bucket", "left_semi").join(new.select(key).distinct(), key, "left_anti")
        new = work.cut(new.unionByName(stay.select(*new.columns)), "merged")
    spread = new.repartitionByRange(F.col("bucket"), F.col(key), *kept).sortWithinPartitions("bucket", key, *kept)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").format(form).save(path)
    work.drop_all()


def read_documents(spark: SparkSession, path: str, schema: str | StructType | None = None, form: str = "parquet") -> DataFrame:
    """The table of :func:`write_documents` without its buckets."""
    reader = spark.read.format(form)
    return (reader if schema is None else reader.schema(schema)).load(path).drop("bucket")


def manifests_of(registry: DataFrame, pages: DataFrame, route: Column | str, parser: Column | str, ocr_mode: Column | str = "on", failures: DataFrame | None = None) -> DataFrame:
    """A manifest row per registry row: ``error`` where ``failures`` (source_id, error) has the source, else ``ok`` with pages, ``empty`` without.

    Route, parser and mode are values for all or Columns of the registry; a column ``process_time_sec`` of the registry is taken over, to three decimals.
    """
    value = lambda v: F.lit(v) if isinstance(v, str) else v
    time = F.round(F.col("process_time_sec").cast("double"), 3) if "process_time_sec" in registry.columns else F.lit(None).cast("double")
    rows = registry.select("source_id", "file_path", "format", value(route).alias("route"), value(ocr_mode).alias("ocr_mode"), value(parser).alias("parser"), time.alias("process_time_sec"))
    count = pages.groupBy("source_id").agg(F.countDistinct("page").cast("int").alias("page_count"))
    rows = rows.join(count, "source_id", "left").withColumn("page_count", F.coalesce("page_count", F.lit(0)))
    rows = rows.withColumn("error", F.lit(None).cast("string")) if failures is None else rows.join(failures.groupBy("source_id").agg(F.min("error").alias("error")), "source_id", "left")
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("page_count") > 0, "ok").otherwise("empty")
    return rows.select("source_id", "file_path", "format", status.alias("status"), "page_count", "error", F.array().cast("array<string>").alias("notes"), "route", "ocr_mode", "parser", "process_time_sec")


def policy_report(policy: DataFrame, path: str, workbook: str) -> None:
    """The policy rows as JSON lines, each with the registry it comes from under ``workbook``."""
    policy.withColumn("workbook", F.lit(workbook)).write.mode("overwrite").json(path)
