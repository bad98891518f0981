"""Transaction files in and result / audit tables out.

Transaction CSVs are read with a declared schema: inference would guess
``time`` (``09:30:00.000000``) as a timestamp on *today's* date and make the
data depend on the day it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column layout of an ATM transaction file.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("session_id", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("txn_source_code", T.StringType()),
    T.StructField("cash_amount", T.IntegerType()),
    T.StructField("cheque_amount", T.IntegerType()),
    T.StructField("transaction_total_amount", T.IntegerType()),
    T.StructField("cash_transaction", T.BooleanType()),
    T.StructField("time", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("transaction_status_code", T.StringType()),
    T.StructField("transaction_global_currency_code", T.StringType()),
    T.StructField("credit_debit_code", T.StringType()),
    T.StructField("transaction_code", T.StringType()),
    T.StructField("batch_process_date", T.StringType()),
    T.StructField("check_cheque_transaction", T.StringType()),
])

TRANSACTION_TIME_FORMAT = "d/M/y HH:mm:ss.SSSSSS"


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA,
                   header: bool = True) -> DataFrame:
    """CSV with a declared schema (FAILFAST: a bad row is an error).

    With a header, columns are matched by name, in any order; a missing,
    unknown or repeated name is an error. Every file of a folder must have
    the header of the first (``enforceSchema`` off: another order fails
    instead of shifting values).
    """
    reader = spark.read.option("header", header).option("mode", "FAILFAST")
    if not header:
        return reader.schema(schema).csv(path)
    found = [c.strip() for c in reader.csv(path).columns]
    if sorted(found) != sorted(schema.fieldNames()):
        raise ValueError(f"{path}: header {found} does not name the columns {schema.fieldNames()}")
    in_file = T.StructType([schema[c] for c in found])
    return reader.option("enforceSchema", False).schema(in_file).csv(path).select(*schema.fieldNames())


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA,
                          ) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of CSV files with headers: a bad row goes to a side table instead of ending the load.

    Each file's own header orders its columns, so the files of a folder may
    differ in order. ``good`` has the declared columns. ``rejected`` has
    ``file``, ``row`` (the line) and ``reason``: the line does not fit the
    schema (a value of another type, too few or too many values), or no line of
    its file names the columns. Header and blank lines are in neither, every
    other line is in exactly one. A row is one line: quoted values may hold
    commas but no line breaks.
    """
    names = schema.fieldNames()
    spelled = F.transform(F.split(F.regexp_replace("value", r'["\r\uFEFF]', ""), ","), lambda c: F.trim(c))
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
             .withColumn("__header", F.when(F.array_sort(spelled) == F.array(*[F.lit(n) for n in sorted(names)]),
                                            F.array_join(spelled, ","))))
    # one row per file; the layouts are orders of the declared names that really occur
    heads = lines.where("__header is not null").groupBy("file").agg(F.min("__header").alias("layout"))
    layouts = sorted(r["layout"] for r in heads.select("layout").distinct().collect())
    rows = lines.where(F.col("__header").isNull() & (F.trim("value") != "")).drop("__header").join(heads, "file", "left")
    parsed = F.lit(None).cast(T.StructType([*schema.fields, T.StructField("__bad", T.StringType())]))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    for layout in layouts:
        in_file = T.StructType([schema[c] for c in layout.split(",")] + [T.StructField("__bad", T.StringType())])
        found = F.from_csv("value", in_file.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
        parsed = F.when(F.col("layout") == layout, F.struct(*[found[c].alias(c) for c in names], found["__bad"].alias("__bad"))).otherwise(parsed)
    read = rows.withColumn("__row", parsed)
    reason = (F.when(F.col("layout").isNull(), "no header of the file names the columns")
              .when(F.col("__row.__bad").isNotNull(), "the line does not fit the schema"))
    read = read.withColumn("__reason", reason)
    good = read.where("__reason is null").select(*[F.col("__row")[c].alias(c) for c in names])
    return good, read.where("__reason is not null").select("file", F.col("value").alias("row"), F.col("__reason").alias("reason"))


def transaction_timestamp(date_col: str = "date", time_col: str = "time") -> Column:
    """``dd/MM/yyyy`` date + ``HH:mm:ss.SSSSSS`` time -> TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(F.concat_ws(" ", F.col(date_col), F.col(time_col)),
                              F.lit(TRANSACTION_TIME_FORMAT))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """Write a result as header CSV, one file per task (no forced single
    partition: that would funnel the whole result through one task). An
    existing folder is refused unless ``mode`` says otherwise."""
    df.write.mode(mode).option("header", header).csv(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows (e.g. the audit frame) to a table folder."""
    df.write.mode("append").format(fmt).save(path)
