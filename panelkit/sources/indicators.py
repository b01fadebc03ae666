"""Indicator API payloads -> long records -> wide table (S4, U2, U4, A22, A23),
and the CSV files of both (S3, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from panelkit.functions.text import safe_double

BOM = "\ufeff"

RECORD = ArrayType(StructType([
    StructField("indicator", StructType([StructField("id", StringType()), StructField("value", StringType())])),
    StructField("country", StructType([StructField("id", StringType()), StructField("value", StringType())])),
    StructField("date", StringType()),
    StructField("value", DoubleType()),
]))


def indicator_records(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """S4 + U2: each payload is ``[meta, [records...]]``; a missing or empty
    second element yields no rows.  A falsy value (null or 0) becomes null —
    the source API's convention, kept on purpose."""
    recs = F.from_json(F.get_json_object(F.col(body_col), "$[1]"), RECORD)
    r = payloads.select(F.explode(recs).alias("r"))
    return r.select(F.col("r.country.value").alias("pais"), F.col("r.indicator.id").alias("codigo"),
                    F.col("r.indicator.value").alias("indicador"), F.col("r.date").cast("int").alias("anio"),
                    F.nullif(F.col("r.value"), F.lit(0.0)).alias("valor"))


def indicator_wide(records: DataFrame, years: list[int] | None = None) -> DataFrame:
    """U4: one row per indicator, one column per year, first non-null value;
    years with no value at all do not appear.  The year list is bounded by
    the calendar (taken from the data when not given)."""
    r = records.where(F.col("valor").isNotNull())
    years = years or sorted(x[0] for x in r.select("anio").distinct().collect())
    return (r.groupBy("codigo", "indicador").pivot("anio", years)
             .agg(F.min_by("valor", "anio")))


def indicator_coverage(records: DataFrame) -> DataFrame:
    """Per indicator, years with a value vs years present in the
    payloads (rows count even when null) and a complete flag."""
    n_years = records.select(F.count_distinct("anio")).scalar()
    g = records.groupBy("codigo").agg(F.count("valor").alias("anios_con_dato"),
                                      F.count_distinct("anio").alias("anios_en_registro"))
    return g.withColumns({"anios_total": n_years, "completo": F.col("anios_con_dato") == n_years})


def indicators_per_year(records: DataFrame) -> DataFrame:
    """Distinct indicators per year (null values included)."""
    return records.groupBy("anio").agg(F.count_distinct("codigo").alias("indicadores"))


# ------------------------------------------------------------------ files
def write_csv(df: DataFrame, path: str, order: str | None = None) -> None:
    """K7: CSV with a header and a byte-order mark, which spreadsheet programs
    need to read it as UTF-8.  ``order``: a column that gives the row order and is not written."""
    if order:
        df = df.orderBy(order).drop(order)
    df.withColumnRenamed(df.columns[0], BOM + df.columns[0]).write.csv(path, header=True, encoding="UTF-8", escape='"')


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the file's header, with or without a byte-order mark."""
    df = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", escape='"', multiLine=False)
    return df.toDF(*[c.removeprefix(BOM) for c in df.columns])


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: the columns whose names are numbers are years; their cells become
    numbers, and what is none becomes null.  ``_row`` keeps the order of the rows."""
    df = read_csv(spark, path).withColumn("_row", F.monotonically_increasing_id())
    return df.select(*[safe_double(F.col(f"`{c}`")).alias(c) if c.isdigit() else F.col(f"`{c}`") for c in df.columns])


def wide_to_long(wide: DataFrame, code_col: str, name_col: str = "indicador") -> DataFrame:
    """(code, name, anio, valor): a row per cell."""
    years = [c for c in wide.columns if c.isdigit()]
    long = wide.unpivot([code_col, name_col], years, "anio", "valor")
    return long.withColumn("anio", F.col("anio").cast("int"))


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    """The long records, typed again."""
    df = read_csv(spark, path)
    return df.select(*[F.col(c).cast("int") if c == "anio" else safe_double(F.col(c)).alias(c) if c == "valor" else F.col(c) for c in df.columns])
