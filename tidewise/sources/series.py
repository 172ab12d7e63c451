"""Series payloads: ``{"data": [{"period": ..., "value": ...}, ...]}``.

S1 parses payloads into (date, value); S1b derives the frequency from the
series id; S2 attaches the catalog of named series; K3 maps the long series
frame to the stored tables. Payloads are rows of a DataFrame (one JSON
document per row, e.g. one API page per file read with ``wholetext``), so a
landing folder of any size is parsed in parallel with no driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.functions.nulls import nan_to_null

SERIES_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("period", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

# Fixed catalog of the named core series (name, series id).
SERIES_IDS = {
    "henry_hub_spot": "NG.RNGWHHD.D",
    "storage": "NG.NW2_EPG0_SWO_R48_BCF.W",
    "production": "NG.N9010US2.M",
    "consumption": "NG.N3010US2.M",
    "lng_exports": "NG.N9130US2.M",
}


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (source_file, payload). The series id is the file
    name without extension."""
    df = spark.read.text(path, wholetext=True)
    f = F.input_file_name()
    return df.select(
        f.alias("source_file"),
        F.regexp_extract(f, r"([^/]+?)(\.json)?$", 1).alias("series_id"),
        F.col("value").alias("payload"),
    )


def frequency(series_id: F.Column) -> F.Column:
    """Frequency from the id suffix (.D daily, .W weekly, .M monthly)."""
    return (F.when(series_id.endswith(".D"), "daily").when(series_id.endswith(".W"), "weekly")
            .when(series_id.endswith(".M"), "monthly"))


CORRUPT = "_corrupt_record"


def from_payload(payload: F.Column, schema: T.StructType, on_corrupt: str = "raise") -> F.Column:
    """Parsed JSON. A payload that is NULL or not a complete JSON document is
    an incomplete result: it fails the job, or with ``on_corrupt="skip"``
    gives NULL (``corrupt_payloads`` returns those rows)."""
    if on_corrupt not in ("raise", "skip"):
        raise ValueError(on_corrupt)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(payload, wide, {"columnNameOfCorruptRecord": CORRUPT})
    bad = payload.isNull() | parsed[CORRUPT].isNotNull()
    if on_corrupt == "skip":
        return F.when(~bad, parsed)
    return F.when(bad, F.raise_error(F.lit("corrupt payload")).cast(wide)).otherwise(parsed)


def corrupt_payloads(payloads: DataFrame, schema: T.StructType = SERIES_SCHEMA, payload_col: str = "payload") -> DataFrame:
    """The rows of ``payloads`` that do not parse."""
    return payloads.filter(from_payload(F.col(payload_col), schema, "skip").isNull())


def parse_series(payloads: DataFrame, payload_col: str = "payload", keep: tuple[str, ...] = ("series_id",),
                 start: str | None = None, end: str | None = None, on_corrupt: str = "raise") -> DataFrame:
    """Payload rows -> (keep..., date, value).

    A corrupt payload fails the job unless ``on_corrupt="skip"``.

    ``period`` may be a day or a month (``yyyy-MM`` -> first of month); a
    malformed period fails the job (strict). Values that are not numbers
    become NULL and, like any row with a NULL, are dropped. A payload with no
    ``data`` contributes no rows. Optional inclusive date bounds.
    """
    parsed = payloads.select(*keep, from_payload(F.col(payload_col), SERIES_SCHEMA, on_corrupt).alias("_p"))
    rows = parsed.select(*keep, F.explode("_p.data").alias("_r"))
    out = rows.select(
        *keep,
        F.to_date(F.col("_r.period")).alias("date"),
        nan_to_null(F.col("_r.value").try_cast("double")).alias("value"),
    ).dropna(subset=["date", "value"])
    if start:
        out = out.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        out = out.filter(F.col("date") <= F.lit(end).cast("date"))
    return out


def core_series(payloads: DataFrame, start: str | None = None, end: str | None = None,
                on_corrupt: str = "raise") -> DataFrame:
    """All named series in one pass -> long (series, series_id, frequency,
    date, value). The five-entry catalog is a literal map lookup (no join);
    unknown series ids are dropped."""
    names = F.create_map(*[e for k, v in SERIES_IDS.items() for e in (F.lit(v), F.lit(k))])
    parsed = parse_series(payloads, start=start, end=end, on_corrupt=on_corrupt)
    sid = F.col("series_id")
    return parsed.select(names[sid].alias("series"), "series_id", frequency(sid).alias("frequency"), "date",
                         "value").filter(F.col("series").isNotNull())


def _null_d() -> F.Column:
    return F.lit(None).cast("double")


def series_to_tables(long: DataFrame) -> dict[str, DataFrame]:
    """K3: long series frame -> stored-table frames (consumption has no table
    and is not stored)."""
    s = F.col("series")
    return {
        "prices": long.filter(s == "henry_hub_spot").select(
            "date", F.lit("HenryHub").alias("hub"), F.col("value").alias("spot_price"),
            _null_d().alias("front_month"), _null_d().alias("m1_m2_spread")),
        "storage_weekly": long.filter(s == "storage").select(
            F.col("date").alias("report_date"), F.col("value").alias("working_gas"), _null_d().alias("five_year_avg"),
            _null_d().alias("yoy_deviation"), _null_d().alias("wow_change")),
        "production_monthly": long.filter(s == "production").select(
            F.col("date").alias("month"), F.col("value").alias("dry_gas_bcfpd")),
        "lng_monthly": long.filter(s == "lng_exports").select(
            F.col("date").alias("month"), F.col("value").alias("exports_bcf"), _null_d().alias("avg_price"),
            F.lit("").alias("terminal_notes"), _null_d().alias("lng_capacity_bcfpd")),
    }


def pages(series: DataFrame, series_id: str, value_col: str, date_col: str = "date", monthly: bool = False,
          bad_value_day: int | None = None) -> DataFrame:
    """Build API-style payload pages from a series frame (one page per
    calendar month, or per year for a monthly series) - the landing format
    S1 reads. A NULL value is written as JSON null; on ``bad_value_day`` the
    value is written as the non-number ``"x"``."""
    d = F.col(date_col)
    period = F.date_format(d, "yyyy-MM") if monthly else F.date_format(d, "yyyy-MM-dd")
    value = F.col(value_col).cast("string")
    if bad_value_day is not None:
        value = F.when(F.dayofmonth(d) == bad_value_day, F.lit("x")).otherwise(value)
    page = F.date_format(d, "yyyy") if monthly else F.date_format(d, "yyyy-MM")
    rows = series.select(page.alias("_page"), F.struct(period.alias("period"), value.alias("value")).alias("_r"))
    grouped = rows.groupBy("_page").agg(F.array_sort(F.collect_list("_r")).alias("data"))
    return grouped.select(F.lit(series_id).alias("series_id"), "_page",
                          F.to_json(F.struct("data"), {"ignoreNullFields": "false"}).alias("payload"))
