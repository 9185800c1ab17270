"""Lookups of payer codes and levels of care."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Revenue and procedure codes and their level of care.
LEVELS_OF_CARE = {
    "126": "DTX", "1002": "RTC", "913": "PHP", "906": "IOP", "905": "IOP",
    "912": "PHP", "915": "OP", "128": "Dtx", "1001": "RTC", "H0010": "DTX",
    "156": "DTX", "H0018": "RTC", "S0201": "PHP", "H0015": "IOP",
    "S9480": "IOP", "H0019": "RTC", "H0035": "PHP", "H2036": "PHP",
    "90853": "OP", "H0011": "DTX", "S9475P": "PHP", "S9475": "IOP",
    "H2013": "IOP", "H0005": "OP",
    "0126": "DTX", "0906": "IOP", "0156": "DTX", "0913": "PHP",
}


def loc_crosswalk(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{code}', '{level}')" for code, level in LEVELS_OF_CARE.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS loc(rev_code, level_of_care)")


def level_of_care_join(
    df: DataFrame, code: str, out: str = "level_of_care", crosswalk: DataFrame | None = None
) -> DataFrame:
    """Add the level of care of a code, NULL when unknown; codes meet as text.

    The built-in crosswalk has 28 rows and is broadcast. One that is passed
    in is joined as its size allows: Spark broadcasts below its threshold and
    otherwise sorts and merges, splitting hot codes.
    """
    if crosswalk is None:
        crosswalk = F.broadcast(loc_crosswalk(df.sparkSession))
    right = crosswalk.select(
        F.col("rev_code").cast("string").alias("_code"), F.col("level_of_care").alias(out)
    )
    return df.join(right, df[code].cast("string") == right["_code"], "left").drop("_code")


def payer_code_join(df: DataFrame, crosswalk: DataFrame, name: str, repeated: str = "repeat") -> DataFrame:
    """Add ``payer_code`` by exact payer name.

    A name that the crosswalk lists twice repeats rows; with ``repeated="refuse"`` a row of such a
    name ends the job instead, naming it. The crosswalk grows with the payers, so nothing forces a broadcast.
    """
    right = crosswalk.select(F.col("payer_name").cast("string").alias("_payer"), "payer_code")
    if repeated == "refuse":
        right = right.groupBy("_payer").agg(F.first("payer_code").alias("payer_code"), F.count("*").alias("_times"))
        told = F.concat(F.lit("the crosswalk lists "), F.col("_payer"), F.lit(" "), F.col("_times").cast("string"), F.lit(" times"))
        joined = df.join(right, df[name] == right["_payer"], "left")
        single = F.when(F.col("_times") > 1, F.raise_error(told).cast("boolean")).otherwise(F.lit(True))
        return joined.filter(single).drop("_payer", "_times")
    return df.join(right, df[name] == right["_payer"], "left").drop("_payer")


def lookup_faults(df: DataFrame, column: str, lookup: DataFrame, key: str) -> DataFrame:
    """(value, fault, rows, matches, rows_added) of the values that a lookup does not give exactly one row for.

    ``fault`` is "unmatched" or "repeated". Both sides are counted per value before they meet, in one job,
    so that neither hot values nor the rows they multiply are moved.
    """
    left = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("rows"))
    right = lookup.groupBy(F.col(key).cast("string").alias("_key")).agg(F.count("*").alias("_n"))
    matches = F.coalesce("_n", F.lit(0))
    return (
        left.join(right, F.col("value") == F.col("_key"), "left")
        .select("value", "rows", matches.alias("matches"))
        .filter("matches <> 1")
        .select(
            "value",
            F.when(F.col("matches") == 0, "unmatched").otherwise("repeated").alias("fault"),
            "rows",
            "matches",
            (F.col("rows") * F.greatest(F.col("matches") - 1, F.lit(0))).alias("rows_added"),
        )
    )
