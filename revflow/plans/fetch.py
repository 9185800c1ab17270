"""From delivered envelopes to one report per table: decode, align, add tenants."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from revflow.functions.names import distinct_names
from revflow.functions.text import trim_all
from revflow.operators.ledger import active_reports
from revflow.operators.shape import tenant_columns
from revflow.sinks.files import write_report_csv
from revflow.sources.envelopes import decode_with_faults, records_by_name, records_by_position

_IDS = ["customer_account", "instance_key"]


def chosen_payloads(payloads: DataFrame, ledger: DataFrame) -> DataFrame:
    """Payloads of active runs of the ledger.

    ``payloads`` holds (customer_account, instance_key, report_name,
    identifier, xml). A run is unique among the active ones of its instance, so
    the join only filters; the XML moves no further than that join.
    """
    of_instance = "instance_key" in ledger.columns
    active = active_reports(ledger, per_instance=of_instance)
    same = [payloads[k] == active[k] for k in ("customer_account", "report_name", "identifier")]
    if of_instance:
        same.append(F.coalesce(payloads["instance_key"], F.lit("")) == active["instance_key"])
    return payloads.join(active, reduce(Column.__and__, same), "left_semi")


class UnreadablePayloads(ValueError):
    """Payloads or records that cannot be spooled whole."""


def report_rows(decoded: DataFrame, header: Sequence[str], by_position: bool = False) -> DataFrame:
    """Decoded records of one report with the tenant columns in front."""
    names = _column_names(header)
    if by_position:
        rows = records_by_position(decoded, names, keep=_IDS)
    else:
        rows = records_by_name(decoded, header, keep=_IDS, names=names)
    return tenant_columns(rows, rows["customer_account"], rows["instance_key"])


def _column_names(header: Sequence[str]) -> list[str]:
    """Names for the cells of a header that differ in more than case, from the tenant columns too."""
    taken, out = set(_IDS), []
    for cell in distinct_names([c or "unnamed" for c in header]):
        name, number = cell, 0
        while name.lower() in taken:
            number += 1
            name = f"{cell}.{number}"
        taken.add(name.lower())
        out.append(name)
    return out


def delivered_headers(decoded: DataFrame) -> DataFrame:
    """(report_name, header, further): per report the header of its lowest account and member.

    ``further`` lists cells that only other members have, a cell once more for
    each time that they repeat it more often.
    """
    return _headers(decoded).select("report_name", "header", "further")


def _headers(decoded: DataFrame) -> DataFrame:
    """Delivered headers, with the cells (``longer``) by which the longest header of a report exceeds its header."""
    cells = F.transform("header", trim_all)
    members = decoded.select("report_name", *_IDS, "member", cells.alias("header")).distinct()

    def ranked(header: str) -> Column:
        rank = lambda c, i: F.size(F.filter(F.slice(header, F.lit(1), i), lambda x: x == c))
        return F.transform(header, lambda c, i: F.struct(c.alias("cell"), rank(c, i).alias("rank")))

    return (
        members.withColumn("_ranked", ranked("header"))
        .groupBy("report_name")
        .agg(
            F.min_by("header", F.struct(*_IDS, "member")).alias("header"),
            F.min_by("_ranked", F.struct(*_IDS, "member")).alias("_ranked"),
            F.array_distinct(F.flatten(F.collect_set("_ranked"))).alias("_all"),
            F.min_by("header", F.struct(-F.size("header"), *_IDS, "member")).alias("_longest"),
        )
        .select(
            "report_name",
            "header",
            F.transform(F.array_sort(F.array_except("_all", "_ranked")), lambda c: c["cell"]).alias("further"),
            F.slice("_longest", F.size("header") + 1, F.size("_longest")).alias("longer"),
        )
    )


def spool_reports(
    payloads: DataFrame,
    root: str,
    headers: dict[str, Sequence[str]] | None = None,
    quarantine: str | None = None,
    by_position: bool = False,
) -> dict[str, str]:
    """Write each report as CSV per instance; returns report to path.

    Every payload is decoded once, into a folder below ``root`` by report. Unless
    ``quarantine`` names a folder, anything unreadable (XML, base64, zip, text,
    records longer than their header) refuses the whole call; with it, the faults
    are written there, with the header and the fields that could be read, and the
    rest is spooled. Without given headers every report among the payloads is
    spooled whole: under the header of its lowest account and member, followed by the
    cells that only others have (by position: by the end of the longest header),
    which are NULL where they were not delivered. Given headers choose the
    columns. A report without records is not written.
    """
    spark = payloads.sparkSession
    stage = f"{root}/_decoded-{uuid.uuid4().hex[:12]}"
    decoded = decode_with_faults(payloads, "xml", [*_IDS, "report_name"]).withColumn("ok", F.col("fault").isNull())
    decoded.write.partitionBy("ok", "report_name").parquet(stage)
    everything = spark.read.schema(decoded.schema).parquet(stage)
    faults = everything.filter("NOT ok").select(*_IDS, "report_name", "member", "fault", "header", "fields")
    if quarantine is not None:
        faults.write.mode("append").parquet(quarantine)
    else:
        bad = faults.groupBy("fault").agg(F.count("*").alias("n")).orderBy("fault").collect()
        if bad:
            raise UnreadablePayloads("; ".join(f"{r.n} x {r.fault}" for r in bad))
    decoded = everything.filter("ok")
    if headers is None:
        more = "longer" if by_position else "further"
        headers = {r.report_name: [*r.header, *r[more]] for r in _headers(decoded).collect()}
    return {
        report: write_report_csv(
            report_rows(decoded.filter(F.col("report_name") == report), header, by_position), root, report
        )
        for report, header in headers.items()
        if header
    }
