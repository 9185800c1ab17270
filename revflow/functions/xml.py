"""Elements of small XML documents held in a text column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
_BROKEN = "_corrupt_record"


def elements(xml: Column, *names: str) -> Column:
    """Struct of the root's child elements as text, namespaced or not.

    A missing element is NULL, an empty one an empty string; broken XML gives
    NULLs and fills ``_corrupt_record``.
    """
    fields = ", ".join(f"{n} string" for n in (*names, _BROKEN))
    return F.from_xml(xml, fields, _OPTIONS)


def is_broken(parsed: Column) -> Column:
    return parsed.isNull() | parsed[_BROKEN].isNotNull()
