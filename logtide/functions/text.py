"""Delimited lists, document ids and late-row lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.schemas import (
    COUNTRY_SEPARATOR,
    DOC_ID_BLANK,
    DOC_ID_BLANK_REPLACEMENT,
    DOC_ID_SEPARATOR,
    LATE_LINE_SEPARATOR,
    NULL_TEXT,
)


def split_countries(countries: Column) -> Column:
    """"FR,DE,IT" -> [FR, DE, IT]; empty pieces (e.g. a trailing comma) are dropped."""
    return F.filter(F.split(countries, COUNTRY_SEPARATOR), lambda x: x != "")


def doc_id(time: Column, type_: Column, area: Column) -> Column:
    return F.concat(
        F.replace(time, F.lit(DOC_ID_BLANK), F.lit(DOC_ID_BLANK_REPLACEMENT)),
        F.lit(DOC_ID_SEPARATOR), type_, F.lit(DOC_ID_SEPARATOR), area,
    )


def late_line(time_ms: Column, type_: Column, area: Column) -> Column:
    """``<ms>\\t<type>\\t<area>``; a null prints as ``null``."""
    return F.concat_ws(
        LATE_LINE_SEPARATOR,
        F.coalesce(time_ms.cast("string"), F.lit(NULL_TEXT)),
        F.coalesce(type_, F.lit(NULL_TEXT)),
        F.coalesce(area, F.lit(NULL_TEXT)),
    )
