"""Raw sheets -> entities with ids."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from taskspark import vocab
from taskspark.functions.texts import blank_nulls
from taskspark.operators.ids import dense_ids
from taskspark.session import store_and_reload


@dataclass(frozen=True)
class Extract:
    """Columns one entity takes from a sheet, and how its rows are ordered."""

    sheet: str
    columns: tuple[str, ...]
    sort: tuple[str, ...]
    distinct: bool = True


@dataclass(frozen=True)
class Sheet:
    headings: Mapping[str, str]
    blank: bool = False


SHEETS = {
    "layouttype": Sheet(vocab.LAYOUTTYPE_HEADINGS),
    "pwc_engineprogram": Sheet(vocab.ENGINEPROGRAM_HEADINGS),
    "sap_raw_extract": Sheet(vocab.SAP_HEADINGS, blank=True),
    "categories": Sheet({}),
}

EXTRACTS = {
    "DamageCode": Extract("layouttype", ("DamageCode", "DamageText"), ("DamageCode",)),
    "CauseCode": Extract("layouttype", ("CauseCode", "CauseText"), ("CauseCode",)),
    "LayoutType": Extract(
        "layouttype",
        ("Notification", "Sort_Number", "Text", "DamageCode", "CauseCode"),
        ("Notification", "Sort_Number"),
        distinct=False,
    ),
    "CodingCode": Extract("pwc_engineprogram", ("Coding", "CodingText"), ("Coding",)),
    "EngineProgram": Extract(
        "pwc_engineprogram",
        ("Notification", "Coding", "Description"),
        ("Notification",),
        distinct=False,
    ),
    "GroupCode": Extract("sap_raw_extract", ("GroupCode", "GroupText"), ("GroupCode",)),
    "TaskCode": Extract(
        "sap_raw_extract", ("TaskCode", "TaskCodeText", "GroupCode"), ("TaskCode",)
    ),
    "SupplierVendor": Extract("sap_raw_extract", ("SupplierVendor",), ("SupplierVendor",)),
    "TaskOwner": Extract("sap_raw_extract", ("TaskOwner",), ("TaskOwner",)),
    "TaskStatus": Extract("sap_raw_extract", ("TaskStatus",), ("TaskStatus",)),
    "Material": Extract(
        "sap_raw_extract", ("Material", "Description", "Category"), ("Material",)
    ),
    "LayoutTask": Extract(
        "sap_raw_extract",
        (
            "Notification", "Item", "Task", "Material", "Created_On", "Completed_On", "TaskText",
            "GroupCode", "TaskCode", "Planned_Start", "Planned_Finish", "SupplierVendor",
            "TaskOwner", "TaskStatus",
        ),
        ("Notification", "Item", "Task"),
    ),
    "Category": Extract("categories", ("Category",), ("Category",)),
}


def clean_sheet(sheet: str, raw: DataFrame) -> DataFrame:
    """Our headings; in the task sheet an empty cell is a value, in the others it is missing."""
    kind = SHEETS[sheet.lower()]
    df = raw.withColumnsRenamed(dict(kind.headings))
    return blank_nulls(df) if kind.blank else df


def entity_rows(entity: str, cleaned: DataFrame) -> DataFrame | None:
    """The entity's columns of a cleaned sheet; none when the sheet lacks one of them."""
    spec = EXTRACTS[entity]
    if not set(spec.columns) <= set(cleaned.columns):
        return None
    return cleaned.select(*spec.columns)


def extract(entity: str, raw: DataFrame) -> DataFrame | None:
    """One entity of its raw sheet, with ids."""
    return _number(entity, clean_sheet(EXTRACTS[entity].sheet, raw))


def _number(entity: str, cleaned: DataFrame) -> DataFrame | None:
    spec = EXTRACTS[entity]
    rows = entity_rows(entity, cleaned)
    return None if rows is None else dense_ids(rows, spec.sort, spec.distinct, staged=True)


def split_sheets(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All entities of the sheets we know; other sheets and missing columns are passed over.

    A sheet feeds up to eight entities. Its text is parsed once into Parquet, from which each
    entity then reads only its own columns.
    """
    found = {}
    for sheet, raw in sheets.items():
        if sheet.lower() not in SHEETS:
            continue
        cleaned = store_and_reload(clean_sheet(sheet, raw), "sheet")
        for entity, spec in EXTRACTS.items():
            rows = _number(entity, cleaned) if spec.sheet == sheet.lower() else None
            if rows is not None:
                found[entity] = rows
    return found
