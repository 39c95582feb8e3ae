"""Schemas of the posting tables, their revisions and the request log."""

from __future__ import annotations

from pyspark.sql import types as T

_STR = T.StringType()
_TS = T.TimestampNTZType()


def _posting(description: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("position", _STR, False),
            T.StructField(description, _STR),
            T.StructField("company", _STR),
            T.StructField("apply_url", _STR),
            T.StructField("company_id", _STR),
            T.StructField("location", _STR),
            T.StructField("workplace_types", _STR),
            T.StructField("experience_level", _STR),
            T.StructField("jobtype", _STR),
            T.StructField("partner_job_id", _STR),
            T.StructField("last_build_date", _TS),
            T.StructField("created_at", _TS),
            T.StructField("updated_at", _TS),
        ]
    )


PUBLISHED = _posting("description")
STAGING = _posting("job_description")

# The columns each schema revision added. Revision 5 added the staging table.
REVISION_COLUMNS = {
    1: ["id", "position", "created_at", "updated_at"],
    2: ["description"],
    3: ["company", "apply_url", "company_id", "location", "workplace_types", "experience_level", "jobtype"],
    4: ["partner_job_id", "last_build_date"],
    5: [],
}

# Column widths in characters.
MAX_LENGTHS = {
    "position": 255,
    "company": 255,
    "company_id": 255,
    "location": 255,
    "partner_job_id": 255,
    "workplace_types": 50,
    "experience_level": 50,
    "jobtype": 50,
}

# Widths in bytes of the long text columns, under their published and staging names.
MAX_BYTES = {"description": 65_535, "job_description": 65_535, "apply_url": 65_535}

GEO_DIM = T.StructType(
    [
        T.StructField("ip", _STR),
        T.StructField("success", T.BooleanType()),
        T.StructField("region_code", _STR),
        T.StructField("continent", _STR),
        T.StructField("city", _STR),
        T.StructField("country_code", _STR),
        T.StructField("country", _STR),
        T.StructField("region", _STR),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def revision_columns(revision: int) -> list[str]:
    """Columns a published table of the given revision holds, in table order."""
    if revision not in REVISION_COLUMNS:
        raise ValueError(f"unknown schema revision {revision}")
    have = {c for r, cols in REVISION_COLUMNS.items() if r <= revision for c in cols}
    return [f.name for f in PUBLISHED if f.name in have]
