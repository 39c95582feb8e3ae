"""XML fragments of the partner feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postfeed.functions.keys import blank_default, feed_key
from postfeed.functions.text import escape_cdata

# The child elements of a job in feed order, the column each one shows,
# and the text between the opening tag and the CDATA section.
JOB_CHILDREN = [
    ("partnerJobId", "feed_key", ""),
    ("company", "company", ""),
    ("title", "position", ""),
    ("description", "description", ""),
    ("applyUrl", "apply_url", ""),
    ("companyId", "company_id", " "),
    ("location", "location", ""),
    ("workplaceTypes", "workplace_types", ""),
    ("experienceLevel", "experience_level", ""),
    ("jobtype", "jobtype", ""),
]
XML_DECLARATION = '<?xml version="1.0" encoding="UTF-8"?>'


def job_element() -> Column:
    """One ``<job>`` element, for a DataFrame with the published columns."""
    lines = [F.lit(" <job>")]
    for tag, column, gap in JOB_CHILDREN:
        value = feed_key() if column == "feed_key" else blank_default(column)
        lines.append(F.concat(F.lit(f"  <{tag}>{gap}<![CDATA["), escape_cdata(value), F.lit(f"]]></{tag}>")))
    lines.append(F.lit(" </job>"))
    return F.concat_ws("\n", *lines)


def feed_head(build_date: Column) -> Column:
    return F.concat(F.lit(f"{XML_DECLARATION}\n<source>\n <lastBuildDate> "), build_date, F.lit(" </lastBuildDate>"))


def feed_tail() -> Column:
    return F.lit("</source>")
