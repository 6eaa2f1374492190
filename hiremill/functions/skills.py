"""Skill lists held in delimited strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hiremill.functions.text import _col, strip

# A comma always separates; a slash does unless it sits inside one of the two
# names kept whole, "ci/cd" and "a/b testing".
SEPARATOR = r",|/(?!(?<=ci/)cd|(?<=a/)b testing)"

# Literal stand-ins that read as the protected names in the output.
STAND_INS = {"ab_testing_placeholder": "a/b testing", "cicd_placeholder": "ci/cd"}


def parse_skills(c: Column | str) -> Column:
    """Distinct lower-case skills named in a ``,`` and ``/`` delimited text; ``[]`` for NULL."""

    def clean(part: Column) -> Column:
        part = strip(part)
        for stand_in, name in STAND_INS.items():
            part = F.replace(part, F.lit(stand_in), F.lit(name))
        return part

    parts = F.transform(F.split(F.lower(_col(c)), SEPARATOR), clean)
    skills = F.array_distinct(F.filter(parts, lambda s: s != ""))
    return F.coalesce(skills, F.array().cast("array<string>"))


def union_skills(c: Column | str) -> Column:
    """Distinct skills over an array of raw skill strings."""
    return F.array_distinct(F.flatten(F.transform(_col(c), parse_skills)))
