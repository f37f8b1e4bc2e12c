"""What an image file name says about its subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The documented file-name convention.
STRICT_SUBJECT = r"^([0-9]{3})"
SIDE = r"^[^_]+_([LR])_"
FINGER = r"_(thumb|index|middle|ring|little)_"
SAMPLE_NUMBER = r"_([0-9]+)\.[A-Za-z]+$"

# Three decimal digits: no corpus can hold more strict subject ids than this.
MAX_STRICT_SUBJECTS = 1000


def file_name(path: Column | str) -> Column:
    """Last component of a path or URI."""
    return F.substring_index(path, "/", -1)


def subject_id_strict(name: Column | str) -> Column:
    """First three digits of the name; NULL where the name does not start so."""
    return F.nullif(F.regexp_extract(name, STRICT_SUBJECT, 1), F.lit(""))


def subject_id_prefix(name: Column | str) -> Column:
    """Text before the first underscore of the name without its extension.

    A different rule from :func:`subject_id_strict`: ``0011_x.bmp`` gives
    ``0011`` here and ``001`` there.
    """
    stem = F.regexp_replace(name, r"(.)\.[^.]*$", "$1")
    return F.substring_index(stem, "_", 1)


def name_attributes(df: DataFrame, name: str) -> DataFrame:
    """Adds side (L/R), finger and sample number; NULL where the name has none."""
    number = F.regexp_extract(name, SAMPLE_NUMBER, 1)
    return df.withColumns({
        "side": F.nullif(F.regexp_extract(name, SIDE, 1), F.lit("")),
        "finger": F.nullif(F.regexp_extract(name, FINGER, 1), F.lit("")),
        "sample_number": F.when(number != "", number.cast("long")),
    })
