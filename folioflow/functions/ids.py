"""Title normalisation and the key derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_title(title: Column) -> Column:
    """Lower case, everything but ASCII letters, digits and white space as a blank, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(title), r"[^a-z0-9]", " "), r" +", " "))


def paper_id_from_title(title: Column) -> Column:
    """SHA-1 of the normalised title; null where nothing is left of it."""
    return F.when(normalized_title(title) != "", F.sha1(normalized_title(title)))


def canonical_paper_id(paper_id: Column, title: Column) -> Column:
    """The given id in lower case; where it is missing or blank, the id of the title."""
    given = F.lower(F.trim(paper_id))
    return F.when(given != "", given).otherwise(paper_id_from_title(title))
