"""References to stored content: ``ref:sha256:<hash>[,<hash>...]``, hashes in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The format of a reference.
PREFIX = "ref:sha256:"
STRICT = "^ref:sha256:[0-9a-fA-F]{64}(,[0-9a-fA-F]{64})*$"


def make_ref(hashes: Column) -> Column:
    """hashes: an array of lower-case hex strings."""
    return F.concat(F.lit(PREFIX), F.array_join(hashes, ","))


def is_ref(value: Column) -> Column:
    """Only strictly formed references count; other text with the prefix stays text."""
    return F.coalesce(value.rlike(STRICT), F.lit(False))


def parse_ref(ref: Column) -> Column:
    """The hashes in order, in lower case; null for what isn't a reference."""
    return F.when(is_ref(ref), F.split(F.lower(F.substr(ref, F.lit(len(PREFIX) + 1))), ","))


def sha256(data: Column) -> Column:
    return F.sha2(data, 256)
