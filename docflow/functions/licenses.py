"""Licence names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of a Creative Commons licence.
ADDRESS = r"(?iU)creativecommons\.org/(licenses|publicdomain)/([a-z-]+)/(\d\.\d)"
NAME = r"(?iU)\bCC[\s-]?(0|BY(?:[\s-]?(?:NC|ND|SA))*)(?:[\s-]+(\d\.\d))?\b"


#: What a name may add to BY, with what stood before it.
ADDED = r"(?U)[\s-]?(?:NC|ND|SA)"


def normalize_license(raw: Column) -> Column:
    """CC-BY-4.0 and the like from an address or a name in raw; an address outranks a name; null if neither is there.

    CC0 has version 1.0 whatever raw says; other public-domain marks are not licences; a name may lack the version. Of the parts that a
    name adds to BY, the first always has a hyphen before it, the others where the name has something between them.
    """
    return F.when(raw.rlike(ADDRESS), _by_address(raw)).when(raw.rlike(NAME), _by_name(raw))


def _joined(*parts: Column) -> Column:
    """CC and what there is of parts."""
    return F.concat_ws("-", F.lit("CC"), *parts)


def _by_address(raw: Column) -> Column:
    family, variant, version = (F.upper(F.regexp_extract(raw, ADDRESS, i)) for i in (1, 2, 3))
    return F.when(family == "LICENSES", _joined(variant, version)).when(variant == "ZERO", F.lit("CC0-1.0"))


def _by_name(raw: Column) -> Column:
    added = F.transform(
        F.regexp_extract_all(F.upper(F.regexp_extract(raw, NAME, 1)), F.lit(ADDED), 0),
        lambda part, i: F.concat(F.when((i == 0) | (F.length(part) > 2), "-").otherwise(""), F.right(part, F.lit(2))),
    )
    version = F.nullif(F.regexp_extract(raw, NAME, 2), F.lit(""))
    return F.when(F.regexp_extract(raw, NAME, 1) == "0", F.lit("CC0-1.0")).otherwise(_joined(F.concat(F.lit("BY"), F.array_join(added, "")), version))
