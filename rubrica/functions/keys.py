"""Unit ids, classifier prefixes, row ids, levels and row flags."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CLASSIFIER, LEVELS, MONEY, SOURCE_FILE, UNIT_KEY, Rules
from .text import blank_to_null

PREFIX_LENGTHS = (5, 4, 3, 2)


def unit_id(ugb: Column | str = "ugb") -> Column:
    return F.substring(ugb, 1, 9)


def ced_prefix(length: int, ced: Column | str = CLASSIFIER) -> Column:
    return F.substring(ced, 1, length)


def row_id(*parts: Column | str) -> Column:
    """Parts joined by ``_``; NULL as soon as one part is NULL."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[x for c in cols for x in (F.lit("_"), c)][1:])


def ced_level(ced: Column | str = CLASSIFIER) -> Column:
    """Level of a classifier by its trailing zeros; NULL for a NULL classifier."""
    c = F.col(ced) if isinstance(ced, str) else ced
    return (
        F.when(c.endswith("0000"), "D")
        .when(c.endswith("000"), "C")
        .when(c.endswith("00"), "B")
        .when(c.isNotNull(), "A")
    )


#: One bit per level, so that the levels present in a group are one number; the highest is for rows without level.
LEVEL_BIT = {"A": 1, "B": 2, "C": 4, "D": 8, None: 16}


def level_bit() -> Column:
    """The bit of a row's level."""
    bit = F.when(F.col("ced_group").isNull(), LEVEL_BIT[None])
    for name in LEVELS:
        bit = bit.when(F.col("ced_group") == name, LEVEL_BIT[name])
    return bit


def has_level(mask: Column | str, level: str | None) -> Column:
    """Whether a group with these level bits has rows of a level."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    return mask.bitwiseAND(LEVEL_BIT[level]) != 0


def level_tagged_id(with_ced: bool = True) -> Column:
    """Unit key and level as one id; the earlier form leaves the classifier out."""
    parts = [*UNIT_KEY, *([CLASSIFIER] if with_ced else []), "ced_group"]
    return row_id(*parts)


def derive_keys(df: DataFrame) -> DataFrame:
    """Add unit id, the four classifier prefixes and their row ids."""
    out = {"ugb_id": unit_id()}
    for k in PREFIX_LENGTHS:
        out[f"ced_base_{k}"] = ced_prefix(k)
        out[f"id_row_ced_{k}d"] = row_id(*UNIT_KEY, ced_prefix(k))
    return df.withColumns(out)


def classify_level(df: DataFrame) -> DataFrame:
    return df.withColumn("ced_group", ced_level())


def to_number(c: Column | str, metric_type: str = MONEY) -> Column:
    """Text as a number, NULL where it is none.

    A number ends in a digit or a point.  The double parser of the JVM would
    also take a type suffix ("1d"), and words for NaN and infinity.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.substring(F.rtrim(c), -1, 1) <= "9", c.try_cast(metric_type))


def cast_metrics(df: DataFrame, metrics, metric_type: str = MONEY) -> DataFrame:
    return df.withColumns({m: to_number(m, metric_type) for m in metrics})


def tidy_text(df: DataFrame, columns) -> DataFrame:
    """Trim the given text columns, blank cells becoming NULL."""
    return df.withColumns({c: blank_to_null(c) for c in columns})


def all_zero(metrics) -> Column:
    """True where every metric is zero; NULL where the rest are NULL."""
    return reduce(and_, [F.col(m) == 0 for m in metrics])


def drop_all_zero(df: DataFrame, metrics) -> DataFrame:
    """Keep rows with a non-zero metric; rows of only zeros and NULLs go."""
    return df.filter(~all_zero(metrics))


# -- grouping columns ---------------------------------------------------------

#: Grouping form of the unit key: the values themselves, or all NULL.
GROUP_UNIT = tuple(f"_{c}" for c in UNIT_KEY)


#: True where the unit key is blanked.
KEY_MISSING = "_missing"


def prefix_group(length: int) -> list[str]:
    """Grouping columns of one file, one unit key and one classifier prefix.

    Components, never the joined id: a hash partitioning on a short prefix then
    also serves every longer one.
    """
    return [SOURCE_FILE, *GROUP_UNIT, *[f"_c{k}" for k in range(2, length + 1)]]


def with_group_columns(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the grouping columns for prefixes of two to five digits.

    With ``null_keys="merge"`` a missing key part blanks the whole key, as a
    joined id would be NULL: such rows form one group per file.
    """
    parts = {g: F.col(c) for g, c in zip(GROUP_UNIT, UNIT_KEY)}
    parts |= {f"_c{k}": ced_prefix(k) for k in sorted(PREFIX_LENGTHS)}
    if rules.null_keys == "separate":
        return df.withColumns({**parts, KEY_MISSING: F.lit(False)})
    missing = reduce(or_, [F.col(c).isNull() for c in (*UNIT_KEY, CLASSIFIER)])
    parts = {n: F.when(~F.col(KEY_MISSING), c) for n, c in parts.items()}
    return df.withColumn(KEY_MISSING, missing).withColumns(parts)
