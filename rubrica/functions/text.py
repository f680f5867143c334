"""Text helpers: column expressions and header names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word starts with a letter; an apostrophe, full stop or colon between two
# letters does not end it.  Everything else is kept as it stands.
_WORD_OR_GAP = r"\p{L}[\p{L}\p{M}\p{N}_]*(?:['’.:·]\p{L}[\p{L}\p{M}\p{N}_]*)*|[^\p{L}]+"


def blank_to_null(c: Column | str) -> Column:
    """Trim a cell; an empty cell is NULL."""
    return F.nullif(F.btrim(c, F.lit(" \t\r\n\f\v")), F.lit(""))


def strip_decimal_zeros(c: Column | str) -> Column:
    """``"121101.0"`` -> ``"121101"`` (a code that a spreadsheet stored as a number)."""
    return F.regexp_replace(c, r"\.0+$", "")


def title_case(c: Column | str) -> Column:
    """First letter of each word upper, the rest lower, also after a hyphen."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), F.lit(0))
    return F.array_join(F.transform(pieces, F.initcap), "")


def recode(c: Column | str, old: str, new: str) -> Column:
    """Replace one sentinel value; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == old, F.lit(new)).otherwise(c)


def clean_name(name: str) -> str:
    """One header cell as an ASCII lower snake_case name."""
    name = re.sub(r"['\"`´’]", "", name)
    name = name.replace("%", "_percent_").replace("#", "_number_")
    name = unicodedata.normalize("NFKD", name)
    name = "".join(ch for ch in name if not unicodedata.combining(ch))
    name = name.encode("ascii", "ignore").decode("ascii")
    name = re.sub(r"([a-z])([A-Z])", r"\1_\2", name)
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_").lower()
    return f"x{name}" if not name or name[0].isdigit() else name


def clean_names(names: list[str]) -> list[str]:
    """Header row -> column names.

    Blank and repeated header cells first get their position appended, as a
    spreadsheet reader does; names that clean to the same text get ``_2``, ``_3``.
    """
    raw = [n or "" for n in names]
    raw = [
        f"{n}...{i}" if not n.strip() or raw.count(n) > 1 else n for i, n in enumerate(raw, start=1)
    ]
    seen: dict[str, int] = {}
    out = []
    for name in map(clean_name, raw):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
