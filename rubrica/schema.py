"""Column names of a budget-execution extract and the rules of the netting step."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The columns of a report, in sheet order.
UNIT_KEY = ("ugb", "funcao", "programa", "fr")
CLASSIFIER = "ced"
BUDGET_METRICS = (
    "dotacao_inicial",
    "dotacao_revista",
    "dotacao_actualizada_da",
    "dotacao_disponivel",
    "dotacao_cabimentada_dc",
    "ad_fundos_concedidos_af",
)
EXPENSE_METRICS = (
    "despesa_paga_via_directa_dp",
    "ad_fundos_desp_paga_vd_afdp",
    "ad_fundos_liquidados_laf",
    "despesa_liquidada_via_directa_lvd",
    "liq_ad_fundos_via_directa_lafvd",
)
METRICS = BUDGET_METRICS + EXPENSE_METRICS

#: A file without one of these cannot be processed and is rejected.  The
#: metrics are a column range, so only its two ends are compulsory.
REQUIRED_COLUMNS = UNIT_KEY + (CLASSIFIER, METRICS[0], METRICS[-1])

#: Every fact table carries the report it came from and the place of the row in it.
SOURCE_FILE = "source_file"
ROW_ORDER = "row_order"

#: Metrics are binary floating point, as in the reports' own tools.  With cents
#: the last digits of a sum then depend on the order of addition; EXACT does not
#: have that and costs more time.
MONEY = "double"
EXACT = "decimal(18,2)"

LEVELS = ("A", "B", "C", "D")

# What the published flags of a row say.
KEEP, REMOVE = "Keep", "Remove"


@dataclass(frozen=True)
class Rules:
    """Switches between the generations of the netting step.

    prefilter
        Drop rows of unknown units and rows without classifier first.  Without
        it they are only flagged, and the flags stay in the result.
    lone_d
        ``"drop"`` or ``"keep"`` a D row whose group has no C, B or A.
    lone_c
        Level that keeps a C row with neither B nor A below it: ``"D"``
        (priority 4) or ``"C"`` (priority 3).
    c_over_a
        ``"leave"`` keeps a C row with only A rows below it as it is,
        ``"subtract"`` takes the A rows off.
    a_rows
        ``"own_level"`` ranks A rows first (priority 1); ``"as_children"``
        keeps them only as children of the B level (priority 2).
    dedup_key
        ``"prefix5"``: unit key and first five digits; ``"unit_ced"``: unit key
        and whole classifier; ``"ced"``: whole classifier, across units.
    null_keys
        ``"merge"``: rows with any missing key part form one group per file;
        ``"separate"``: a missing part is a value like any other.
    """

    prefilter: bool = True
    lone_d: str = "drop"
    lone_c: str = "D"
    c_over_a: str = "leave"
    a_rows: str = "own_level"
    dedup_key: str = "prefix5"
    null_keys: str = "merge"

    _CHOICES = {
        "lone_d": ("drop", "keep"),
        "lone_c": ("D", "C"),
        "c_over_a": ("leave", "subtract"),
        "a_rows": ("own_level", "as_children"),
        "dedup_key": ("prefix5", "unit_ced", "ced"),
        "null_keys": ("merge", "separate"),
    }

    def __post_init__(self):
        for name, allowed in self._CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")

    def but(self, **changes) -> "Rules":
        return replace(self, **changes)


PRODUCTION = Rules()
UNFILTERED = Rules(prefilter=False)
SECOND_GENERATION = Rules(
    prefilter=False, lone_d="keep", lone_c="C", c_over_a="subtract", a_rows="as_children"
)
SECOND_GENERATION_ALL_A = SECOND_GENERATION.but(a_rows="own_level")
BY_CLASSIFIER = SECOND_GENERATION.but(dedup_key="ced")
