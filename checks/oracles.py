"""The same results in SQL, written level by level as the steps are described.

Nothing here shares logic with the Spark plans: each level is its own CTE over
joined text ids, and the union of the levels is ranked at the end.
"""

from __future__ import annotations

from rubrica.schema import BUDGET_METRICS, EXPENSE_METRICS, METRICS

from . import adapter

_TABLES = {n: n for n in ("lineitem", "supplier", "nation", "region", "part")}
_ORDER = ", ".join(adapter.FILE_ORDER)
_KEY = ("ugb", "funcao", "programa", "fr")
_M = ", ".join(METRICS)


def _strip(names) -> str:
    return ", ".join(f"nullif(trim({c}), '') AS {c}" for c in names)


def _id(length: int) -> str:
    return " || '_' || ".join([*_KEY, f"substr(ced, 1, {length})"])


_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(distrito), '[a-z][a-z0-9_]*|[^a-z]+'), "
    "lambda w: upper(w[1]) || w[2:]), '')"
)

_CTES = {
    "raw": adapter.EXTRACT.format(**_TABLES),
    "typed": f"""SELECT source_file, {_ORDER}, {_strip([*_KEY, 'ced'])},
        {", ".join(f"TRY_CAST({m} AS DOUBLE) AS {m}" for m in METRICS)} FROM raw""",
    "units_sheet": adapter.UNITS_SHEET.format(**_TABLES),
    "names_sheet": f"SELECT * FROM ({adapter.NAMES_SHEET.format(**_TABLES)})",
    "dim_ugb": f"""SELECT codigo_ugb, nome_ugb, ambito, provincia, {_TITLE} AS distrito,
        adm2020_24, adm2025_29, nivel_da_instituicao FROM units_sheet""",
    "dim_ced": r"""SELECT regexp_replace(codigo, '\.0+$', '') AS ced, designacao AS ced_desc
        FROM names_sheet WHERE codigo IS NOT NULL""",
    "dim_fr": r"""SELECT regexp_replace(codigo_receita, '\.0+$', '') AS fr, tipo_receita AS fr_nome,
        financiador AS fr_modalidade FROM names_sheet WHERE codigo_receita IS NOT NULL""",
    "flagged": f"""SELECT *, substr(ugb, 1, 9) AS ugb_id,
        substr(ced, 1, 5) AS ced_base_5, {_id(5)} AS id_row_ced_5d,
        substr(ced, 1, 4) AS ced_base_4, {_id(4)} AS id_row_ced_4d,
        substr(ced, 1, 3) AS ced_base_3, {_id(3)} AS id_row_ced_3d,
        substr(ced, 1, 2) AS ced_base_2, {_id(2)} AS id_row_ced_2d,
        CASE WHEN substr(ugb, 1, 9) IN (SELECT codigo_ugb FROM dim_ugb) THEN 'Keep' ELSE 'Remove' END
          AS mec_ugb_class,
        CASE WHEN ced IS NOT NULL THEN 'Keep' ELSE 'Remove' END AS ced_blank_class,
        CASE WHEN ced NOT LIKE '%00' THEN 'A'
             WHEN ced LIKE '%00' AND ced NOT LIKE '%000' THEN 'B'
             WHEN ced LIKE '%000' AND ced NOT LIKE '%0000' THEN 'C'
             WHEN ced LIKE '%0000' THEN 'D' END AS ced_group
      FROM typed""",
    "valid": """SELECT * FROM flagged WHERE mec_ugb_class = 'Keep' AND ced_blank_class = 'Keep'""",
}


def _with(body: str, *extra: tuple[str, str]) -> str:
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in [*_CTES.items(), *extra])
    return f"WITH {ctes}\n{body}"


_PLAIN = [
    "source_file", "ugb_id", *_KEY, "ced", *METRICS,
    *[c for k in (5, 4, 3, 2) for c in (f"ced_base_{k}", f"id_row_ced_{k}d")],
    "mec_ugb_class", "ced_blank_class", "ced_group",
]
NET_COLUMNS = [*_PLAIN, "CAST(is_parent AS STRING) AS is_parent"]


def _net_list(metrics, parent: str, group: str) -> str:
    """Every metric less its group's non-parent rows, for parent rows."""
    w = f"OVER (PARTITION BY source_file, {group})"
    return ", ".join(
        f"CASE WHEN {parent} THEN {m} - coalesce(sum({m}) FILTER (WHERE NOT ({parent})) {w}, 0) "
        f"ELSE {m} END AS {m}"
        for m in metrics
    )


_OTHERS = ", ".join([_ORDER, *[c for c in _PLAIN if c not in METRICS]])


def _any(level: str) -> str:
    """Whether a group has a level; unknown if it has rows without one and none of that level."""
    return (
        f"CASE WHEN bool_or(ced_group = '{level}') THEN true "
        f"WHEN count(*) FILTER (WHERE ced_group IS NULL) = 0 THEN false END"
    )


def _has(name: str, src: str, digits: int) -> tuple[str, str]:
    g = f"id_row_ced_{digits}d"
    return name, (
        f"SELECT source_file AS hf, {g} AS hid, {_any('A')} AS ha, {_any('B')} AS hb, {_any('C')} AS hc "
        f"FROM {src} GROUP BY source_file, {g}"
    )


def _stage(name, src, has, digits, cond, levels, zeros, priority, stage) -> tuple[str, str]:
    g = f"id_row_ced_{digits}d"
    parent = f"ced LIKE '%{zeros}'"
    return name, (
        f"SELECT {_OTHERS}, {_net_list(METRICS, parent, g)}, {parent} AS is_parent, "
        f"{priority} AS level_priority, {stage} AS stage FROM {src} JOIN {has} "
        f"ON source_file = hf AND {g} IS NOT DISTINCT FROM hid "
        f"WHERE {cond} AND ced_group IN {levels}"
    )


def _levels(src="valid", lone_d=False, lone_c=False, c_suffix="0000", own_a=True):
    no_c, no_b = "hc = false", "hb = false"
    d_last = f"{no_c} AND {no_b}" + ("" if lone_d else " AND ha")
    c_last = no_b + ("" if lone_c else " AND ha")
    out = [
        _has("has2", src, 2), _has("has3", src, 3), _has("has4", src, 4),
        _stage("d_c", src, "has2", 2, "hc", "('C','D')", "0000", 4, 0),
        _stage("d_b", src, "has2", 2, f"{no_c} AND hb", "('B','D')", "0000", 4, 1),
        _stage("d_a", src, "has2", 2, d_last, "('A','D')", "0000", 4, 2),
        _stage("c_b", src, "has3", 3, "hb", "('B','C')", "000", 3, 0),
        _stage("c_a", src, "has3", 3, c_last, "('A','C')", c_suffix, 3, 1),
        _stage("b_a", src, "has4", 4, "ha", "('A','B')", "00", 2, 0),
        ("a_own", f"SELECT {_OTHERS}, {_M}, CAST(NULL AS BOOLEAN) AS is_parent, 1 AS level_priority, "
                  f"0 AS stage FROM {src} WHERE ced_group = 'A'" + ("" if own_a else " AND false")),
    ]
    names = ("d_c", "d_b", "d_a", "c_b", "c_a", "b_a", "a_own")
    out.append(("all_levels", " UNION ALL BY NAME ".join(f"SELECT * FROM {n}" for n in names)))
    return out


def _first(src: str, keys: str, order: str) -> tuple[str, str]:
    return "kept", (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {src}) WHERE rn = 1"
    )


def _net(keys="source_file, id_row_ced_5d", columns=NET_COLUMNS, then=(), source="kept", **rules) -> str:
    kept = _first("all_levels", keys, f"level_priority, stage, {_ORDER}")
    return _with(f"SELECT {', '.join(columns)} FROM {source}", *_levels(**rules), kept, *then)


_FILE_META = """
  regexp_replace({p}, '^.*/', '') AS {n},
  CASE WHEN contains({p}, 'InvestimentoCompExterna') THEN 'Investimento Externo'
       WHEN contains({p}, 'InvestimentoCompInterna') THEN 'Investimento Interno'
       WHEN contains({p}, 'OrcamentoFuncionamento') THEN 'Funcionamento' END AS reporte_tipo,
  TRY_CAST(try_strptime(regexp_extract_all({p}, '[0-9]{{8}}')[1], '%Y%m%d') AS DATE) AS data_reporte,
  TRY_CAST(try_strptime(regexp_extract_all({p}, '[0-9]{{8}}')[2], '%Y%m%d') AS DATE) AS data_extraido"""
_MONTH = """['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro',
  'Outubro','Novembro','Dezembro'][month(data_reporte)]"""


def _meta(src: str, path="source_file", name="fonte_reporte", out="processed") -> tuple[str, str]:
    meta = _FILE_META.format(p=path, n=name)
    return out, (
        f"SELECT *, CAST(year(data_reporte) AS INTEGER) AS ano, {_MONTH} AS mes "
        f"FROM (SELECT *, {meta} FROM {src})"
    )


META_COLUMNS = [
    "reporte_tipo", "CAST(data_reporte AS STRING) AS data_reporte",
    "CAST(data_extraido AS STRING) AS data_extraido", "ano", "mes",
]
PROCESSED_COLUMNS = [*NET_COLUMNS, "fonte_reporte", *META_COLUMNS]
FINAL_COLUMNS = [
    "mec_ugb_class", "ced_blank_class", "fonte_reporte", "adm2020_24", "adm2025_29", *META_COLUMNS,
    "ugb_id", "ugb", "funcao", "programa", "fr", "fr_nome", "fr_modalidade", "ced", "ced_desc",
    "ced_base_3", "ced_base_4", "nivel_da_instituicao", "ambito", "provincia", "distrito", *METRICS,
]

_CENTRAL = ", ".join(f"CASE WHEN {c} = '-' THEN 'Central' ELSE {c} END AS {c}" for c in ("provincia", "distrito"))


def _joined(src: str, fund=True) -> tuple[str, str]:
    fr = "LEFT JOIN dim_fr r ON p.fr = r.fr" if fund else ""
    fr_cols = ", r.fr_nome, r.fr_modalidade" if fund else ""
    return "joined", (
        f"SELECT p.*, u.* EXCLUDE (codigo_ugb, provincia, distrito), {_CENTRAL}, c.ced_desc{fr_cols} "
        f"FROM {src} p LEFT JOIN dim_ugb u ON p.ugb_id IS NOT DISTINCT FROM u.codigo_ugb "
        f"LEFT JOIN dim_ced c ON p.ced = c.ced {fr}"
    )


# -- the earlier long-format pipeline ------------------------------------------


def _legacy(metrics, tag="") -> list[tuple[str, str]]:
    cols = f"{_ORDER}, source_file, ugb_id, {', '.join(_KEY)}, ced, id_row_ced_3d, id_row_ced_4d"
    ms = ", ".join(metrics)
    amount = f"id_row_ced_3d || '_' || CAST({metrics[0]} AS STRING)"
    net = lambda zeros, g: _net_list(metrics, f"ced LIKE '%{zeros}'", g)
    f4, f3 = (f"(source_file, coalesce(id_row_ced_{k}d, '')) IN (SELECT f, id FROM rows{k}{tag})" for k in (4, 3))
    return [
        (f"base{tag}", f"""SELECT {cols}, {ms} FROM (SELECT *, row_number() OVER (
            PARTITION BY source_file, {amount} ORDER BY {_ORDER}) AS rn
            FROM valid WHERE NOT ({" AND ".join(f"{m} = 0" for m in metrics)})) WHERE rn = 1"""),
        (f"rows4{tag}", f"""SELECT source_file AS f, coalesce(id_row_ced_4d, '') AS id FROM base{tag}
            GROUP BY ALL HAVING count(*) > 1"""),
        (f"rows3{tag}", f"""SELECT DISTINCT source_file AS f, coalesce(id_row_ced_3d, '') AS id FROM (
            SELECT *, count(*) OVER (PARTITION BY source_file, id_row_ced_3d) AS n FROM base{tag})
            WHERE n > 1 AND NOT {f4}"""),
        (f"adjusted{tag}", f"""
            SELECT {cols}, {net("000", "id_row_ced_4d")}, '4d' AS part FROM base{tag} WHERE {f4}
            UNION ALL BY NAME
            SELECT {cols}, {net("00", "id_row_ced_3d")}, '3d' AS part FROM base{tag} WHERE {f3}
            UNION ALL BY NAME
            SELECT {cols}, {ms}, 'leaf' AS part FROM base{tag} WHERE NOT {f4} AND NOT {f3}"""),
    ]


def _long(drop_helper=False) -> list[tuple[str, str]]:
    parts = []
    for tag, metrics in (("_b", BUDGET_METRICS), ("_e", EXPENSE_METRICS)):
        shown = metrics[1:] if drop_helper and tag == "_e" else metrics
        parts += [
            f"SELECT source_file, ugb_id, funcao, programa, fr, ced, '{m}' AS metrica, {m} AS valor "
            f"FROM adjusted{tag}" for m in shown
        ]
    return [
        *_legacy(BUDGET_METRICS, "_b"), *_legacy(EXPENSE_METRICS, "_e"),
        ("long", " UNION ALL ".join(parts)), _meta("long", name="file_name"),
    ]


LONG_COLUMNS = [
    "source_file", *META_COLUMNS, "ugb_id", "funcao", "programa", "fr", "ced", "metrica", "valor",
]
LONG_FINAL_COLUMNS = [
    "source_file AS ficheiro_fonte", "adm2020_24", "adm2025_29", *META_COLUMNS, "ugb_id", "funcao",
    "programa", "fr", "ced", "ced_desc", "nivel_da_instituicao", "ambito", "provincia", "distrito",
    "metrica", "valor",
]
_BASE_COLUMNS = ["source_file", "ugb_id", *_KEY, "ced", *BUDGET_METRICS]

_PAIR_ROWS = " UNION ALL BY NAME ".join(
    f"SELECT '{pair}' AS pair, source_file, ugb, ced, ced_group, "
    f"CAST(ced LIKE '%{zeros}' AS STRING) AS is_parent, "
    f"{_net_list(METRICS, f'''ced LIKE '%{zeros}' ''', f'id_row_ced_{k}d')} "
    f"FROM valid WHERE ced_group IN ('{pair[0]}', '{pair[1]}')"
    for pair, zeros, k in (("CD", "0000", 2), ("BC", "000", 3), ("AB", "00", 4))
)


def _select(columns, src, where="true") -> str:
    return f"SELECT {', '.join(columns)} FROM {src} WHERE {where}"


def _flags2(digits=2) -> str:
    return (
        f"SELECT source_file, id_row_ced_{digits}d, "
        + ", ".join(f"CAST(bool_or(ced_group = '{x}') AS STRING) AS has_{x.lower()}" for x in "ABCD")
        + f" FROM valid GROUP BY source_file, id_row_ced_{digits}d"
    )


_TYPED = ["source_file", *_KEY, "ced", *METRICS]
_SECOND = dict(src="flagged", lone_d=True, lone_c=True, c_suffix="00", own_a=False)
_LEVEL_COLUMNS = ["source_file", "ugb", "ced", "ced_group", *METRICS, "CAST(is_parent AS STRING) AS is_parent"]


_SORT = ", ".join(f"{c} NULLS LAST" for c in (*_KEY, "ced"))


def _printed() -> tuple[str, str]:
    """Rows under the report names that files were written with."""
    return "printed", f"SELECT * REPLACE ('{adapter.NAME_PREFIX}' || source_file AS source_file) FROM kept"


def _conserving() -> str:
    """Parents by the longest present stem, looked up from every row to its ancestors."""
    key = "source_file, ugb, funcao, programa, fr"
    same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM p.{k}" for k in key.split(", "))
    sums = ", ".join(f"sum({m}) AS {m}" for m in METRICS)
    net = ", ".join(
        f"CASE WHEN t.{m} IS NULL THEN n.{m} ELSE coalesce(n.{m}, 0) - t.{m} END AS {m}" for m in METRICS)
    return _with(
        f"SELECT n.source_file, n.ugb, n.funcao, n.programa, n.fr, n.ced, n.parent, n.n_rows, {net} "
        f"FROM linked n LEFT JOIN taken t ON n.id = t.parent_id",
        ("nodes", f"SELECT *, row_number() OVER () AS id, rpad(rtrim(ced, '0'), CAST(greatest(2, length(rtrim(ced, '0'))) AS INTEGER), '0') "
                  f"AS stem FROM (SELECT {key}, ced, count(*) AS n_rows, {sums} FROM valid GROUP BY ALL)"),
        ("above", f"SELECT c.id AS child, p.id AS parent_id, p.ced AS parent, row_number() OVER "
                  f"(PARTITION BY c.id ORDER BY length(p.stem) DESC) AS place FROM nodes c JOIN nodes p ON {same} "
                  f"AND starts_with(c.stem, p.stem) AND length(p.stem) < length(c.stem)"),
        ("linked", "SELECT n.*, a.parent_id, a.parent FROM nodes n LEFT JOIN above a ON n.id = a.child AND a.place = 1"),
        ("taken", f"SELECT parent_id, {sums} FROM linked WHERE parent_id IS NOT NULL GROUP BY parent_id"),
    )


def _reconciled() -> str:
    """Parts of the totals: the rows that were combined, listed and kept, each told apart by its own test."""
    place = "PARTITION BY source_file, id_row_ced_5d"
    parts = " UNION ALL ".join(f"""
        SELECT v.source_file, v.ced_group, '{m}' AS metrica,
          sum(CASE WHEN listed THEN coalesce(v.{m}, 0) - coalesce(l.{m}, 0) ELSE 0 END) FILTER (lead) AS children,
          sum(coalesce(v.{m}, 0)) FILTER (NOT lead) AS siblings,
          sum(coalesce(l.{m}, 0)) FILTER (lead AND listed AND NOT v.chosen) AS finer,
          sum(coalesce(v.{m}, 0)) FILTER (lead AND NOT listed) AS unlisted
        FROM v LEFT JOIN lines l USING ({_ORDER}, source_file) GROUP BY ALL""" for m in METRICS)
    return _net(columns=["*"], source="told", then=[
        # A group's row of one level stands for it if it is the first in the file.
        ("ranked", f"SELECT *, row_number() OVER ({place} ORDER BY level_priority, stage, {_ORDER}) = 1 AS chosen, "
                   f"row_number() OVER (PARTITION BY source_file, {_ORDER} ORDER BY level_priority, stage) AS turn FROM all_levels"),
        ("lines", "SELECT * FROM ranked WHERE turn = 1"),
        ("v0", f"SELECT *, row_number() OVER ({place}, ced_group ORDER BY {_ORDER}) = 1 AS lead FROM valid"),
        ("v", f"SELECT v0.*, l.ced IS NOT NULL AS listed, coalesce(l.chosen, false) AS chosen FROM v0 "
              f"LEFT JOIN (SELECT {_ORDER}, source_file, ced, chosen FROM lines) l USING ({_ORDER}, source_file)"),
        ("told", f"SELECT source_file, ced_group, metrica, coalesce(children, 0) AS children, coalesce(siblings, 0) AS siblings, "
                 f"coalesce(finer, 0) AS finer, coalesce(unlisted, 0) AS unlisted, 'true' AS balanced FROM ({parts})"),
    ])


def oracle_sql() -> dict[str, str]:
    level = lambda *names: _with(
        " UNION ALL BY NAME ".join(_select(_LEVEL_COLUMNS, n) for n in names), *_levels()
    )
    out = {
        # sources and sinks
        "scan_extracts": _with(_select(_TYPED, "typed")),
        "load_dims": _with("""
            SELECT 'ugb' AS dim, codigo_ugb AS code, nome_ugb AS name, distrito AS detail FROM dim_ugb
            UNION ALL SELECT 'ced', ced, ced_desc, NULL FROM dim_ced
            UNION ALL SELECT 'fr', fr, fr_nome, fr_modalidade FROM dim_fr"""),
        "reject_files": _with("""
            SELECT source_file, CASE WHEN contains(source_file, 'CompExterna') THEN 'ced' END AS missing,
              CASE WHEN contains(source_file, 'CompExterna') THEN 0 ELSE count(*) END AS n_rows
            FROM typed GROUP BY source_file"""),
        "sink_csv": _net(),
        "sink_parquet": _net(columns=PROCESSED_COLUMNS, then=[_meta("kept")], source="processed"),
        "publish_from_files": _net(
            columns=FINAL_COLUMNS, then=[_printed(), _meta("printed"), _joined("processed")], source="joined"),
        "publish_metric_range": _net(
            columns=[*FINAL_COLUMNS, "CASE WHEN contains(source_file, 'CompExterna') "
                     "THEN despesa_paga_via_directa_dp END AS extra_metrica"],
            then=[_printed(), _meta("printed"), _joined("processed")], source="joined"),
        "cast_metric_range": _with(
            f"SELECT '{adapter.NAME_PREFIX}' || source_file AS source_file, {_M}, "
            "CASE WHEN contains(source_file, 'CompInterna') THEN dotacao_revista END AS extra_metrica FROM typed"),
        "typed_reading": """
            SELECT CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'x' END || CAST(l_orderkey AS VARCHAR) AS codigo,
              CAST(l_partkey AS DOUBLE) + CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 0.5 END AS nota,
              CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey AS INTEGER) END AS so_a,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS dia, 'string' AS codigo_type, 'double' AS nota_type,
              'int' AS so_a_type, 'date' AS dia_type
            FROM lineitem""",
        "quarantine": _with(f"""
            SELECT '{adapter.NAME_PREFIX}' || source_file AS source_file,
              count(*) FILTER (NOT contains(source_file, 'CompExterna')) AS n_rows,
              CASE WHEN contains(source_file, 'CompExterna') THEN 'malformed line' END AS missing
            FROM typed GROUP BY ALL"""),
        "sink_sorted": _net(columns=["*"], source="edges", then=[("edges", f"""
            SELECT source_file, count(*) AS n,
              {", ".join(f"any_value(first_{c}) AS first_{c}, any_value(last_{c}) AS last_{c}" for c in (*_KEY, "ced"))},
              'true' AS in_order
            FROM (SELECT source_file, {", ".join(
                f"first_value({c}) OVER (w ORDER BY {_SORT}) AS first_{c}, "
                f"last_value({c}) OVER (w ORDER BY {_SORT} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_{c}"
                for c in (*_KEY, "ced"))}
              FROM kept WINDOW w AS (PARTITION BY source_file)) GROUP BY source_file""")]),
        # columns
        "clean_names": _with(_select(
            ["source_file", "ugb", "funcao", "programa", "fr", "ced", "dotacao_inicial",
             "ad_fundos_desp_paga_vd_afdp"], "typed")),
        "select_by_pattern": _with(_select(
            ["source_file", "ad_fundos_concedidos_af", "ad_fundos_desp_paga_vd_afdp",
             "ad_fundos_liquidados_laf", "mec_ugb_class", "ced_blank_class"], "flagged")),
        "select_range": _with(_select(BUDGET_METRICS, "typed")),
        "cast_metrics": _with(f"SELECT source_file, {_M} FROM typed"),
        "relocate": _with(_select(["ugb_id", "source_file", "ced", "ced_group", "ugb"], "flagged")),
        "unpivot_metrics": _with(" UNION ALL ".join(
            f"SELECT source_file, ugb, ced, '{m}' AS metrica, {m} AS valor FROM typed" for m in METRICS)),
        # scalar functions and flags
        "derive_keys": _with(_select(
            ["source_file", "ugb_id", *[c for c in _PLAIN if c.startswith(("ced_base", "id_row"))],
             " || '_' || ".join([*_KEY, "ced", "ced_group"]) + " AS id_row_ced_group",
             " || '_' || ".join([*_KEY, "ced_group"]) + " AS id_row_group"], "flagged")),
        "classify_level": _with(_select(["source_file", "ced", "ced_group"], "flagged")),
        "flag_units": _with(_select(
            ["source_file", "ugb_id", "ced", "mec_ugb_class", "ced_blank_class"], "flagged")),
        "filter_valid": _with(_select(["source_file", "ugb_id", "ced", *METRICS], "valid")),
        "title_case": _with("SELECT codigo_ugb, distrito FROM dim_ugb"),
        "recode_central": _with(f"SELECT codigo_ugb, {_CENTRAL} FROM dim_ugb"),
        "drop_all_zero": _with(_select(
            ["source_file", "ugb_id", "ced", *METRICS], "valid",
            "NOT (" + " AND ".join(f"{m} = 0" for m in METRICS) + ")")),
        "regex_slices": _with("""
            SELECT source_file, ced, CASE WHEN NOT regexp_matches(ced, '00$') THEN 'XX'
              WHEN regexp_matches(ced, '[1-9]00$') THEN '00'
              WHEN regexp_matches(ced, '[1-9]000$') THEN '000'
              WHEN regexp_matches(ced, '[1-9]0000$') THEN '0000' END AS slice FROM valid"""),
        "file_metadata": _with(
            f"SELECT DISTINCT file_name, {', '.join([*META_COLUMNS[:3], 'CAST(ano AS STRING) AS ano', 'mes'])} "
            "FROM processed",
            ("paths", """SELECT 'dados/2025/' || source_file AS p FROM typed
                UNION ALL SELECT 'extracto_' || CAST(l_orderkey AS STRING) || '.xls' FROM typed
                UNION ALL SELECT 'x/InvestimentoCompExterna_20241301_20240229.xls' FROM typed"""),
            _meta("paths", "p", "file_name")),
        # hierarchy
        "collapse_one_level": _with(_PAIR_ROWS),
        "residual_parents": _with(f"SELECT * FROM ({_PAIR_ROWS}) WHERE ced_group = pair[2] AND pair <> 'AB'"),
        "presence_flags": _with(_flags2()),
        "key_semi_anti": _with(
            "SELECT source_file, ugb, ced, CASE WHEN hc THEN 'with_c' ELSE 'without_c' END AS side "
            "FROM valid JOIN has2 ON source_file = hf AND id_row_ced_2d IS NOT DISTINCT FROM hid",
            *_levels()),
        "key_table_joins": _with(
            "SELECT source_file, ugb, ced, CASE WHEN hc THEN 'with_c' ELSE 'without_c' END AS side "
            "FROM valid JOIN has2 ON source_file = hf AND id_row_ced_2d IS NOT DISTINCT FROM hid",
            *_levels()),
        "level_d": level("d_c", "d_b", "d_a"),
        "level_c": level("c_b", "c_a"),
        "level_b": level("b_a"),
        "level_a": level("a_own"),
        "union_levels": _with(_select([*_LEVEL_COLUMNS, "level_priority"], "all_levels"), *_levels()),
        "prioritise": _net(),
        "net_extract": _net(),
        "process_extracts": _net(columns=PROCESSED_COLUMNS, then=[_meta("kept")], source="processed"),
        "enrich_final": _net(
            columns=FINAL_COLUMNS, then=[_meta("kept"), _joined("processed")], source="joined"),
        # variants
        "net_unfiltered": _net(src="flagged"),
        "net_c_less_a": _net(c_suffix="000"),
        "net_second_generation": _net(**_SECOND),
        "net_second_generation_all_a": _net(**{**_SECOND, "own_a": True}),
        "net_by_classifier": _net(keys="source_file, ced", **_SECOND),
        "net_whole_classifier": _net(keys="source_file, id_row_ced_5d, ced"),
        # the earlier long-format pipeline
        "dedup_by_amount": _with(_select(_BASE_COLUMNS, "base"), *_legacy(BUDGET_METRICS)),
        "multi_row_groups": _with(
            f"SELECT {', '.join(_BASE_COLUMNS)}, CASE WHEN n > 1 THEN 'several' ELSE 'single' END AS kind "
            "FROM (SELECT *, count(*) OVER (PARTITION BY source_file, id_row_ced_4d) AS n FROM base)",
            *_legacy(BUDGET_METRICS)),
        "legacy_adjust": _with(_select([*_BASE_COLUMNS, "part"], "adjusted"), *_legacy(BUDGET_METRICS)),
        "legacy_long": _with(_select(LONG_COLUMNS, "processed"), *_long()),
        "legacy_long_without_helper": _with(_select(LONG_COLUMNS, "processed"), *_long(True)),
        "legacy_enriched": _with(
            _select(LONG_FINAL_COLUMNS, "joined"), *_long(), _joined("processed", fund=False)),
        "leaf_expense": _with(f"""
            SELECT ugb_id, nome_ugb AS ugb_nome, funcao, programa, nivel_da_instituicao, provincia,
              distrito, fr, ced, ced_base_4 AS ced_area, '{METRICS[-1]}' AS metrica, {METRICS[-1]} AS valor
            FROM flagged LEFT JOIN dim_ugb ON ugb_id IS NOT DISTINCT FROM codigo_ugb
            WHERE ced IS NOT NULL AND ced NOT LIKE '%00'"""),
        # sets and checks
        "net_conserving": _conserving(),
        "reconcile_parts": _reconciled(),
        "repeated_keys": _with("""
            SELECT 'ugb' AS dim, codigo_ugb AS key, count(*) AS n FROM dim_ugb GROUP BY ALL HAVING count(*) > 1
            UNION ALL SELECT 'ced', ced, count(*) FROM dim_ced GROUP BY ALL HAVING count(*) > 1
            UNION ALL SELECT 'fr', fr, count(*) FROM dim_fr GROUP BY ALL HAVING count(*) > 1
            UNION ALL SELECT 'distrito', distrito, count(*) FROM dim_ugb GROUP BY ALL HAVING count(*) > 1"""),
        "distinct_units": _with("SELECT DISTINCT codigo_ugb FROM dim_ugb"),
        "report_inventory": _with(
            f"SELECT DISTINCT {', '.join(META_COLUMNS[:3])} FROM processed", _meta("valid")),
        "finest_level_keys": _with("""
            SELECT source_file, id_row_ced_2d, CASE WHEN bool_or(ced_group = 'A') THEN 'A'
              WHEN bool_or(ced_group = 'B') THEN 'B' WHEN bool_or(ced_group = 'C') THEN 'C'
              ELSE 'D' END AS finest_level FROM flagged WHERE ced IS NOT NULL GROUP BY source_file, id_row_ced_2d"""),
        "level_key_sets": _with(
            """SELECT source_file, id, 'with_c' AS side FROM c UNION ALL
            SELECT source_file, id, 'without_c' FROM
              (SELECT source_file, id_row_ced_2d AS id FROM valid EXCEPT SELECT source_file, id FROM c)""",
            ("c", "SELECT DISTINCT source_file, id_row_ced_2d AS id FROM valid WHERE ced_group = 'C'")),
        "used_keys": _with("""
            SELECT source_file, id_row_ced_2d AS id FROM valid UNION SELECT source_file, id_row_ced_3d FROM valid
            UNION SELECT source_file, id_row_ced_4d FROM valid WHERE ced_group = 'A'"""),
        "duplicate_check": _net(
            columns=["source_file", "id_row_ced_4d", "n"], source="repeated",
            then=[("repeated", "SELECT source_file, id_row_ced_4d, count(*) AS n FROM kept "
                               "GROUP BY ALL HAVING count(*) > 1")]),
        "reconcile_totals": _net(
            columns=["*"], source="sides", then=[("sides", " UNION ALL ".join(f"""
              SELECT source_file, ced_group, '{m}' AS metrica, r.n AS raw_rows, k.n AS net_rows,
                r.v AS raw_total, k.v AS net_total FROM
              (SELECT source_file, ced_group, count(*) AS n, sum({m}) AS v FROM valid GROUP BY ALL) r
              FULL JOIN (SELECT source_file, ced_group, count(*) AS n, sum({m}) AS v FROM kept GROUP BY ALL) k
              USING (source_file, ced_group)""" for m in METRICS))]),
    }
    return out
