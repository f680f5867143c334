"""One query per operator, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica import schema as S
from rubrica.functions import keys as K
from rubrica.functions import text as X
from rubrica.functions.metadata import with_file_metadata
from rubrica.operators import columns as C
from rubrica.operators import groups as G
from rubrica.operators import hierarchy as H
from rubrica.operators import joins as J
from rubrica.operators import quality as Q
from rubrica.operators import sets as T
from rubrica.plans import enrich as E
from rubrica.plans import legacy as L
from rubrica.plans import conserve as V
from rubrica.plans import net as N
from rubrica.plans import publish as P
from rubrica.plans.reconcile import PARTS, reconcile_net
from rubrica.session import apply_recommended
from rubrica.sources.dimensions import load_dimensions, read_table, unit_codes, unit_dimension
from rubrica.sources.extracts import read_extracts, type_extract
from rubrica.sources.sinks import scratch_folder, write_csv, write_parquet

from . import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return {name: _with_settings(fn) for name, fn in _QUERIES.items()}


def _with_settings(fn: Query) -> Query:
    return wraps(fn)(lambda spark, d: fn(apply_recommended(spark), d))


def _units(spark, d) -> DataFrame:
    return unit_dimension(A.units_sheet(spark, d))


def _flagged(spark, d) -> DataFrame:
    return H.prepare_extract(A.typed_extract(spark, d), _units(spark, d), S.UNFILTERED)


def _valid(spark, d) -> DataFrame:
    return H.prepare_extract(A.typed_extract(spark, d), _units(spark, d))


def _shown(df: DataFrame) -> DataFrame:
    """Dates and nullable flags as text, so that both engines print them alike."""
    text = [c for c, t in df.dtypes if t in ("date", "boolean")]
    return df.drop(S.ROW_ORDER).withColumns({c: F.col(c).cast("string") for c in text})


def _union(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


# -- sources and sinks ----------------------------------------------------------


@query
def scan_extracts(spark, d):
    folder = scratch_folder(spark, "extracts")
    write_csv(A.raw_extract(spark, d).drop(S.ROW_ORDER), folder, ["source_file"])
    return _shown(type_extract(read_extracts(spark, folder, "csv", layout="folder").rows))


@query
def load_dims(spark, d):
    dims = A.dimensions(spark, d)
    line = lambda dim, code, name, detail: F.struct(
        F.lit(dim).alias("dim"), F.col(code).alias("code"), F.col(name).alias("name"), detail.alias("detail")
    )
    return _union(
        dims.ugb.select(line("ugb", "codigo_ugb", "nome_ugb", F.col("distrito")).alias("x")),
        dims.ced.select(line("ced", "ced", "ced_desc", F.lit(None).cast("string")).alias("x")),
        dims.fr.select(line("fr", "fr", "fr_nome", F.col("fr_modalidade")).alias("x")),
    ).select("x.*")


@query
def reject_files(spark, d):
    folder = scratch_folder(spark, "mixed")
    raw = A.raw_extract(spark, d).drop(S.ROW_ORDER)
    broken = F.col("source_file").contains("CompExterna")
    write_parquet(raw.filter(~broken), folder, ["source_file"])
    write_parquet(raw.filter(broken).drop("ced"), folder, ["source_file"], mode="append")
    read = read_extracts(spark, folder, "parquet", layout="folder")
    used = read.rows.groupBy("source_file").agg(F.count("*").alias("n_rows"))
    return _union(
        used.select("source_file", F.lit(None).cast("string").alias("missing"), "n_rows"),
        read.rejects.select(
            "source_file", F.array_join("missing", ",").alias("missing"), F.lit(0).cast("long").alias("n_rows")
        ).distinct(),
    )


@query
def sink_csv(spark, d):
    result = _QUERIES["net_extract"](spark, d)
    folder = scratch_folder(spark, "csv")
    write_csv(result, folder)
    return spark.read.csv(folder, header=True, schema=result.schema)


@query
def sink_parquet(spark, d):
    result = process_extracts(spark, d)
    folder = scratch_folder(spark, "parquet")
    write_parquet(result, folder, ["ano", "reporte_tipo"])
    return spark.read.parquet(folder)


def _sheets(spark, d):
    """The lookups, printed as sheets with a line above the header and read from there."""
    folders = {}
    sheets = {"units": (A.units_sheet(spark, d), A.UNITS_HEADER), "names": (A.names_sheet(spark, d), A.NAMES_HEADER)}
    for name, (sheet, header) in sheets.items():
        folders[name] = scratch_folder(spark, name)
        A.write_sheet(sheet, header, folders[name])
    return load_dimensions(*[read_table(spark, folder, skip=1) for folder in folders.values()])


@query
def publish_from_files(spark, d):
    """Report files and lookup sheets to the published table, written and read back."""
    folder, out = scratch_folder(spark, "reports"), scratch_folder(spark, "out")
    A.write_reports(A.raw_extract(spark, d), folder)
    return _shown(P.publish(read_extracts(spark, folder, layout="folder"), _sheets(spark, d).prepared(), out))


@query
def publish_metric_range(spark, d):
    """The same where some reports have a twelfth metric between the first and the last."""
    folder, out = scratch_folder(spark, "reports"), scratch_folder(spark, "out")
    raw = A.raw_extract(spark, d)
    wide = F.col("source_file").contains("CompExterna")
    A.write_reports(raw.filter(~wide), folder)
    extra = raw.filter(wide).withColumn("extra_metrica", F.col("despesa_paga_via_directa_dp"))
    A.write_reports(C.relocate(extra, "extra_metrica", after=S.METRICS[1]), folder, "append")
    extracts = read_extracts(spark, folder, layout="folder")
    return _shown(P.publish(extracts, A.dimensions(spark, d).prepared(), out))


@query
def cast_metric_range(spark, d):
    """Metrics found by position in headers that differ, cast over the whole extract."""
    folder = scratch_folder(spark, "reports")
    raw = A.raw_extract(spark, d)
    wide = F.col("source_file").contains("CompInterna")
    A.write_reports(raw.filter(~wide), folder)
    extra = raw.filter(wide).withColumn("extra_metrica", F.col("dotacao_revista"))
    A.write_reports(C.relocate(extra, "extra_metrica", before=S.METRICS[-1]), folder, "append")
    extracts = read_extracts(spark, folder, layout="folder")
    typed = type_extract(extracts.rows, extracts.metrics)
    return typed.select("source_file", *C.numeric_names(typed))


@query
def typed_reading(spark, d):
    """Types that Spark infers per group of headers, widened until both groups fit."""
    folder = scratch_folder(spark, "typed")
    lines = A.table(spark, d, "lineitem")
    shared = [F.lit("R").alias("source_file"), F.col("l_shipdate").cast("date").cast("string").alias("dia")]
    write_csv(lines.filter("l_linenumber % 2 = 0").select(
        *shared, F.col("l_orderkey").alias("codigo"), F.col("l_partkey").alias("nota"), F.col("l_suppkey").alias("so_a")),
        folder, ["source_file"])
    write_csv(lines.filter("l_linenumber % 2 = 1").select(
        *shared, F.concat(F.lit("x"), "l_orderkey").alias("codigo"), (F.col("l_partkey") + 0.5).alias("nota")),
        folder, ["source_file"], "append")
    rows = read_extracts(spark, folder, layout="folder", infer_types=True, required=("codigo", "nota")).rows
    cells = ("codigo", "nota", "so_a", "dia")
    return rows.select(*[F.col(c).cast("string") if c == "dia" else F.col(c) for c in cells],
                       *[F.typeof(c).alias(f"{c}_type") for c in cells])


@query
def quarantine(spark, d):
    """Reports with a line that does not fit are left out as a whole; the others are read once."""
    folder = scratch_folder(spark, "reports")
    raw = A.raw_extract(spark, d)
    A.write_reports(raw, folder)
    # A part with one line too short, in the reports of one type: one text column, its name the header.
    bad = raw.filter(F.col("source_file").contains("CompExterna")).select("source_file").distinct()
    header = ",".join(c for c in raw.columns if c not in ("source_file", S.ROW_ORDER))
    short = bad.select(F.concat(F.lit(A.NAME_PREFIX), "source_file").alias("source_file"), F.lit("x,x").alias(header))
    short.write.mode("append").options(header=True, sep="\x01", quote="").partitionBy("source_file").csv(folder)
    read = read_extracts(spark, folder, layout="folder")
    used = read.rows.groupBy("source_file").agg(F.count("*").alias("n_rows"))
    return _union(
        used.withColumn("missing", F.lit(None).cast("string")),
        read.rejects.select("source_file", F.lit(0).cast("long").alias("n_rows"), F.array_join("missing", ",").alias("missing")),
    )


@query
def sink_sorted(spark, d):
    """A sorted write, and its order as its files' edges tell it."""
    folder = scratch_folder(spark, "sorted")
    keys = ("ugb", "funcao", "programa", "fr", "ced")
    write_parquet(_QUERIES["net_extract"](spark, d), folder, ["source_file"], sort_by=keys)
    files = Q.order_of_files(spark.read.parquet(folder), keys, ["source_file"])
    edge = lambda pick, name: pick(name, "file").alias(name)
    whole = files.groupBy("source_file").agg(
        F.sum("n").alias("n"), edge(F.min_by, "first"), edge(F.max_by, "last"), F.bool_and("in_order").alias("in_order"))
    return whole.select("source_file", "n", *[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("first", "last") for c in keys],
                        F.col("in_order").cast("string").alias("in_order"))


# -- columns --------------------------------------------------------------------

#: Header cells as a report prints them.
_HEADERS = {
    "ugb": "UGB", "funcao": "Função", "programa": "Programa", "fr": "FR", "ced": "CED",
    "dotacao_inicial": "Dotação Inicial", "ad_fundos_desp_paga_vd_afdp": "Ad. Fundos + Desp. Paga VD (AFDP)",
}


@query
def clean_names(spark, d):
    printed = A.typed_extract(spark, d).select("source_file", *[F.col(c).alias(h) for c, h in _HEADERS.items()])
    return C.clean_names(printed)


@query
def select_by_pattern(spark, d):
    df = C.drop_matching(_flagged(spark, d), "_*", "*percent")
    return C.keep_matching(df, "source_file", "ad_fundos*", "*_class")


@query
def select_range(spark, d):
    return C.column_range(A.typed_extract(spark, d), "dotacao_inicial", "ad_fundos_concedidos_af")


@query
def cast_metrics(spark, d):
    return K.cast_metrics(A.raw_extract(spark, d), S.METRICS).select("source_file", *S.METRICS)


@query
def relocate(spark, d):
    df = _flagged(spark, d).select("source_file", "ugb", "ced", "ugb_id", "ced_group")
    return C.relocate(C.relocate(df, "ugb_id"), "ced_group", after="ced")


@query
def unpivot_metrics(spark, d):
    return C.unpivot(A.typed_extract(spark, d).select("source_file", "ugb", "ced", *S.METRICS), S.METRICS)


# -- scalar functions and flags ---------------------------------------------------


@query
def derive_keys(spark, d):
    df = K.classify_level(K.derive_keys(A.typed_extract(spark, d)))
    df = df.withColumns({
        "id_row_ced_group": K.level_tagged_id(), "id_row_group": K.level_tagged_id(with_ced=False),
    })
    return df.select("source_file", "ugb_id", *C.matching(df, "ced_base*", "id_row*"))


@query
def classify_level(spark, d):
    return K.classify_level(A.typed_extract(spark, d)).select("source_file", "ced", "ced_group")


@query
def flag_units(spark, d):
    df = K.derive_keys(A.typed_extract(spark, d))
    flagged = J.flag_units(df, _units(spark, d))
    return flagged.select("source_file", "ugb_id", "ced", "mec_ugb_class", "ced_blank_class")


@query
def filter_valid(spark, d):
    df = K.derive_keys(A.typed_extract(spark, d))
    return J.filter_valid(df, _units(spark, d)).select("source_file", "ugb_id", "ced", *S.METRICS)


@query
def title_case(spark, d):
    return A.units_sheet(spark, d).select("codigo_ugb", X.title_case("distrito").alias("distrito"))


@query
def recode_central(spark, d):
    return E.recode_central(_units(spark, d).select("codigo_ugb", "provincia", "distrito"))


@query
def drop_all_zero(spark, d):
    return K.drop_all_zero(_valid(spark, d), S.METRICS).select("source_file", "ugb_id", "ced", *S.METRICS)


@query
def regex_slices(spark, d):
    return Q.regex_slices(_valid(spark, d)).select("source_file", "ced", "slice")


@query
def file_metadata(spark, d):
    rows = A.raw_extract(spark, d)
    paths = _union(
        rows.select(F.concat(F.lit("dados/2025/"), "source_file").alias("p")),
        rows.select(F.concat(F.lit("extracto_"), F.col("row_order.l_orderkey"), F.lit(".xls")).alias("p")),
        rows.select(F.lit("x/InvestimentoCompExterna_20241301_20240229.xls").alias("p")),
    )
    df = with_file_metadata(paths, "p").drop("p").distinct()
    return _shown(df).withColumn("ano", F.col("ano").cast("string"))


# -- hierarchy --------------------------------------------------------------------


@query
def collapse_one_level(spark, d):
    return _shown(H.collapse_pairs(_valid(spark, d)).select("pair", "source_file", "ugb", "ced", "ced_group", "is_parent", *S.METRICS))


@query
def residual_parents(spark, d):
    return _shown(H.residual_parents(_valid(spark, d), ("CD", "BC")).select("pair", "source_file", "ugb", "ced", "ced_group", "is_parent", *S.METRICS))


@query
def presence_flags(spark, d):
    flags = {f"has_{x.lower()}": F.col("ced_group") == x for x in S.LEVELS}
    return _shown(G.presence_flags(_valid(spark, d), ["source_file", "id_row_ced_2d"], flags))


@query
def key_semi_anti(spark, d):
    rows = T.split_rows(_valid(spark, d), "id_row_ced_2d", "C")
    return rows.select("source_file", "ugb", "ced", _side())


def _side():
    return F.when(F.col("present"), "with_c").otherwise("without_c").alias("side")


@query
def key_table_joins(spark, d):
    """Rows by a key table of their own: semi and anti join, NULL keys included."""
    rows = _valid(spark, d)
    keys = rows.filter(F.col("ced_group") == "C").select("source_file", "id_row_ced_2d").distinct()
    return _union(
        J.semi_join_keys(rows, keys).withColumn("side", F.lit("with_c")),
        J.anti_join_keys(rows, keys).withColumn("side", F.lit("without_c")),
    ).select("source_file", "ugb", "ced", "side")


def _level_query(step) -> Query:
    def run(spark, d):
        rows = step(_valid(spark, d))
        return _shown(rows.select("source_file", "ugb", "ced", "ced_group", *S.METRICS, "is_parent"))

    return run


for _step in (H.level_d, H.level_c, H.level_b, H.level_a):
    _QUERIES[_step.__name__] = _level_query(_step)


@query
def union_levels(spark, d):
    rows = H.union_levels(_valid(spark, d))
    return _shown(
        rows.select("source_file", "ugb", "ced", "ced_group", *S.METRICS, "is_parent", "level_priority")
    )


_NET = (
    "source_file", "ugb_id", *S.UNIT_KEY, "ced", *S.METRICS,
    *[c for k in (5, 4, 3, 2) for c in (f"ced_base_{k}", f"id_row_ced_{k}d")],
    "mec_ugb_class", "ced_blank_class", "ced_group", "is_parent",
)


@query
def prioritise(spark, d):
    """The netting in single steps: four level tables, stacked, first row per key."""
    return _shown(H.prioritise(H.union_levels(_valid(spark, d))).select(*_NET))


def _net_query(rules: S.Rules) -> Query:
    def run(spark, d):
        return _shown(N.net_extract(A.typed_extract(spark, d), _units(spark, d), rules))

    return run


for _name, _rules in {
    "net_extract": S.PRODUCTION,
    "net_unfiltered": S.UNFILTERED,
    "net_c_less_a": S.PRODUCTION.but(c_over_a="subtract"),
    "net_second_generation": S.SECOND_GENERATION,
    "net_second_generation_all_a": S.SECOND_GENERATION_ALL_A,
    "net_by_classifier": S.BY_CLASSIFIER,
    "net_whole_classifier": S.PRODUCTION.but(dedup_key="unit_ced"),
}.items():
    _QUERIES[_name] = _net_query(_rules)


@query
def process_extracts(spark, d):
    return _shown(N.process_extracts(A.typed_extract(spark, d), _units(spark, d)))


@query
def net_conserving(spark, d):
    """Every row less its nearest descendants, whole classifiers as keys."""
    return V.net_conserving(_valid(spark, d))


@query
def enrich_final(spark, d):
    dims = A.dimensions(spark, d).prepared()
    return _shown(E.enrich(N.process_extracts(A.typed_extract(spark, d), dims.ugb), dims))


# -- the earlier long-format pipeline ------------------------------------------------

_BASE = ("source_file", "ugb_id", *S.UNIT_KEY, "ced", *S.BUDGET_METRICS)


@query
def dedup_by_amount(spark, d):
    return L.legacy_base(A.typed_extract(spark, d), _units(spark, d)).select(*_BASE)


@query
def multi_row_groups(spark, d):
    base = L.legacy_base(A.typed_extract(spark, d), _units(spark, d))
    return G.with_group_kind(base, K.prefix_group(4)).select(*_BASE, "kind")


@query
def legacy_adjust(spark, d):
    found = L.legacy_adjusted(A.typed_extract(spark, d), _units(spark, d))
    return found.withColumnsRenamed({f"__m{i}": m for i, m in enumerate(S.BUDGET_METRICS)}).select(*_BASE, "part")


@query
def legacy_long(spark, d):
    return _shown(L.legacy_long(A.typed_extract(spark, d), _units(spark, d)))


@query
def legacy_long_without_helper(spark, d):
    return _shown(L.legacy_long(A.typed_extract(spark, d), _units(spark, d), drop_helper=True))


@query
def legacy_enriched(spark, d):
    dims = A.dimensions(spark, d)
    return _shown(L.enrich_long(L.legacy_long(A.typed_extract(spark, d), dims.ugb), dims))


@query
def leaf_expense(spark, d):
    return L.leaf_expense(A.typed_extract(spark, d), A.dimensions(spark, d))


# -- sets and checks -------------------------------------------------------------------


@query
def distinct_units(spark, d):
    return unit_codes(_units(spark, d))


@query
def report_inventory(spark, d):
    return _shown(Q.report_inventory(with_file_metadata(_valid(spark, d), "source_file")))


@query
def finest_level_keys(spark, d):
    return T.finest_level_keys(_flagged(spark, d))


@query
def level_key_sets(spark, d):
    keys = T.split_keys(_valid(spark, d), "id_row_ced_2d", "C")
    return keys.select("source_file", F.col("id_row_ced_2d").alias("id"), _side())


@query
def used_keys(spark, d):
    return T.used_keys(_valid(spark, d))


@query
def duplicate_check(spark, d):
    kept = K.with_group_columns(
        N.net_extract(A.typed_extract(spark, d), _units(spark, d)), S.PRODUCTION
    )
    repeated = Q.repeated_groups(kept)
    ids = K.row_id(*K.GROUP_UNIT, "_c4").alias("id_row_ced_4d")
    return repeated.select("source_file", ids, "n")


@query
def reconcile_totals(spark, d):
    found = reconcile_net(A.typed_extract(spark, d), _units(spark, d))
    return found.select("source_file", "ced_group", "metrica", "raw_rows", "net_rows", "raw_total", "net_total")


@query
def reconcile_parts(spark, d):
    """Each raw total taken apart: net, taken off parents, and lost to each rule."""
    found = reconcile_net(A.typed_extract(spark, d), _units(spark, d))
    whole = sum((F.coalesce(c, F.lit(0)) for c in PARTS[1:]), F.coalesce(PARTS[0], F.lit(0)))
    balanced = (F.coalesce("raw_total", F.lit(0)) == whole).cast("string")
    return found.select("source_file", "ced_group", "metrica", *PARTS[1:], balanced.alias("balanced"))


@query
def repeated_keys(spark, d):
    """Lookup keys that would multiply rows: those of the lookups, and names shared by units."""
    dims = A.dimensions(spark, d).prepared()
    by_name = J.prepare_lookup(J.rows_of(dims.ugb), "distrito").repeated()
    shared = by_name.select(F.lit("distrito").alias("dim"), F.col("distrito").alias("key"), "n")
    return _union(dims.repeated_keys(), shared)
