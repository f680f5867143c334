"""Scans, lookups, sinks and text helpers."""

import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rubrica import schema as S
from rubrica.functions import keys as K
from rubrica.functions.metadata import with_file_metadata
from rubrica.functions.text import blank_to_null, clean_names, recode, strip_decimal_zeros, title_case
from rubrica.operators import columns as C
from rubrica.operators import joins as J
from rubrica.operators.groups import keep_first, multi_row_groups
from rubrica.operators.hierarchy import collapse_one_level
from rubrica.plans.legacy import dedup_by_amount
from rubrica.sources.dimensions import classifier_dimension, read_table
from rubrica.sources.extracts import read_extracts, type_extract
from rubrica.sources.sinks import scratch_folder, write_csv, write_parquet
from rubrica.schema import REQUIRED_COLUMNS as REQUIRED

HEADER = ["UGB", "Função", "Programa", "FR", "CED", "Dotação Inicial", "% Execução", "Liq Ad Fundos Via Directa LAFVD"]


def cells(n, start=0):
    return [f"50A{i:06d} - U,01,P,101,1111{i % 90 + 10},{i}.5,7%,{i}" for i in range(start, start + n)]


def put(folder, name, header, lines):
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n", encoding="utf-8")


def test_scan_of_many_files(spark, tmp_path):
    put(tmp_path, "OrcamentoFuncionamento_20250831_20250905.csv", HEADER, cells(3))
    put(tmp_path, "b.CSV", [*HEADER[:5], HEADER[7], "Nota", HEADER[5]], ["50A000009 - U,01,P, ,111111, 9 , x ,n/d"])
    put(tmp_path, "bad.csv", [h for h in HEADER if h != "CED"], ["50A000009 - U,01,P,101,1,7%,2"])
    (tmp_path / "no_lines.csv").write_text("\n")
    put(tmp_path, "other.txt", HEADER, cells(1))
    (tmp_path / "deeper").mkdir()
    put(tmp_path / "deeper", "c.csv", HEADER, cells(1))

    read = read_extracts(spark, str(tmp_path), "csv")
    rows = type_extract(read.rows)
    got = {r.source_file: r for r in rows.orderBy("row_order").collect()}
    assert set(got) == {"OrcamentoFuncionamento_20250831_20250905.csv", "b.CSV"}
    assert rows.count() == 4
    assert not [c for c in rows.columns if c.endswith("percent")]
    b = got["b.CSV"]
    assert (b.fr, b.nota, b.dotacao_inicial, b.liq_ad_fundos_via_directa_lafvd) == (None, "x", None, 9.0)
    rejects = {r.source_file: r.missing for r in read.rejects.collect()}
    assert rejects["bad.csv"] == ["ced"] and set(rejects) == {"bad.csv", "no_lines.csv"}


def test_nothing_usable(spark, tmp_path):
    put(tmp_path, "bad.csv", ["x"], ["1"])
    read = read_extracts(spark, str(tmp_path), "csv")
    assert read.rows.count() == 0 and read.rejects.count() == 1


def test_csv_order_holds_over_splits(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER, cells(20_000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_extracts(spark, str(tmp_path), "csv").rows
        assert rows.rdd.getNumPartitions() > 4
        got = [r.ugb for r in rows.orderBy("row_order").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [line.split(",")[0] for line in cells(20_000)]


def test_parquet_scan_and_folder_layout(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER, cells(50))
    rows = read_extracts(spark, str(tmp_path), "csv").rows
    out = str(tmp_path / "out")
    write_parquet(rows.drop("row_order"), out, ["source_file"])
    back = read_extracts(spark, out, "parquet", layout="folder").rows
    assert back.select("source_file").distinct().first()[0] == "a.csv"
    assert [r.ugb for r in back.orderBy("row_order").collect()] == [c.split(",")[0] for c in cells(50)]


def test_inferred_types(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER, cells(5))
    rows = read_extracts(spark, str(tmp_path), "csv", infer_types=True).rows
    assert dict(rows.dtypes)["dotacao_inicial"] == "double"


def test_lookup_sheet_with_lines_above_the_header(spark, tmp_path):
    (tmp_path / "d.csv").write_text('Referência\nCódigo,Designação\n111100.0,"Um, dois"\n,vazio\n')
    dim = classifier_dimension(read_table(spark, str(tmp_path / "d.csv"), skip=1))
    assert [tuple(r) for r in dim.collect()] == [("111100", "Um, dois")]


def test_csv_sink_writes_null_as_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5), (None, 'q"x,y', None)], "s string, t string, v double")
    write_csv(df.coalesce(1), str(tmp_path / "o"))
    text = next((tmp_path / "o").glob("part-*")).read_text()
    assert text.splitlines() == ["s,t,v", "a,,1.5", ',"q""x,y",']


def fake_session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, default: conf.get(k.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_folder_is_the_shared_one():
    shared = fake_session("spark://x", spark_checkpoint_dir="/shared/x/")
    assert scratch_folder(shared, "t").startswith("/shared/x/t-")
    with pytest.raises(RuntimeError):
        scratch_folder(fake_session("spark://x"), "t")
    with pytest.raises(RuntimeError):
        scratch_folder(fake_session("local-cluster[2,1,1024]"), "t")
    assert scratch_folder(fake_session("local[8]"), "t") and scratch_folder(fake_session("local"), "t")


@pytest.mark.parametrize("names, expected", [
    (["Código UGB", "% Execução", "adm2020_24"], ["codigo_ugb", "percent_execucao", "adm2020_24"]),
    (["Valor A", "valor-a"], ["valor_a", "valor_a_2"]),
    (["Valor", "Valor", ""], ["valor_1", "valor_2", "x3"]),
    (["tipoReceita", "LAFVd", "Dotação Cabimentada (DC)"], ["tipo_receita", "laf_vd", "dotacao_cabimentada_dc"]),
    (["2020 total", "Taxa %"], ["x2020_total", "taxa_percent"]),
])
def test_header_names(names, expected):
    assert clean_names(names) == expected


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize("text, expected", [
    ("CIDADE DA-BEIRA", "Cidade Da-Beira"), ("d'água", "D'água"), ("maputo (sul)", "Maputo (Sul)"),
    ("A/B", "A/B"), ("ÁGUA 1º bairro", "Água 1º Bairro"), (None, None), ("", ""),
])
def test_title_case(spark, text, expected):
    assert one(spark, text, title_case) == expected


@pytest.mark.parametrize("text, expected", [
    ("12", 12.0), (" 1.5 ", 1.5), ("4.5E7", 4.5e7), ("n/d", None), ("1d", None), ("1f ", None), ("NaN", None),
    ("", None), ("5.", 5.0), ("1,5", None), (None, None),
])
def test_numbers(spark, text, expected):
    assert one(spark, text, K.to_number) == expected


def test_small_text_helpers(spark):
    assert one(spark, " \t", blank_to_null) is None and one(spark, " a ", blank_to_null) == "a"
    assert one(spark, "101.00", strip_decimal_zeros) == "101"
    assert one(spark, "-", lambda c: recode(c, "-", "Central")) == "Central"
    assert one(spark, None, lambda c: recode(c, "-", "Central")) is None
    assert [one(spark, c, K.ced_level) for c in ("110000", "111000", "111100", "111101", None)] == [*"DCBA", None]


def test_file_metadata(spark):
    names = [
        "x/DemonstrativoConsolidadoOrcamentoFuncionamento_P_20250831_20250905-2025-09-10_11-56-30.592 1.xlsx",
        "InvestimentoCompExterna_20241301.xls", "other.xls",
    ]
    df = with_file_metadata(spark.createDataFrame([(n,) for n in names], "p string"), "p")
    got = [tuple(r)[2:] for r in df.collect()]
    day = datetime.date
    assert got[0] == ("Funcionamento", day(2025, 8, 31), day(2025, 9, 5), 2025, "Agosto")
    assert got[1] == ("Investimento Externo", None, None, None, None)
    assert got[2] == (None,) * 5


def test_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0, None)], "a int, b string, c double, d double")
    assert C.relocate(df, "c").columns == ["c", "a", "b", "d"]
    assert C.relocate(df, "a", after="c").columns == ["b", "c", "a", "d"]
    assert C.relocate(df, "d", before="b").columns == ["a", "d", "b", "c"]
    assert C.column_range(df, "b", "d").columns == ["b", "c", "d"]
    assert C.numeric_names(df) == ["a", "c", "d"]
    assert C.unpivot(df.select("b", "c", "d"), ["c", "d"]).count() == 2


def test_all_zero_rows(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, None), (None, None), (0.0, 1.0), (None, 1.0)], "a double, b double")
    assert [tuple(r) for r in K.drop_all_zero(df, ["a", "b"]).collect()] == [(0.0, 1.0), (None, 1.0)]


def test_null_keys_match_in_joins(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    keys = df.filter("k IS NULL OR k = 'a'")
    assert {r.k for r in J.semi_join_keys(df, keys).collect()} == {"a", None}
    assert {r.k for r in J.anti_join_keys(df, keys).collect()} == {"b"}
    dim = spark.createDataFrame([(None, "n"), ("a", "x"), ("a", "y")], "c string, v string")
    assert J.lookup(df, dim, {"k": "c"}).count() == 4
    assert J.repeated_keys(dim, "c").collect()[0].n == 2


def test_a_large_lookup_is_not_broadcast(spark):
    big = spark.range(20).select(F.col("id").cast("string").alias("c"))
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hint(J.broadcast_if_small(big, 20)) and not hint(J.broadcast_if_small(big, 19))


def test_keep_first_and_group_counts(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w")], "k string, row_order int, v string")
    assert {r.v for r in keep_first(df, ["k"]).collect()} == {"y", "z"}
    assert multi_row_groups(df, ["k"]).count() == 4 and multi_row_groups(df, ["k"], single=True).count() == 0


def test_dedup_by_amount_merges_missing_keys(spark):
    rows = [("f", 0, "u", "01", "P", "1", "111100", 5.0), ("f", 1, "u", "01", "P", "1", "111200", 5.0),
            ("f", 2, "u", "01", "P", None, "111200", 5.0), ("f", 3, "u", "01", "P", "1", "111200", None),
            ("g", 0, "u", "01", "P", "1", "111200", None)]
    df = spark.createDataFrame(rows, "source_file string, row_order int, ugb string, funcao string, "
                                     "programa string, fr string, ced string, x double")
    assert {(r.source_file, r.row_order) for r in dedup_by_amount(df, "x").collect()} == {("f", 0), ("f", 2), ("g", 0)}


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        S.Rules(dedup_key="x")
    with pytest.raises(ValueError):
        collapse_one_level(spark.range(1), "AC")
    with pytest.raises(ValueError):
        read_extracts(spark, "/tmp", layout="x")


REQUIRED_HEADER = ",".join(REQUIRED)


@pytest.mark.parametrize("name", ["a b 20250831 20250905.csv", "r#1_20250831.csv", "r%201_20250831.csv", "r+1_20250831.csv", "r[1]_20250831.csv"])
def test_names_as_they_are(spark, tmp_path, name):
    (tmp_path / name).write_text(REQUIRED_HEADER + "\n" + ",".join("1" * len(REQUIRED)) + "\n")
    (tmp_path / "k=v").mkdir()
    (tmp_path / "k=v" / "other.csv").write_text(REQUIRED_HEADER + "\n" + ",".join("1" * len(REQUIRED)) + "\n")
    rows = with_file_metadata(read_extracts(spark, str(tmp_path)).rows, "source_file").collect()
    assert [r.source_file for r in rows] == [name]
    assert str(rows[0].data_reporte) == "2025-08-31"


def test_unreadable_file_and_half_a_report(spark, tmp_path):
    good = spark.createDataFrame([("1",) * len(REQUIRED)], ",".join(f"{c} string" for c in REQUIRED))
    for report, part in (("one", good), ("two", good), ("two", good.drop("ced"))):
        part.write.mode("append").parquet(str(tmp_path / f"source_file={report}"))
    (tmp_path / "source_file=three").mkdir()
    (tmp_path / "source_file=three" / "x.parquet").write_text("this is no parquet file")
    read = read_extracts(spark, str(tmp_path), "parquet", layout="folder")
    assert [r.source_file for r in read.rows.collect()] == ["one"]
    assert {r.source_file for r in read.rejects.collect()} == {"two", "three"}


def report(tmp_path, name, *lines):
    (tmp_path / name).write_text("\n".join([REQUIRED_HEADER, *lines]) + "\n")


def test_empty_and_malformed_files_are_rejected(spark, tmp_path):
    line = ",".join("1" * len(REQUIRED))
    report(tmp_path, "good%20.csv", line)
    (tmp_path / "empty#%20.csv").write_text("")
    report(tmp_path, "broken%20.csv", line, '"a\nb"' + line[1:])
    (tmp_path / "head.csv").write_text('"a\nb",' + REQUIRED_HEADER + "\n1," + line + "\n")
    read = read_extracts(spark, str(tmp_path))
    assert [r.source_file for r in read.rows.collect()] == ["good%20.csv"]
    assert {r.source_file: r.missing for r in read.rejects.collect()} == {
        "empty#%20.csv": ["empty file"], "broken%20.csv": ["malformed line"], "head.csv": ["header of several lines"]}
    with pytest.raises(Exception, match="malformed line in broken"):
        read_extracts(spark, str(tmp_path), malformed="raise").rows.select("ced").collect()


def test_cells_with_line_breaks(spark, tmp_path):
    rest = ["1"] * (len(REQUIRED) - 1)
    report(tmp_path, "a.csv", ",".join(['"x\ny ""z"""', *rest]), ",".join(["w", *rest]))
    read = read_extracts(spark, str(tmp_path), multi_line=True)
    assert [r[REQUIRED[0]] for r in read.rows.orderBy("row_order").collect()] == ['x\ny "z"', "w"]
    assert read.rejects.count() == 0


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    line = ",".join("1" * len(REQUIRED))
    jobs = []
    for n in (3, 12):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            report(folder, f"{i}.csv", line)
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        assert read_extracts(spark, str(folder)).rows.columns
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}")))
    assert jobs[0] == jobs[1]


def test_lookup_sheet_of_several_parts(spark, tmp_path):
    for part, code in (("a", "1"), ("b", "2")):
        (tmp_path / f"{part}.csv").write_text(f"Título\nCódigo,Designação\n{code},x\n")
    sheet = read_table(spark, str(tmp_path), skip=1)
    assert sorted(tuple(r) for r in sheet.collect()) == [("1", "x"), ("2", "x")]
    (tmp_path / "c.csv").write_text("Título\nDesignação,Código\ny,3\n")
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), skip=1)


def test_sorted_sink(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, i) for i in range(200)]
    write_parquet(spark.createDataFrame(rows, "k int, i int").repartition(4), str(tmp_path / "o"), sort_by=["k", "i"])
    parts = sorted((tmp_path / "o").glob("part-*"))
    got = [tuple(r) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is None, r))


def test_a_wide_lookup_is_not_broadcast(spark):
    wide = spark.createDataFrame([("x" * 1000,)], "c string")
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hint(J.broadcast_if_small(wide)) and not hint(J.broadcast_if_small(wide, max_bytes=999))
