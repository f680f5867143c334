"""From files to the published table, prepared lookups, types over headers, and the order of written files."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rubrica import schema as S
from rubrica.functions.types import widest, widest_schema
from rubrica.operators import joins as J
from rubrica.operators.columns import numeric_names
from rubrica.operators.quality import order_of_files
from rubrica.plans.enrich import enrich
from rubrica.plans.net import process_extracts
from rubrica.plans.publish import publish, read_published
from rubrica.sources.dimensions import Dimensions, load_dimensions, read_table
from rubrica.sources.extracts import read_extracts, type_extract
from rubrica.sources.sinks import replace_partitions, write_parquet

HEADER = [*S.UNIT_KEY, "ced", S.METRICS[0], "Execução %", S.METRICS[-1], "nota"]
TYPES = ("OrcamentoFuncionamento", "InvestimentoCompExterna")


def report(folder, name, rows, header=HEADER):
    lines = [",".join(header), *[",".join(str(x) for x in r) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def line(ced, x, y, unit=1):
    return (f"50A{unit:06d} - U", "01", "P", "101", ced, x, "9%", y, "n")


@pytest.fixture
def dims(spark, tmp_path):
    (tmp_path / "units.csv").write_text(
        "SISTEMA\nCódigo UGB,Nome UGB,Âmbito,Província,Distrito,Adm2020_24,Adm2025_29,Nível da Instituição,Obs\n"
        "50A000001,Um,A,-,CIDADE DA-BEIRA,p,q,N,o\n50A000002,Dois,A,Sofala,-,p,q,N,o\n", encoding="utf-8")
    (tmp_path / "names.csv").write_text(
        "SISTEMA\nCódigo,Designação,Código Receita,Tipo Receita,Financiador\n111100.0,Bens,,,\n110000,Todos,,,\n,,101.0,Tesouro,Interno\n",
        encoding="utf-8")
    sheets = [read_table(spark, str(tmp_path / f"{n}.csv"), skip=1) for n in ("units", "names")]
    return load_dimensions(*sheets).prepared()


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_publish_replaces_reports_and_keeps_the_others(spark, tmp_path, dims):
    files, out = tmp_path / "files", str(tmp_path / "out")
    files.mkdir()
    names = {"a": f"{TYPES[0]} #1_20250131_20250205.csv", "b": f"{TYPES[0]}%20+_20250228_20250305.csv", "c": f"{TYPES[1]}_20240131_20240205.csv"}
    for name in names.values():
        report(files, name, [line("110000", 100, 50), line("111100", 40, 20), line("111100", 7, 7, unit=9)])
    read = lambda: read_extracts(spark, str(files))
    first = publish(read(), dims, out)
    once = rows_of(first)
    assert {(r.fonte_reporte, r.ced, r.dotacao_inicial, r.ced_desc, r.fr_nome, r.provincia, r.distrito, r.ano, r.mes)
            for r in first.collect()} == {
        (n, c, x, d, "Tesouro", "Central", "Cidade Da-Beira", 2025 if n != names["c"] else 2024, m)
        for n, m in ((names["a"], "Janeiro"), (names["b"], "Fevereiro"), (names["c"], "Janeiro"))
        for c, x, d in (("110000", 60.0, "Todos"), ("111100", 40.0, "Bens"))}
    assert rows_of(publish(read(), dims, out)) == once

    # One report corrected, alone in the folder: its rows change, those of its partition and others stay.
    for other in ("b", "c"):
        (files / names[other]).unlink()
    report(files, names["a"], [line("111100", 1, 2, unit=2)])
    again = publish(read(), dims, out).collect()
    assert {(r.fonte_reporte, r.dotacao_inicial) for r in again} == {
        (names["a"], 1.0), *[(names[k], x) for k in "bc" for x in (60.0, 40.0)]}
    assert {r.distrito for r in again if r.fonte_reporte == names["a"]} == {"Central"}
    # Nothing usable: nothing changes.
    (files / names["a"]).write_text("x\n1\n")
    assert len(publish(read(), dims, out).collect()) == len(again)


def test_publish_where_reports_have_no_date(spark, tmp_path, dims):
    (tmp_path / "f").mkdir()
    report(tmp_path / "f", "outro.csv", [line("111100", 1, 2)])
    for _ in range(2):
        found = publish(read_extracts(spark, str(tmp_path / "f")), dims, str(tmp_path / "out"))
        assert [(r.ano, r.reporte_tipo, r.fonte_reporte) for r in found.collect()] == [(None, None, "outro.csv")]
    assert dict(found.dtypes)["ano"] == "int"


def test_published_rows_are_sorted_in_their_folders(spark, tmp_path, dims):
    (tmp_path / "f").mkdir()
    rng = random.Random(2)
    for month in range(1, 6):
        rows = [line(f"1{rng.randrange(10 ** 5):05d}", 1, 1, rng.choice((1, 2))) for _ in range(60)]
        report(tmp_path / "f", f"{TYPES[month % 2]}_2025{month:02d}28_20250905.csv", rows)
    publish(read_extracts(spark, str(tmp_path / "f")), dims, str(tmp_path / "out"))
    files = order_of_files(spark.read.parquet(str(tmp_path / "out")), ["fonte_reporte", "ugb_id", "funcao", "programa", "fr", "ced"], ["ano", "reporte_tipo"])
    assert files.count() >= 2 and not files.where("not in_order").count()


def test_metrics_by_position_over_headers_that_differ(spark, tmp_path, dims):
    (tmp_path / "f").mkdir()
    wide = [*HEADER[:6], "Nova Métrica", *HEADER[6:]]
    report(tmp_path / "f", f"{TYPES[0]}_20250131_20250205.csv", [line("110000", 10, 5), line("111100", 4, 2)])
    extra = lambda *r: (*r[:6], r[5] * 3, *r[6:])
    report(tmp_path / "f", f"{TYPES[1]}_20250131_20250205.csv", [extra(*line("110000", 10, 5)), extra(*line("111100", 4, 2))], wide)
    extracts = read_extracts(spark, str(tmp_path / "f"))
    assert extracts.metrics == (*S.METRICS, "nova_metrica")
    typed = type_extract(extracts.rows, extracts.metrics)
    assert numeric_names(typed) and set(numeric_names(typed)) == set(extracts.metrics)
    found = publish(extracts, dims, str(tmp_path / "out"))
    assert {(r.reporte_tipo, r.ced, r.nova_metrica) for r in found.collect()} == {
        ("Funcionamento", "110000", None), ("Funcionamento", "111100", None),
        ("Investimento Externo", "110000", 18.0), ("Investimento Externo", "111100", 12.0)}


INT, LONG, DOUBLE, TEXT, DAY, TIME = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampType()


@pytest.mark.parametrize("a, b, out", [
    (INT, INT, INT), (INT, LONG, LONG), (INT, DOUBLE, DOUBLE), (LONG, TEXT, TEXT), (DAY, TIME, TIME), (DAY, INT, TEXT),
    (T.BooleanType(), INT, TEXT), (T.NullType(), DAY, DAY), (T.DecimalType(20, 0), LONG, T.DecimalType(20, 0)),
    (T.DecimalType(25, 2), INT, T.DecimalType(25, 2)), (T.DecimalType(38, 10), T.DecimalType(38, 0), DOUBLE),
    (T.FloatType(), T.FloatType(), T.FloatType()), (T.FloatType(), INT, DOUBLE), (T.ArrayType(INT), INT, TEXT),
])
def test_widest_type(a, b, out):
    assert widest(a, b) == widest(b, a) == out
    assert widest_schema([{"x": a}, {"x": b, "y": a}]) == {"x": out, "y": a}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_types_widen_over_headers(spark, tmp_path, fmt):
    one = spark.createDataFrame([(7, 1, "2025-01-02", 1)], "codigo long, nota int, dia string, a int")
    two = spark.createDataFrame([("007x", 1.5, "2025-01-02 10:00:00")], "codigo string, nota double, dia string")
    if fmt == "parquet":
        one, two = one.withColumn("dia", F.to_date("dia")), two.withColumn("dia", F.to_timestamp("dia"))
    for name, df in (("one", one), ("two", two)):
        folder = str(tmp_path / f"source_file={name}")
        df.write.csv(folder, header=True) if fmt == "csv" else df.write.parquet(folder)
    rows = read_extracts(spark, str(tmp_path), fmt, layout="folder", infer_types=True, required=("codigo",)).rows
    assert {c: t for c, t in rows.dtypes if c in ("codigo", "nota", "dia", "a")} == {
        "codigo": "string", "nota": "double", "dia": "timestamp", "a": "int"}
    assert {(r.codigo, r.nota, r.dia.hour, r.a) for r in rows.collect()} == {("7", 1.0, 0, 1), ("007x", 1.5, 10, None)}


def jobs_of(spark, name, fn):
    spark.sparkContext.setJobGroup(name, "")
    out = fn()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_prepared_lookups_cost_no_job_while_plans_are_built(spark, tmp_path, dims):
    (tmp_path / "f").mkdir()
    report(tmp_path / "f", "x_20250131.csv", [line("111100", 1, 2)])
    typed = type_extract(read_extracts(spark, str(tmp_path / "f")).rows)
    df, jobs = jobs_of(spark, "planned", lambda: enrich(process_extracts(typed, dims.ugb), dims))
    assert jobs == 0 and df.count() == 1
    assert "hint" in df._jdf.queryExecution().logical().toString().lower()


def test_lookups_say_what_they_hold(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k string, v string")
    held = J.prepare_lookup(frame([("a", "x"), ("a", "y"), (None, "z"), (None, "z"), ("b", "w")]), "k")
    assert (held.n_rows, held.n_repeated, held.small) == (5, 2, True)
    assert {(r.k, r.n) for r in held.repeated().collect()} == {("a", 2), (None, 2)}
    none = J.prepare_lookup(frame([]), "k")
    assert (none.n_rows, none.n_bytes, none.n_repeated, none.small) == (0, 0, 0, True)
    large = J.Lookup(held.rows, ("k",), J.BROADCAST_ROWS + 1, 1, 0)
    wide = J.Lookup(held.rows, ("k",), 1, J.BROADCAST_BYTES + 1, 0)
    df = frame([("a", "1"), (None, "2")]).withColumnRenamed("v", "own")
    for dim in (held, large, wide):
        found = J.lookup(df, dim, {"k": "k"})
        assert sorted((r.own, r.v) for r in found.collect()) == [("1", "x"), ("1", "y"), ("2", "z"), ("2", "z")]
        assert ("hint" in found._jdf.queryExecution().logical().toString().lower()) == dim.small
    assert Dimensions(held, none, none).ugb is held


def test_files_out_of_order_are_found(spark, tmp_path):
    good = [(1, "a"), (1, "b"), (2, None)]
    cases = {"good": [good, [(3, "a"), (None, "x")]], "across": [good, [(1, "z"), (4, "a")]], "inside": [[(2, "a"), (1, "a"), (3, "a")]],
             "nulls": [[(None, "a"), (1, "a")]], "equal": [good, [(2, None)]]}
    for name, files in cases.items():
        for i, rows in enumerate(files):
            folder = tmp_path / f"part={name}"
            spark.createDataFrame(rows, "k int, s string").coalesce(1).write.parquet(str(tmp_path / "x" / f"{name}{i}"))
            folder.mkdir(exist_ok=True)
            next((tmp_path / "x" / f"{name}{i}").glob("*.parquet")).rename(folder / f"part-{i}.parquet")
    table = spark.read.option("basePath", str(tmp_path)).parquet(*[str(tmp_path / f"part={n}") for n in cases])
    found = order_of_files(table, ["k", "s"], ["part"])
    by_case = {n: [r.in_order for r in sorted(found.collect(), key=lambda r: r.file) if r.part == n] for n in cases}
    assert by_case == {"good": [True, True], "across": [True, False], "inside": [False], "nulls": [False], "equal": [True, True]}


def test_only_partitions_with_rows_are_replaced(spark, tmp_path):
    write = lambda rows: replace_partitions(spark.createDataFrame(rows, "p int, v int"), str(tmp_path / "o"), ["p"], ["v"])
    write([(1, 1), (2, 2)])
    write([(1, 5), (None, 7)])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).select("p", "v").collect()} == {(1, 5), (2, 2), (None, 7)}
    assert read_published(spark, str(tmp_path / "nothing")) is None


def bytes_read(spark, fn):
    """Bytes that the file systems of this JVM handed out meanwhile."""
    stats = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = stats()
    fn()
    return stats() - before


def test_files_are_read_once(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for i in range(3):
        report(tmp_path / "f", f"r{i}_20250131.csv", [line(f"1{k % 10 ** 5:05d}", k, k) for k in range(40_000)])
    report(tmp_path / "f", "broken.csv", [line("111100", 1, 1)] * 40_000 + [("x", "y")])
    size = sum(p.stat().st_size for p in (tmp_path / "f").iterdir())
    found = {}

    def read():
        found["read"] = read_extracts(spark, str(tmp_path / "f"))
    assert bytes_read(spark, read) <= 1.1 * size
    copy = bytes_read(spark, lambda: found.update(rows=found["read"].rows.count()))
    assert found["rows"] == 120_000 and copy < 0.5 * size
    assert [r.missing for r in found["read"].rejects.collect()] == [["malformed line"]]
    assert found["read"].reports == tuple(f"r{i}_20250131.csv" for i in range(3))


def test_header_cells_with_line_breaks(spark, tmp_path):
    rest = ",".join([*S.UNIT_KEY[1:], "ced", *S.METRICS])
    (tmp_path / "a.csv").write_text('"u\ngb",' + rest + "\n" + ",".join("1" * 16) + "\n")
    assert read_extracts(spark, str(tmp_path)).rejects.first().missing == ["header of several lines"]
    read = read_extracts(spark, str(tmp_path), multi_line=True, required=("u_gb",))
    assert [r.u_gb for r in read.rows.collect()] == ["1"] and not read.rejects.count()


def test_sorted_write_by_folders(spark, tmp_path):
    rows = [(i % 3, (i * 7919) % 1000 if i % 11 else None) for i in range(3000)]
    write_parquet(spark.createDataFrame(rows, "p int, k int").repartition(5), str(tmp_path / "o"), ["p"], sort_by=["k"])
    files = order_of_files(spark.read.parquet(str(tmp_path / "o")), ["k"], ["p"])
    assert files.where("in_order").count() == files.count() >= 3
    assert files.agg(F.sum("n")).first()[0] == 3000
