"""Staged records: numbers, quotes over lines, merged cells and layouts, whatever the
chunks and splits; a fixed number of jobs for any number of files."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from vitals.operators.reshape import wide_csv_to_long
from vitals.session import scratch_path
from vitals.sources import files, landing, layers, lines

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture(params=[1, 16])
def chunk(request, monkeypatch, spark):
    """Chunks of two lines and splits of 64 bytes, or the defaults."""
    monkeypatch.setattr(lines, "CHUNK_BITS", request.param)
    if request.param == 1:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def write(folder, texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    return str(folder)


def quoted_file(seed, n):
    draw, out, rows = random.Random(seed), io.StringIO(), []
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["a", "b"])
    for k in range(n):
        text = draw.choice(["plain", "with, comma", 'say "x"', "two\nlines", 'three\n"q"\nlines', "é\n", "\n\n", "x" * 70])
        rows.append((k, text))
        writer.writerow([k, text])
    return out.getvalue(), rows


def test_records_over_lines_are_those_of_a_csv_reader(spark, tmp_path, chunk):
    texts, want = {}, set()
    for seed in range(4):
        text, rows = quoted_file(seed, 40)
        texts[f"f{seed}.csv"] = text
        want |= {(f"f{seed}.csv", *r) for r in rows}
    landed = landing.read_files(spark, write(tmp_path / "q", texts), landing.Layout(AB, strict=True))
    got = [(r.archivo_origen, r.a, r.b) for r in landed.good().collect()]
    assert len(got) == len(want) and {(f, a, (b or "").strip("\n")) for f, a, b in got} == {(f, a, b.strip("\n")) for f, a, b in want}
    assert landed.rejected().count() == 0


def test_line_numbers_and_reasons_of_rejected_records(spark, tmp_path, chunk):
    text = "a,b\n1,x\n\nbad,y\n2\n3,z,q\n,\n4,\"ok\nok\"\nn/d,w\n"
    folder = write(tmp_path / "r", {"one.csv": text, "page.html": "<!DOCTYPE html>\n<p>a</p>\n", "other.csv": "x;y\n1;2\n", "empty.csv": ""})
    landed = landing.read_files(spark, folder, landing.Layout(AB, strict=True))
    root = scratch_path(spark, "t")
    out, report = landing.land_files(landed, "S", root)
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, "x"), (4, "ok\nok")]
    rejected = layers.read_table(spark, root, "sandbox", "S_rechazos")
    got = sorted((r.archivo_origen, r.linea, r.motivo) for r in rejected.collect())
    assert got == [("one.csv", 4, "tipo:a"), ("one.csv", 5, "columnas"), ("one.csv", 6, "columnas"), ("one.csv", 7, "vacia"), ("one.csv", 10, "tipo:a"),
                   ("other.csv", 1, "cabecera"), ("other.csv", 2, "cabecera"), ("page.html", 1, "html"), ("page.html", 2, "html")]
    assert tuple(report.first())[1:] == (11, 2, 9)


def test_a_stray_quote_spoils_no_other_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "MOST_LINES", 20)
    text = "a,b\n" + "".join(f"{k},{'\"open' if k == 50 else 't'}\n" for k in range(100))
    landed = landing.read_files(spark, write(tmp_path / "s", {"f.csv": text}), landing.Layout(AB, strict=True))
    assert sorted(r.a for r in landed.good().collect()) == [k for k in range(100) if k != 50]
    assert [(r.linea, r.motivo) for r in landed.rejected().collect()] == [(52, "comillas")]


def test_number_of_jobs_does_not_depend_on_the_files(spark, tmp_path):
    def jobs(n):
        folder = write(tmp_path / f"n{n}", {f"f{k}.csv": ("a,b\n" if k % 2 else "b,a,c\n") + ("1,x\n" if k % 2 else "x,1,y\n") for k in range(n)})
        group = f"landing-{n}"
        spark.sparkContext.setJobGroup(group, group)
        assert landing.read_files(spark, folder, landing.Layout(AB)).good().count() == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    few, many = jobs(4), jobs(600)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= few + 2  # Spark lists many paths in a job of its own


def test_layouts_by_similarity(spark, tmp_path):
    one = landing.Layout(T.StructType([T.StructField(c, T.IntegerType()) for c in ("anio", "general", "materna")]), name="one")
    two = landing.Layout(T.StructType([T.StructField(c, T.IntegerType()) for c in ("anio", "defunciones", "poblacion")]), renames={"poblacion total": "poblacion"}, name="two")
    folder = write(tmp_path / "l", {"1.csv": "anio,general,materna\n1,2,3\n", "2.csv": "poblacion total,anio,defunciones\n6,4,5\n",
                                    "3.csv": "general,nota,anio\n8,x,7\n", "4.csv": "anio,otra,cosa,mas\n1,2,3,4\n"})
    landed = landing.read_files(spark, folder, [one, two], least=0.3)
    assert sorted(tuple(r)[:3] for r in landed.good("one").collect()) == [(1, 2, 3), (7, 8, None)]
    assert [tuple(r)[:3] for r in landed.good("two").collect()] == [(4, 5, 6)]
    assert {r.archivo_origen for r in landed.rejected().collect()} == {"4.csv"}


def test_merged_cells_over_chunks(spark, tmp_path, chunk):
    rows = [("v1", "1", "x")] + [("", str(k), "y") for k in range(2, 30)] + [("", "", "")] + [("v2", "30", "z")] + [("", str(k), "w") for k in range(31, 50)]
    text = "Title,,\nvariable,codigo,etiqueta\n" + "".join(",".join(r) + "\n" for r in rows)
    folder = write(tmp_path / "d", {"a.csv": text, "b.csv": "T,,\nvariable,codigo,etiqueta\n,1,first has no value\nv9,2,x\n,3,y\n"})
    got = files.read_sheet(spark, folder, ["variable", "codigo", "etiqueta"], fill_down=["variable"]).collect()
    a = {r.codigo: r.variable for r in got if r.file.endswith("a.csv")}
    assert a == {str(k): "v1" if k < 30 else "v2" for k in range(1, 50)}
    assert {r.codigo: r.variable for r in got if r.file.endswith("b.csv")} == {"1": None, "2": "v9", "3": "v9"}


def test_wide_files_with_different_dates_and_quotes(spark, tmp_path, chunk):
    folder = write(tmp_path / "w", {
        "a.csv": "﻿codigo,lugar,2020-01-01,2020-01-02,nota\n1,\"San Juan, \"\"S\"\"\",2,,x\n2,\"two\nlines\",0,5.0,\n3,short,1\n",
        "b.csv": "codigo,lugar,2020-02\n4,plain,7\n5,n/d,n/d\n", "c.csv": "codigo,lugar\n9,x\n"})
    got = sorted(tuple(map(str, r)) for r in wide_csv_to_long(spark, folder, 2).collect())
    assert got == [("1", 'San Juan, "S"', "2020-01-01", "2"), ("2", "two\nlines", "2020-01-02", "5"), ("4", "plain", "2020-02-01", "7")]


def test_an_unreadable_folder_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="no readable file"):
        landing.read_files(spark, write(tmp_path / "u", {"p.csv": "<html>\n"}), landing.Layout(AB))


def test_wide_file_in_parts(spark, tmp_path):
    """A group of lines laid down as several files, each with the header, lands as one."""
    from vitals.sources import files
    head = "codigo,nombre,2020-01-01,2020-01-02,2020-01-03"
    rows = spark.range(40).selectExpr("id % 2 AS grupo", "concat(id, ',\"a, b\",0,', id + 1, ',0') AS value")
    folder = str(tmp_path / "wide")
    files.write_text_files(rows, "grupo", head, folder, parts=3)
    texts = [r.value.splitlines() for r in spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).collect()]
    assert len(texts) == 6 and all(t[0] == head and head not in t[1:] for t in texts)
    got = {(int(r.codigo), str(r.fecha), r.n) for r in wide_csv_to_long(spark, folder, 2).collect()}
    assert got == {(i, "2020-01-02", i + 1) for i in range(40)}


def test_parts_seen_are_one_row_each(spark, tmp_path, monkeypatch):
    """The parts that gave rows are told apart from the bad ones by a table of parts, not by all their rows."""
    from vitals.sources import files
    held = []
    monkeypatch.setattr(files, "materialize", lambda df, name, make=files.materialize: held.append(make(df, name)) or held[-1])
    folder = tmp_path / "partes"
    spark.range(5000).repartition(3).write.parquet(str(folder))
    (folder / "login.txt").write_text("<!DOCTYPE html><html></html>")
    good, bad = files.read_parquet_parts_tolerant(spark, str(folder))
    assert good.count() == 5000 and [why for _, why in bad] == ["html"]
    assert [t.count() for t in held] == [3]
