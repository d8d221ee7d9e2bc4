import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.sources import files, release
from canvass.streaming import events


def test_csv_with_bom_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('﻿id,"a.b",name \n1,"x ""y""","two\nlines"\n2,,\n'.encode())
    got = files.csv_strings(spark, str(path))
    assert got.columns == ["id", "a.b", "name"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("1", 'x "y"', "two\nlines"), ("2", "", "")]


def test_geojson_and_positions(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text(json.dumps({"features": [{"properties": {"name": "n", "c": 3}, "geometry": {"type": "Polygon", "coordinates": [[[1.5, 2], [3, 4e1], [-5, 6]]]}}]}))
    r = files.geojson_features(spark, str(path)).select("properties", "kind", files.positions(F.col("coordinates")).alias("p")).first()
    assert (r["properties"]["c"], r["kind"], [tuple(p) for p in r["p"]]) == ("3", "Polygon", [(1.5, 2.0), (3.0, 40.0), (-5.0, 6.0)])


def test_sheet_header_is_found(spark):
    cells = [("s", 0, 0, "title"), ("s", 3, 1, "Code  x"), ("s", 3, 2, "Name"), ("s", 4, 1, "7"), ("s", 4, 2, "a"), ("s", 5, 1, " "), ("s", 6, 2, "b")]
    got = files.sheet_rows(spark.createDataFrame(cells, "sheet string, row int, col int, value string"), ["Code", "Name"])
    assert [tuple(r) for r in got.orderBy("row").select("row", "Code", "Name").collect()] == [(4, "7", "a"), (6, "", "b")]


def test_html_tables(spark):
    html = "<table><tr><th>A</th><th>B</th></tr><tr><td>1 <b>x</b></td><td>&amp;</td></tr></table>"
    got = files.html_tables(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"), "page_id", "html")
    assert [(r["row"], r["cells"]) for r in got.orderBy("row").collect()] == [(0, ["A", "B"]), (1, ["1 x", "&"])]


def test_exports_are_stable(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a"b', None), (1, "x,y", "é"), (1, "two\nlines", "")], "id int, t string, u string")
    one = release.export_csv(df, ["id"], f"file://{tmp_path}/out/a.csv", parts=1)
    two = release.export_csv(df.repartition(3), ["id"], f"file://{tmp_path}/out/b.csv", parts=8)
    assert one["sha256"] == two["sha256"] and one["rows"] == 3 and one["bytes"] == len((tmp_path / "out/a.csv").read_bytes())
    assert (tmp_path / "out/a.csv").read_text(encoding="utf-8-sig") == 'id,t,u\n1,"two\nlines",\n1,"x,y",é\n2,"a""b",\n'
    assert hashlib.sha256((tmp_path / "out/b.csv").read_bytes()).hexdigest() == two["sha256"]


def test_json_exports_are_arrays(spark, tmp_path):
    df = spark.range(2500).select("id", F.concat(F.lit("é\n,"), "id").alias("b"), F.when(F.col("id") % 2 == 0, 1.5).alias("a"))
    entries = [release.export_json(df, ["id"], f"file://{tmp_path}/{n}.json", parts=n) for n in (1, 7)]
    assert entries[0]["sha256"] == entries[1]["sha256"]
    got = json.loads((tmp_path / "7.json").read_text())
    assert len(got) == 2500 and got[4] == {"a": 1.5, "b": "é\n,4", "id": 4} and list(got[4]) == ["a", "b", "id"]
    release.export_json(df.limit(0), ["id"], f"file://{tmp_path}/0.json")
    assert json.loads((tmp_path / "0.json").read_text()) == []


def test_zips_are_stable_and_whole(spark, tmp_path):
    contents = {"b.txt": b"x" * 300_000, "a.bin": bytes(range(256)) * 9000, "é empty.csv": b""}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    files_ = [f"file://{tmp_path}/{n}" for n in contents]
    one, two = release.stable_zip(spark, files_, f"file://{tmp_path}/z/1.zip"), release.stable_zip(spark, files_[::-1], f"file://{tmp_path}/z/2.zip")
    assert one["sha256"] == two["sha256"]
    with zipfile.ZipFile(tmp_path / "z" / "1.zip") as packed:
        assert packed.testzip() is None and packed.namelist() == sorted(contents)
        assert all(packed.read(n) == c for n, c in contents.items()) and {(e.date_time, e.external_attr >> 16) for e in packed.infolist()} == {((1980, 1, 1, 0, 0, 0), 0o644)}
    got = release.unzipped(spark.read.format("binaryFile").load(f"file://{tmp_path}/z/1.zip")).collect()
    assert {r["name"]: bytes(r["content"]) for r in got} == contents
    with pytest.raises(ValueError, match="one name"):
        release.stable_zip(spark, [files_[0], files_[0]], f"file://{tmp_path}/z/3.zip")


def test_only_folders_below_the_root_are_emptied(spark, tmp_path):
    (tmp_path / "root" / "out").mkdir(parents=True)
    (tmp_path / "root" / "out" / "f").write_text("x")
    release.reset(spark, f"file://{tmp_path}/root/out", f"file://{tmp_path}/root")
    assert list((tmp_path / "root" / "out").iterdir()) == []
    for outside in ("root", "root/../other", "rootless"):
        with pytest.raises(ValueError):
            release.reset(spark, f"file://{tmp_path}/{outside}", f"file://{tmp_path}/root")


def test_manifest(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "f.bin").write_bytes(b"abc")
    r = release.manifest(spark, f"file://{tmp_path}/x").first()
    assert (r["path"], r["bytes"], r["sha256"][:8]) == ("f.bin", 3, "ba7816bf")


def test_stream_gives_the_batch_result(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"), T.StructType(batch.schema.fields))
    query = events.windowed_counts(stream, late="60 days").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    try:
        query.processAllAvailable()
        assert sorted(spark.table("counts").collect()) == sorted(events.windowed_counts(batch).collect())
    finally:
        query.stop()


def test_lines_join_to_records(spark):
    rows = [("d", 0, "preface"), ("d", 1, "1. first"), ("d", 2, "  goes on "), ("d", 3, "2. second")]
    got = files.joined_lines(spark.createDataFrame(rows, "doc string, line int, text string"), "doc", "line", "text", F.col("text").rlike("^[0-9]"))
    assert [tuple(r) for r in got.orderBy("record").collect()] == [("d", 1, "1. first goes on"), ("d", 2, "2. second")]


def test_geobuf_properties(spark, tmp_path):
    import struct

    from canvass.sources import geobuf

    def number(n):
        out = b""
        while n >= 0x80:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    def block(field, data):
        return number(field << 3 | 2) + number(len(data)) + data

    values = [block(1, "שם".encode()), number(2 << 3 | 1) + struct.pack("<d", 1.5), number(3 << 3) + number(300), number(4 << 3) + number(7), number(5 << 3) + number(1)]
    pairs = b"".join(number(k) + number(k) for k in range(5))
    feature = number(12 << 3) + number(9) + b"".join(block(13, v) for v in values) + block(14, pairs)
    data = b"".join(block(1, k.encode()) for k in "abcde") + block(4, block(1, feature) + block(1, block(11, b"x")))
    (tmp_path / "f.pbf").write_bytes(data)
    got = {r["id"]: r["properties"] for r in geobuf.geobuf_features(spark, f"file://{tmp_path}/f.pbf").collect()}
    assert got == {"-5": {"a": "שם", "b": "1.5", "c": "300", "d": "-7", "e": "true"}, "x": {}}


def test_written_csv_is_the_same_whatever_the_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'a "{i}", b' if i % 3 else None) for i in range(50)], "id int, t string")
    texts = []
    for n, df in enumerate((rows, rows.repartition(7).orderBy("t"))):
        release.write_csv(df, ["id"], f"file://{tmp_path}/{n}", parts=3)
        parts = sorted((tmp_path / str(n)).glob("part-*"))
        texts.append("".join(line for p in parts for line in p.read_text(encoding="utf-8-sig").splitlines(keepends=True)[1:]))
    assert texts[0] == texts[1] and len(texts[0].splitlines()) == 50
    assert files.csv_strings(spark, f"file://{tmp_path}/none.csv", ["id", "t"]).count() == 0


def test_archives_are_unpacked_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a")
    release.stable_zip(spark, [f"file://{tmp_path}/a.txt"], f"file://{tmp_path}/zips/a.zip")
    archive, folder = f"file://{tmp_path}/zips/a.zip", f"file://{tmp_path}/out"
    release.extracted(spark, archive, folder)
    assert (tmp_path / "out" / "a.txt").read_text() == "a"
    (tmp_path / "out" / "a.txt").write_text("kept")
    release.extracted(spark, archive, folder)
    assert (tmp_path / "out" / "a.txt").read_text() == "kept"
    (tmp_path / "out" / "_SUCCESS").unlink()  # as after a crash: it is not whole, so it is unpacked again
    release.extracted(spark, archive, folder)
    assert (tmp_path / "out" / "a.txt").read_text() == "a"
