"""Workbooks, page tables, Geobuf and composites: forms that the queries do not show, and what must fail."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from canvass.operators import contracts, lookup
from canvass.sources import files, geobuf, workbook


def frame(spark, *books):
    return spark.createDataFrame([(f"b{i}", bytearray(b)) for i, b in enumerate(books)], "path string, content binary")


def test_workbook_round_trip(spark):
    rows = [["a <b> & c", 3, None, 4.5], [], ["é漢", None, None, "a <b> & c"], [None] * 30 + ["far"]]
    book = workbook.packed([("first", [["x"]]), ("last & least", rows)])
    assert book == workbook.packed([("first", [["x"]]), ("last & least", rows)])
    got = {(r["sheet"], r["sheet_no"], r["row"], r["col"]): r["value"] for r in workbook.cells(frame(spark, book)).collect()}
    assert got == {("first", 0, 0, 0): "x", ("last & least", 1, 0, 0): "a <b> & c", ("last & least", 1, 0, 1): "3", ("last & least", 1, 0, 3): "4.5", ("last & least", 1, 2, 0): "é漢", ("last & least", 1, 2, 3): "a <b> & c", ("last & least", 1, 3, 30): "far"}
    body = workbook.last_sheet(frame(spark, book), 0, ["p", "q"])
    assert [(r["row"], r["p"], r["q"]) for r in body.collect()] == [(2, "é漢", "")]


def test_other_writers_cells(spark):
    """Inline texts, runs, phonetic text, cells and rows without references, a sheet's absolute target."""
    main = workbook.MAIN[1:-1]
    parts = {
        workbook.BOOK: f'<workbook xmlns="{main}" xmlns:r="{workbook.RELATION[1:-3]}"><sheets><sheet name="s" r:id="rId9"/></sheets></workbook>',
        workbook.LINKS: f'<Relationships xmlns="{workbook.TARGETS[1:-1]}"><Relationship Id="rId9" Target="/xl/w/one.xml"/></Relationships>',
        workbook.SHARED: f'<sst xmlns="{main}"><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si><si/></sst>',
        "xl/w/one.xml": f'<worksheet xmlns="{main}"><sheetData><row><c t="inlineStr"><is><t>in</t></is></c><c t="s"><v>0</v></c><c/><c t="b"><v>1</v></c></row><row><c t="s"><v>1</v></c></row></sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    got = sorted((r["row"], r["col"], r["value"]) for r in workbook.cells(frame(spark, out.getvalue())).collect())
    assert got == [(0, 0, "in"), (0, 1, "two runs"), (0, 3, "1"), (1, 0, "")]
    assert workbook.cells(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("reference, place", [("A1", 0), ("Z9", 25), ("AA1", 26), ("AZ3", 51), ("BA1", 52), ("XFD7", 16383)])
def test_column_references(reference, place):
    assert workbook._column(reference) == place and workbook._letters(place) == reference.rstrip("0123456789")


def test_tables_are_told_by_their_header(spark):
    html = """<table><tr><th>Other</th></tr><tr><td>no</td></tr></table>
    <table><tr><td>Votes</td><td>List  name</td><td>Letter</td></tr><tr><td>1</td><td title="the longer name">short</td><td>a</td></tr>
    <tr><td>2</td><td title="x">the text</td><td>b</td><td>1,234 in all</td></tr><tr><td>3</td><td>no letter</td><td> </td></tr><tr><td>4</td></tr></table>"""
    got = files.html_records(spark.createDataFrame([(1, html), (2, None), (3, "<table><tr><td>Letter</td></tr></table>")], "id long, html string"), "id", "html", {"List name": "name", "Letter": "letter"})
    assert [tuple(r) for r in got.orderBy("letter").collect()] == [(1, "the longer name", "a", "a"), (1, "the text", "b", "1,234 in all")]


def test_geobuf_values(spark):
    content = geobuf.encoded([("é", {"t": "x" * 300, "n": -5, "p": 2**40, "f": True, "d": 0.5, "none": None}), ("2", {"p": 0, "new": "y"})])
    got = {r["id"]: r["properties"] for r in geobuf.features_of(frame(spark, content)).collect()}
    assert got == {"é": {"t": "x" * 300, "n": "-5", "p": str(2**40), "f": "true", "d": "0.5"}, "2": {"p": "0", "new": "y"}}


COMPOSITES = "composite string, host int, components array<int>"


def test_results_go_under_their_composites(spark):
    results = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "locality int, n int").withColumn("locality", F.col("locality").cast("string"))
    composites = spark.createDataFrame([("c1", "1", ["1", "8"])], "composite string, host string, components array<string>")
    assert sorted(map(tuple, lookup.under_composites(results, "locality", composites).collect())) == [("2", 20), ("3", 30), ("c1", 10)]


@pytest.mark.parametrize("composites, fault", [([("c", 1, [2, 8])], "invalid"), ([(None, 1, [1])], "invalid"), ([("c", 1, [1]), ("d", 1, [1, 9])], "host_twice"), ([("c", 7, [7])], "no_host_result"), ([("c", 1, [1, 2])], "hides_result")])
def test_composites_at_fault(spark, composites, fault):
    results = spark.createDataFrame([(1,), (2,)], "locality int")
    faults = {r["fault"] for r in lookup.composite_faults(results, "locality", spark.createDataFrame(composites, COMPOSITES)).collect()}
    assert fault in faults
    with pytest.raises(contracts.ContractError):
        lookup.under_composites(results, "locality", spark.createDataFrame(composites, COMPOSITES))


def test_repeated_localities_fail(spark):
    none = spark.createDataFrame([], COMPOSITES)
    for rows in ([(1,), (1,)], [(None,)]):
        with pytest.raises(contracts.ContractError, match="repeated"):
            lookup.under_composites(spark.createDataFrame(rows, "locality int"), "locality", none)


def test_field_sets_against_the_usual_one(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 1, "a": 2},), ({"a": 1},), ({"a": 1, "b": 1, "c": 1},)], "p map<string,int>")
    got = {r["fields"]: (r["n"], r["lacking"], r["more"]) for r in contracts.field_sets(df, "p").collect()}
    assert got == {"a|b": (2, "", ""), "a": (1, "b", ""), "a|b|c": (1, "", "c")}
