"""SRC-1..9, SNK-1..2, OP-1, PIPE-1..4 on files."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelstats.plans.ingest import ingest
from parcelstats.sources import fixed_width as fw
from parcelstats.sources.csv import infer_types, normalise_name, read_csv, write_csv
from parcelstats.sources.extracts import read_extract
from parcelstats.sources.layouts import (
    ASSESSMENTS,
    DWELLINGS,
    OWNERS,
    SALES_STARTS,
    fields,
    spans,
)
from tests.helpers import bag, plan, rows


def write(path, data: bytes) -> str:
    path.write_bytes(data)
    return str(path)


def test_layouts_have_the_documented_size():
    assert [len(fields(layout)) for layout in (ASSESSMENTS, DWELLINGS, OWNERS)] == [8, 45, 11]
    for layout in (ASSESSMENTS, DWELLINGS, OWNERS):
        starts = [start for _, start in fields(layout)]
        assert starts == sorted(set(starts))
    assert dict(fields(DWELLINGS))["cost_and_design_adjustment"] == 202
    assert spans([1, 4, 9]) == [(1, 3), (4, 5), (9, None)]


def test_fields_are_trimmed_and_lose_leading_zeros(spark):
    lines = spark.createDataFrame([("0012 000\t0x ",), ("\xa0 7",), ("",), ("12345678 9",)], "value string")
    found = fw.parse_fixed_width(lines, [("a", 1), ("b", 6), ("c", 9)])
    assert rows(found) == [("12", "0", "x"), ("7", "0", "0"), ("0", "0", "0"), ("12345", "678", "9")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 99_999), min_size=8, max_size=8), min_size=1, max_size=20))
def test_parsing_inverts_formatting(spark, table):
    layout = [(f"c{i}", 1 + 7 * i) for i in range(8)]
    pads = [lambda v: v.zfill(7), lambda v: v.ljust(7), lambda v: v.rjust(7)]
    lines = [("".join(pads[i % 3](str(v)) for i, v in enumerate(row)),) for row in table]
    found = fw.parse_fixed_width(spark.createDataFrame(lines, "value string"), layout)
    assert rows(found) == [tuple(map(str, row)) for row in table]


def assessment(tmk, tax_class, land="0", tail="500"):
    return f"{tmk:>13}02024R   {tax_class:>4}{land:>13}{'':13}{'1000':>13}{tail}"


def test_assessments_file(spark, tmp_path):
    text = "\r\n".join([
        assessment("2110010010001", "9"),
        assessment("2110010010002", "0012", "00070"),
        assessment("2110010010003", "8"),
        assessment("2110010010004", "99", tail=""),
        "2110010010005",
    ])
    path = write(tmp_path / "raw.txt", text.encode())
    found = fw.read_assessments(spark, path)
    columns = ["tmk", "tax_rate_class", "assessed_land_value", "land_exemption", "building_exemption"]
    assert bag(found, *columns) == [
        (2110010010001, "owner-occupied", 0, 0, 500),
        (2110010010002, "long-term-rental", 70, 0, 500),
        (2110010010003, "", 0, 0, 500),
        (2110010010004, None, 0, 0, 0),
        (2110010010005, "timeshare", 0, 0, 0),
    ]
    assert rows(fw.count_unlabelled(found)) == [(5, 1)]
    assert "Python" not in plan(found) and "Exchange" not in plan(found)


def test_owners_file_in_the_legacy_code_page(spark, tmp_path):
    line = "0002110010001" + "José, “A” €".ljust(40) + "X".ljust(40)
    path = write(tmp_path / "raw.txt", (line + "\r\n" + line[:20]).encode("windows-1252"))
    found = fw.read_owners(spark, path)
    assert bag(found, "tmk", "owner", "owner_type", "country") == [
        (2110010001, "José| “", "0", "0"),
        (2110010001, "José| “A” €", "X", "0"),
    ]


def test_rare_white_space_is_trimmed_in_the_legacy_code_page(spark, tmp_path):
    # A no-break space at the edge of a field goes, inside of it stays, as does an ellipsis.
    owner = "\xa0é\xa0x\t".ljust(40)
    line = "0002110010001" + owner + "…".ljust(40) + "\x1f00 y"
    found = fw.read_owners(spark, write(tmp_path / "raw.txt", line.encode("windows-1252")))
    assert rows(found, "owner", "owner_type", "co_mailing_address") == [("é\xa0x", "…", " y")]


def test_every_defined_byte_of_the_code_page(spark, tmp_path):
    undefined = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
    raw = bytes(b for b in range(0x21, 0x100) if b not in undefined)
    lines = fw.read_lines(spark, write(tmp_path / "raw.txt", raw), line_feed_only=True)
    assert rows(lines.select(fw.decode_windows_1252(lines.value))) == [(raw.decode("windows-1252"),)]


NAMES = ["PARID", "SALEDATE", "RECORDDATE", "PRICE", "INSTRUNO", "A", "B", "C", "D", "E", "F", "G", "H", "I", "J"]


def sale(*values):
    widths = [width for _, width in spans(SALES_STARTS)]
    padded = [v.ljust(w - 1) if w else v for v, w in zip(values, widths)]
    return ",".join(padded) + ","


def test_sales_file(spark, tmp_path):
    header = sale(*NAMES)
    values = ["000123", "2001-01-01", "", "0", "X,Y", "000", "a b", "é", "", "0 5", "z", "", "", "1", "end"]
    blank_end = [*values[:-1], ""]
    text = "\n".join([
        "", "  ", header, sale(*values), "", header, sale(*blank_end), "12 rows selected.", sale(*values)[:45] + ",",
    ])
    path = write(tmp_path / "raw.txt", text.encode("windows-1252"))
    found = fw.read_sales(spark, path)
    assert found.columns == [n.lower() for n in NAMES]
    common = (123, "2001-01-01", "", None, "X|Y", "", "a b", "é", "", "5", "z", "", "", "1")
    assert bag(found) == [
        # A short line: fields behind its end are "0".
        (123, "2001-01-01", "", None, *["0"] * 11),
        (*common, "0"),
        (*common, "end"),
    ]


def test_sales_fields_follow_the_stated_rules(spark, tmp_path):
    """Against the rules of the survey, applied line by line in Python."""

    def field(text):
        text = text.strip().lstrip("0") or "0"
        return (text[:-1] if text.endswith(",") else text).strip().replace(",", "|")

    lines = [
        sale("9", "1,2", " 00 7 ", "0,", "00,,", *["  x  "] * 9, "tail"),
        sale("9", *["0"] * 13, "0")[:200],
        sale("9", *["  "] * 14) + "  ",
        "short",
    ]
    found = fw.parse_sales(spark.createDataFrame([(line,) for line in lines], "value string"), sale(*NAMES))
    expected = []
    for line in map(str.strip, lines):
        ends = [*SALES_STARTS[1:], len(line)]
        expected.append(tuple(field(line[s - 1 : e - 1]) for s, e in zip(SALES_STARTS, ends)))
    assert rows(found) == expected


def test_sales_in_several_files(spark, tmp_path):
    header, line = sale(*NAMES), sale("7", "2001-01-01", *["x"] * 13)
    write(tmp_path / "a.txt", "\n".join([header, line]).encode())
    write(tmp_path / "b.txt", "\n".join([line] * 50 + ["9 rows selected.", header, line]).encode())
    assert fw.read_sales(spark, f"{tmp_path}/*.txt").count() == 52
    write(tmp_path / "c.txt", header.replace("PRICE", "OTHER").encode())
    with pytest.raises(ValueError, match="different headers"):
        fw.read_sales(spark, f"{tmp_path}/*.txt")


def test_empty_sales_file_has_no_header(spark, tmp_path):
    with pytest.raises(ValueError):
        fw.read_sales(spark, write(tmp_path / "raw.txt", b"\n \n"))


def test_ingest_writes_typed_parquet(spark, tmp_path):
    raw = write(tmp_path / "raw.txt", assessment("2110010010001", "9").encode() + b"\n")
    ingest(spark, "assessments", raw, f"{tmp_path}/table")
    table = spark.read.parquet(f"{tmp_path}/table")
    assert dict(table.dtypes)["tmk"] == "bigint"
    assert rows(table, "tmk", "assessed_building_value") == [(2110010010001, 1000)]


def test_types_follow_from_all_values(spark):
    n = 500
    data = [(i, str(i), "" if i % 2 else str(-i), f"{i}.5" if i == n - 1 else str(i), "x" if i == n - 1 else "1",
             None, "", "true" if i % 2 else "false", "1e3", str(10**30), ".", "+7") for i in range(n)]
    names = ["id", "whole", "gaps", "late", "text", "nulls", "blank", "truth", "power", "big", "dot", "signed"]
    df = spark.createDataFrame(data, "id long, " + ", ".join(f"{c} string" for c in names[1:])).repartition(7)
    assert infer_types(df) == {
        "whole": "bigint", "gaps": "bigint", "late": "double", "text": "string", "nulls": "string", "blank": "string",
        "truth": "boolean", "power": "double", "big": "double", "dot": "string", "signed": "bigint",
    }
    assert set(infer_types(df.filter("false")).values()) == {"string"}
    assert infer_types(df.select("id")) == {}


def test_ingest_with_stated_types(spark, tmp_path):
    raw = write(tmp_path / "raw.txt", assessment("2110010010001", "9").encode() + b"\n")
    ingest(spark, "assessments", raw, f"{tmp_path}/table", types={"tmk": "bigint"})
    assert dict(spark.read.parquet(f"{tmp_path}/table").dtypes)["parcel_year"] == "string"
    with pytest.raises(ValueError):
        ingest(spark, "other", raw, f"{tmp_path}/table")


def test_names():
    assert normalise_name(" Price / Unit ") == "price_unit"
    assert normalise_name("A B/C\nD (x)") == "a_b_c_d_(x)"


def test_csv_reader(spark, tmp_path):
    text = (
        'Year ,State,B79AA,Note / Text,Day\n1990,Hawaii,12,"a ""q"", b",2001-01-01,extra\nx,,1.5,\n2000, Hawaii ,7,"",z\n'
    )
    write(tmp_path / "a.csv", text.encode())
    write(tmp_path / "b.csv", b"Year ,State,B79AA,Note / Text,Day\n2010,Maui,3,n,d\n")
    types = {"year": "bigint", "b79aa": "int", "absent": "int"}
    found = read_csv(spark, f"{tmp_path}/*.csv", ["year", "state", "b79aa", "note_text", "day", "absent"], types)
    assert found.dtypes[0] == ("year", "bigint")
    assert bag(found) == [
        (None, None, None, None, None),
        (1990, "Hawaii", 12, 'a "q", b', "2001-01-01"),
        (2000, " Hawaii ", 7, "", "z"),
        (2010, "Maui", 3, "n", "d"),
    ]
    assert read_csv(spark, f"{tmp_path}/b.csv").columns == ["year", "state", "b79aa", "note_text", "day"]


def test_csv_files_with_other_headers(spark, tmp_path):
    write(tmp_path / "a.csv", b"Year,Price / Unit,Note\n1990,7,x,extra\n1991\n")
    write(tmp_path / "b.csv", b"NOTE,year\ny,1992\n")
    write(tmp_path / "c.csv", b"Year,Price / Unit,Note\nbad,8,z\n")
    types = {"year": "bigint", "price_unit": "bigint"}
    found = read_csv(spark, f"{tmp_path}/*.csv", types=types, by_name=True)
    assert bag(found, "year", "price_unit", "note") == [
        (None, 8, "z"), (1990, 7, "x"), (1991, None, None), (1992, None, "y"),
    ]
    # Without by_name a file of another header is an error, not silently misread.
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, f"{tmp_path}/*.csv", types=types).collect()


def test_colliding_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="collide"):
        read_csv(spark, write(tmp_path / "a.csv", b"A B,a_b\n1,2\n"))


def test_csv_sink_keeps_order_and_text(spark, tmp_path):
    df = spark.createDataFrame([(3, " c "), (1, 'a,"q"'), (2, None), (4, "")], "k int, v string")
    write_csv(df.repartition(3), f"{tmp_path}/out", ["k"])
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["k,v", '1,"a,""q"""', "2,", "3, c ", '4,""']
    back = read_csv(spark, f"{tmp_path}/out", types={"k": "int"})
    assert bag(back) == bag(df)


def test_extracts_are_typed(spark, tmp_path):
    write(tmp_path / "cpi.csv", b"Year,Annual,HALF1\n1990,100.5,x\n1991,,y\n")
    assert bag(read_extract(spark, "cpi", f"{tmp_path}/cpi.csv")) == [(1990, 100.5), (1991, None)]


def test_ingest_writes_compressed_files(spark, tmp_path, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "LINES_OF_A_FILE", 300, raising=False)
    monkeypatch.setattr(queries, "scratch_folder", lambda spark: f"{tmp_path}/files")
    line = F.concat(F.lit("2110010010001"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("string"), 230, "0"))
    lines = spark.range(0, 1000, 1, 1).select(line.alias("value"))
    table = queries.ingested(queries.Inputs(spark, ""), "dwellings", lines)
    assert table.count() == 1000 and dict(table.dtypes)["tmk"] == "bigint"
    raw = list((tmp_path / "files/raw").glob("part-*"))
    assert len(raw) == 4 and all(p.name.endswith(".txt.gz") for p in raw)
    assert sum(p.stat().st_size for p in raw) < 1000 * 244 / 2
    parts = list((tmp_path / "files/table").glob("*.parquet"))
    assert parts and all(".zstd." in p.name for p in parts)


def test_types_of_values_that_lie_in_one_group(spark):
    """A value tells the type of its own column only, also beyond the columns that are looked at together."""
    odd = {"a": "+5", "b": "-0", "c": "007", "d": "9" * 18, "e": "9" * 19, "f": "9" * 18 + "9" * 18, "g": " 5", "h": "5\n",
           "i": "12", "j": "2001-01-01", "k": "1.", "l": "true", "m": "٣", "n": "-" + "9" * 18, "o": "1e5", "p": "5\n\n",
           "q": "+", "r": "TRUE", "s": "5 ", "t": str(2**63), "u": str(-(2**63))}
    rest = {"a": "1", "i": None, "j": "", "k": "", "l": "false"}
    names = list(odd)
    lines = [tuple(odd.values())] + [tuple(rest.get(n, "3" if n in "bcd" else "") for n in names)] * 3
    df = spark.createDataFrame(lines, ", ".join(f"{n} string" for n in names)).repartition(3)
    whole = dict.fromkeys("abcdhinu", "bigint")
    number = dict.fromkeys("efkot", "double")
    assert infer_types(df) == {**dict.fromkeys(names, "string"), **whole, **number, "l": "boolean"}


def longest_method(df) -> int:
    """Bytes of the longest method in the whole-stage code of a query."""
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max((stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())), default=0)


def small_lineitem(spark, tmp_path, n=2000):
    columns = ["pmod(xxhash64(id), 1000000000) AS l_orderkey", "id * 7 % 200 AS l_partkey", "CAST(id % 7 AS INT) AS l_linenumber"]
    spark.range(0, n, 1, 1).selectExpr(*columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_no_method_of_a_dwelling_ingest_is_too_long_to_be_compiled(spark, tmp_path):
    from checks import queries, raw_lines

    lines = raw_lines.dwelling_lines(queries.Inputs(spark, small_lineitem(spark, tmp_path)))
    assert longest_method(lines) < 8000
    assert lines.count() == 2000


def test_columns_of_digits_share_a_pattern(spark):
    from parcelstats.sources import csv

    df = spark.range(10).selectExpr(*[f"CAST(id + {k} AS STRING) AS c{k}" for k in range(6)])
    assert infer_types(df) == dict.fromkeys(df.columns, "bigint")
    # All columns at once; patterns for a single value come after that.
    assert plan(csv._verdicts(df, df.columns)).count("RLIKE(concat_ws(, c0") == 1


def test_dwelling_lines_are_coded_by_frequency(spark, tmp_path, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "scratch_folder", lambda spark: f"{tmp_path}/files")
    table = queries.QUERIES["ingest_dwellings"](spark, small_lineitem(spark, tmp_path))
    assert table.count() == 2000 and dict(table.dtypes)["building_grade"] == "string"
    raw = sum(p.stat().st_size for p in (tmp_path / "files/raw").glob("part-*.txt.gz"))
    length = spark.read.text(f"{tmp_path}/files/raw").selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert raw < 0.46 * length
