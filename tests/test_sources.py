"""Reading delivered files, and the checks before reading."""

from __future__ import annotations

import pytest
from fixtures import FILES, write_files

from tallyroll.contracts import PRODUCTS, SALES, SOURCES, STORES
from tallyroll.errors import JOB_ERRORS, SourceError
from tallyroll.sources.delimited import inspect_text, read_source
from tallyroll.sources.preflight import check_sources

HEADER, ROW = FILES["Stores.csv"].splitlines()


def stores(spark, tmp_path, *lines: str, newline: str = "\n"):
    write_files(tmp_path, Stores=newline.join([HEADER, *lines]) + newline)
    return [tuple(row) for row in read_source(spark, str(tmp_path), STORES).collect()]


def test_summary_counts_rows_and_columns(spark, tmp_path):
    summary = check_sources(spark, write_files(tmp_path)).collect()
    assert [tuple(row) for row in summary] == [("Sales.csv", 1, 9), ("Products.csv", 1, 10), ("Stores.csv", 1, 5)]


@pytest.mark.parametrize(
    "replaced, message",
    [
        ({"Sales": FILES["Sales.csv"].replace("Currency Code", "Currency")}, "missing columns: Currency Code; unexpected columns: Currency"),
        ({"Stores": f"Country,StoreKey,State,Square Meters,Open Date\n{ROW}\n"}, "columns are in a different order"),
        ({"Stores": f"storekey,Country,State,Square Meters,Open Date\n{ROW}\n"}, "unexpected header"),
        ({"Sales": FILES["Sales.csv"].splitlines()[0] + "\n"}, "Sales.csv contains no data rows"),
        ({"Sales": b"\xff"}, "Sales.csv is not valid UTF-8"),
        ({"Sales": FILES["Sales.csv"].encode() + b"2,1,\xe9,,10,0,100,2,USD\n"}, "Sales.csv is not valid UTF-8"),
        ({"Sales": b""}, "could not read Sales.csv"),
        ({"Sales": b"\n\n"}, "could not read Sales.csv"),
        ({"Products": FILES["Products.csv"] + "1,2,3,4,5,6,7,8,9,10,11\n"}, "could not read Products.csv"),
    ],
)
def test_preflight_rejects(spark, tmp_path, replaced, message):
    with pytest.raises(SourceError, match=message):
        check_sources(spark, write_files(tmp_path, **replaced))


def test_preflight_reports_a_missing_file(spark, tmp_path):
    write_files(tmp_path)
    (tmp_path / "Stores.csv").unlink()
    with pytest.raises(SourceError, match="required file not found"):
        check_sources(spark, str(tmp_path))


def test_preflight_reports_the_first_bad_file(spark, tmp_path):
    with pytest.raises(SourceError, match="Sales.csv"):
        check_sources(spark, write_files(tmp_path, Sales=b"", Products=b"\xff"))


def test_text_is_kept_and_blanks_are_empty(spark, tmp_path):
    assert stores(spark, tmp_path, "01, a ,,\"\",NA") == [("01", " a ", "", "", "NA")]


def test_columns_are_found_by_name(spark, tmp_path):
    write_files(tmp_path, Stores="State,Extra,StoreKey,Open Date,Country,Square Meters\nS,x,7,1/1/2008,C,12\n")
    assert read_source(spark, str(tmp_path), STORES).first() == ("7", "C", "S", "12", "1/1/2008")


def test_a_missing_column_fails(spark, tmp_path):
    write_files(tmp_path, Stores="StoreKey,Country\n1,US\n")
    with pytest.raises(SourceError, match="missing columns: State, Square Meters, Open Date"):
        read_source(spark, str(tmp_path), STORES)


def test_short_rows_are_padded_and_long_rows_fail(spark, tmp_path):
    assert stores(spark, tmp_path, "1,US") == [("1", "US", "", "", "")]
    with pytest.raises(JOB_ERRORS, match="more fields than the header"):
        stores(spark, tmp_path, "1,US,X,5,1/1/2008", "2,US,X,5,1/1/2008,extra")


def test_quotes_and_line_breaks(spark, tmp_path):
    lines = ['1,"a ""quoted"", name","line one\nline two",5,1/1/2008', "2,plain,x,5,1/1/2008"]
    write_files(tmp_path, Stores="\n".join([HEADER, *lines]) + "\n")
    assert inspect_text(spark, str(tmp_path), STORES).multiline_files
    assert [tuple(row) for row in read_source(spark, str(tmp_path), STORES).collect()] == [
        ("1", 'a "quoted", name', "line one\nline two", "5", "1/1/2008"),
        ("2", "plain", "x", "5", "1/1/2008"),
    ]


def test_a_break_before_the_closing_quote_is_still_one_record(spark, tmp_path):
    """The tail of this record alone looks like a whole row."""
    write_files(tmp_path, Stores=f'{HEADER}\n1,US,X,5,"first\na,b,c,d,"\n')
    assert read_source(spark, str(tmp_path), STORES).first() == ("1", "US", "X", "5", "first\na,b,c,d,")


def test_a_long_row_with_a_line_break_fails(spark, tmp_path):
    with pytest.raises(JOB_ERRORS, match="more fields than the header"):
        stores(spark, tmp_path, '1,US,"X\nY",5,1/1/2008,extra')


def test_byte_order_mark_blank_lines_and_windows_line_ends(spark, tmp_path):
    write_files(tmp_path, Stores=b"\xef\xbb\xbf" + f"{HEADER}\r\n1,US,X,5,1/1/2008\r\n\r\n2,US,Y,6,1/1/2009\r\n".encode())
    assert len(read_source(spark, str(tmp_path), STORES).collect()) == 2
    assert check_sources(spark, str(tmp_path)).collect()[2].row_count == 2


def test_double_encoded_text_is_preserved(spark, tmp_path):
    text = "Franche-Comté".encode().decode("latin-1")
    assert stores(spark, tmp_path, f"1,France,{text},5,1/1/2008")[0][2] == text


def test_a_folder_of_part_files(spark, tmp_path):
    write_files(tmp_path)
    (tmp_path / "Stores.csv").unlink()
    folder = tmp_path / "Stores.csv"
    folder.mkdir()
    for part in range(3):
        (folder / f"part-{part}.csv").write_text(f"{HEADER}\n{part},US,X,5,1/1/2008\n")
    (folder / "_SUCCESS").write_text("")
    assert sorted(row.store_key for row in read_source(spark, str(tmp_path), STORES).collect()) == ["0", "1", "2"]
    (folder / "part-3.csv").write_text("Country,StoreKey,State,Square Meters,Open Date\nUS,3,X,5,1/1/2008\n")
    with pytest.raises(JOB_ERRORS, match="header does not conform"):
        read_source(spark, str(tmp_path), STORES).collect()


def test_only_files_with_multiline_records_are_read_whole(spark, tmp_path):
    folder = tmp_path / "the files" / "Stores.csv"
    folder.mkdir(parents=True)
    large = "".join(f"{key},US,X,5,1/1/2008\n" for key in range(1000, 21_000))
    for name, body in {
        "part a.csv": large,
        "part-b.csv": '1,US,5" lane,5,1/1/2008\n' + large,
        "part-c.csv": '2,"two\nlines",X,5,1/1/2008\n3,US,"a ""q"", b",5,1/1/2008\n',
    }.items():
        (folder / name).write_text(f"{HEADER}\n{body}")
    text = inspect_text(spark, str(folder.parent), STORES)
    assert [name.rpartition("/")[2] for name in text.multiline_files] == ["part-c.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        frame = read_source(spark, str(folder.parent), STORES, text)
        assert frame.rdd.getNumPartitions() >= 6
        found = {row.store_key: (row.country, row.state) for row in frame.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 20_003
    assert found["1"] == ("US", '5" lane') and found["2"] == ("two\nlines", "X") and found["3"] == ("US", 'a "q", b')


def test_a_repeated_header_name_fails(spark, tmp_path):
    write_files(tmp_path, Stores=f"{HEADER},Notes,Notes\n{ROW},a,b\n")
    with pytest.raises(SourceError, match="repeats"):
        read_source(spark, str(tmp_path), STORES)


def test_contract_shapes():
    assert [len(contract.columns) for contract in SOURCES] == [9, 10, 5]
    assert SALES.names[0] == "order_number" and PRODUCTS.headers[4] == "Unit Cost USD"
