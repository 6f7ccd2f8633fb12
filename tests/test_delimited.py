"""Delimited files: headers, quotes, rejection, nulls and types."""

import io
import math

import pandas as pd
import pytest

from helpers import load, make_feed

AB = {"a": "A", "b": "B"}


def test_header_is_counted_in_non_blank_lines(spark, write):
    folder = write({"x.csv": "title\n\n  \t\na,b\n1,x\n\n2,y\n"})
    assert load(spark, folder, make_feed(AB, headerrownumber=2))[0] == [(1, "x"), (2, "y")]


def test_preamble_row_without_values_still_counts(spark, write):
    folder = write({"x.csv": ",\na,b\n1,x\n"})
    assert load(spark, folder, make_feed(AB, headerrownumber=2))[0] == [(1, "x")]


def test_header_beyond_the_first_split(spark, write, tiny_splits):
    title = "".join(f"title line number {i} of a long preamble\n" for i in range(8))
    body = "".join(f"{i},row {i}\n" for i in range(60))
    folder = write({"x.csv": title + "a,b\n" + body, "y.csv": title + "b,a\n" + "z,100\n,\nq,101\n"})
    rows, _, problems = load(spark, folder, make_feed(AB, headerrownumber=9))
    assert problems == {"x.csv": None, "y.csv": None}
    assert rows == [(i, f"row {i}") for i in range(60)] + [(100, "z"), (101, "q")]


def test_quotes(spark, write):
    text = 'a,b\n"1","say ""hi"", twice"\n2,\'x\'\n3,5" pipe\n4,"NA"\n5,""\n'
    rows, _, problems = load(spark, write({"x.csv": text}), make_feed(AB))
    assert problems == {"x.csv": None}
    assert rows == [(1, 'say "hi", twice'), (2, "'x'"), (3, '5" pipe'), (4, None), (5, None)]


def test_line_break_inside_quotes_is_read_record_by_record(spark, write):
    files = {"x.csv": 'a,b\n1,"two\nlines, ""quoted"""\n\n2,plain\n', "y.csv": "b,a\nz,3\n"}
    rows, types, problems = load(spark, write(files), make_feed(AB))
    assert problems == {"x.csv": None, "y.csv": None}
    assert rows == [(1, 'two\nlines, "quoted"'), (2, "plain"), (3, "z")]
    assert types["a"] == "bigint"


def test_quote_left_open_rejects_the_file(spark, write):
    files = {"bad.csv": 'a,b\n1,"never closed\n2,x\n', "good.csv": "a,b\n3,y\n"}
    rows, _, problems = load(spark, write(files), make_feed(AB))
    assert problems == {"bad.csv": "quote left open", "good.csv": None}
    assert rows == [(3, "y")]


def test_very_long_quoted_field(spark, write):
    long = 'x""y,' * 20000
    rows, _, _ = load(spark, write({"x.csv": f'a,b\n1,"{long}"\n'}), make_feed(AB))
    assert rows == [(1, long.replace('""', '"'))]


def test_rejection_reasons(spark, write):
    files = {
        "narrow_header.csv": "a\n1\n",
        "wide_header.csv": "a,b,c\n1,2,3\n",
        "wide_first.csv": "a,b\n1,2,3\n",
        "wide_later.csv": "a,b\n1,2\n1,2,3\n",
        "unknown.csv": "a,c\n1,2\n",
        "twice.csv": "a, a\n1,2\n",
        "short.csv": "title\n",
        "narrow_rows.csv": "b,a\nx,7\ny\n",
        "only_header.csv": "a,b\n",
    }
    rows, _, problems = load(spark, write(files), make_feed(AB))
    assert problems == {
        "narrow_header.csv": "column count differs from the mapping",
        "wide_header.csv": "column count differs from the mapping",
        "wide_first.csv": "row wider than the columns",
        "wide_later.csv": "row wider than the columns",
        "unknown.csv": "unknown header name",
        "twice.csv": "header name given twice",
        "short.csv": "column count differs from the mapping",
        "narrow_rows.csv": None,
        "only_header.csv": None,
    }
    assert rows == [(7, "x"), (None, "y")]


def test_missing_header_line(spark, write):
    assert load(spark, write({"x.csv": "a,b\n\n"}), make_feed(AB, headerrownumber=3))[2] == {"x.csv": "no header line"}


def test_blank_and_repeated_header_names(spark, write):
    mapping = {"a": "A", "a.1": "B", "Unnamed: 2": "C"}
    rows, types, _ = load(spark, write({"x.csv": "a,a,\n1,2,3\n"}), make_feed(mapping))
    assert dict(zip(types, rows[0])) == {"a": 1, "b": 2, "c": 3}


def test_ordinal_names_without_a_header(spark, write):
    feed = make_feed({"1": "B", "0": "A"}, headerrownumber=0)
    assert load(spark, write({"x.csv": "1,x\n"}), feed)[0] == [(1, "x")]


def test_positional_names_sort_by_key(spark, write):
    plain = {"hasheader": False, "headerrownumber": 0}
    numbers = {10: "C", 9: "B", 1: "A"}
    texts = {"10": "B", "9": "C", "1": "A"}
    folder = write({"x.csv": "1,2,3\n"})
    for mapping in (numbers, texts):
        rows, types, _ = load(spark, folder, make_feed(mapping, **plain))
        assert rows == [(1, 2, 3)] and list(types)[:3] == ["a", "b", "c"]


def test_dat_skips_one_raw_line_and_keeps_mapping_order(spark, write):
    files = {
        "acme.20240131_x.dat": "\n1|x\n \n2|y\n",
        "20231231.dat": "h|h|h|h\n3|z\n",
        "undated.dat": "h\n4|w\n",
        "wide.20240131.dat": "h\n1|2|3\n",
    }
    feed = make_feed({9: "ID", 1: "NAME"}, hasheader=False, headerrownumber=0, textdelimiter="|", fileextension="dat")
    rows, _, problems = load(spark, write(files), feed)
    assert rows == [(3, "z", "20231231"), (1, "x", "20240131"), (2, "y", "20240131")]
    assert problems["undated.dat"] == "no as-of date in the file name"
    assert problems["wide.20240131.dat"] == "column count differs from the mapping"


def test_unknown_columns_go_and_dates_stay_text(spark, write):
    mapping = {"a": "Trade_Date", "b": "is_UNKNOWable", "c": "update_flag", "d": "qty"}
    rows, types, _ = load(spark, write({"x.csv": "a,b,c,d\n01312021,q,true,1\n,q,7,\n"}), make_feed(mapping))
    assert list(types) == ["trade_date", "update_flag", "qty", "rownum"]
    assert rows == [("01312021", "true", 1), (None, "7", None)]


def test_rows_without_values_are_dropped(spark, write):
    folder = write({"x.csv": "a,b\n1,x\n,\nNA,null\n,#N/A\n NA ,\n2,y\n"})
    assert load(spark, folder, make_feed(AB))[0] == [("1", "x"), (" NA ", None), ("2", "y")]


@pytest.mark.parametrize("sep, shown", [("||", "||"), ("\t", "\t"), (";", " ; "), ("^", "^"), ("~|~", "~|~")])
def test_delimiters(spark, write, sep, shown):
    text = "\n".join(sep.join(cells) for cells in (["a", "b"], ["1", "x"], ["2", f'"q{sep}q"'])) + "\n"
    rows, _, _ = load(spark, write({"x.csv": text}), make_feed(AB, textdelimiter=shown))
    assert rows == [(1, "x"), (2, f"q{sep}q")]


def test_line_ends_and_byte_order_mark(spark, write):
    folder = write({"x.csv": "﻿a,b\r\n1,x\r\n2,y\r\n", "y.csv": "a,b\r3,z\r4,w"})
    assert load(spark, folder, make_feed(AB))[0] == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]


COLUMNS = {
    "ints": ["1", "-2", "+3", "007"],
    "ints_null": ["1", "", "3", "NA"],
    "spaced": [" 1", "2 ", " 3 ", "4"],
    "floats": ["1.5", ".5", "2.", "1e3"],
    "mixed": ["1", "2.5", "NaN", "-1E-2"],
    "infinite": ["inf", "-Infinity", "1", "+INF"],
    "bools": ["True", "FALSE", "true", "False"],
    "bools_null": ["True", "", "null", "false"],
    "bool_casings": ["True", "tRUE", "true", "falSE"],
    "not_bools": ["True", "tru", " true", "false"],
    "bool_int": ["True", "1", "0", "false"],
    "text": ["a", " b ", "NA", "1"],
    "suffixed": ["1d", "2f", "3", "4"],
    "big": ["9223372036854775807", "1", "-9223372036854775808", "2"],
    "tokens": ["NA", "n/a", "#N/A N/A", "-1.#IND"],
    "cases": ["Na", "NULL", "Null", "none"],
    "hex": ["0x10", "1", "2", "3"],
    "grouped": ["1_000", "2", "3", "4"],
}


def test_types_and_values_as_a_data_frame_reader_gives_them(spark, write):
    names = list(COLUMNS)
    text = ",".join(names) + "\n" + "".join(",".join(COLUMNS[n][i] for n in names) + "\n" for i in range(4))
    rows, types, _ = load(spark, write({"x.csv": text}), make_feed({n: n for n in names}))
    want = pd.read_csv(io.StringIO(text))
    kinds = {"i": "bigint", "f": "double", "b": "boolean", "O": "string"}
    for name in names:
        got = [row[list(types).index(name)] for row in rows]
        kind = kinds[want[name].dtype.kind]
        if name == "ints_null":
            kind = "bigint"  # integers stay integers beside a missing value
        if name == "bools_null":
            kind = "boolean"
        assert types[name] == kind, name
        for a, b in zip(got, want[name].tolist()):
            assert (a is None and isinstance(b, float) and math.isnan(b)) or a == b, (name, got)


def test_integers_beyond_64_bits_stay_text(spark, write):
    rows, types, _ = load(spark, write({"x.csv": "a,b\n9223372036854775808,1\n1,9223372036854775808.5\n"}), make_feed(AB))
    assert types["a"] == "string" and types["b"] == "double"
    assert rows[0][0] == "9223372036854775808"


def test_one_type_over_all_files(spark, write):
    files = {"x.csv": "a,b\n1,1\n2,2\n", "y.csv": "a,b\nx,2.5\n"}
    rows, types, _ = load(spark, write(files), make_feed(AB))
    assert (types["a"], types["b"]) == ("string", "double")
    assert rows == [("1", 1.0), ("2", 2.0), ("x", 2.5)]


def test_rejected_files_do_not_decide_types(spark, write):
    files = {"x.csv": "a,b\n1,1\n", "y.csv": "a,b\nx,x,x\n"}
    assert load(spark, write(files), make_feed(AB))[1]["a"] == "bigint"
