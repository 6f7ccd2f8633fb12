"""Fixed-width files."""

import io

import pandas as pd

from helpers import load, make_feed
from tidegate.sources.fixed_width import field_specs, slice_bounds


def spec(start, end, name):
    return {"start_pos": start, "end_pos": end, "field_mapped_to": name}


def fixed(*specs, **changes):
    return make_feed(specs=specs, textdelimiter="FixedWidth", hasheader=False, headerrownumber=0, **changes)


def test_same_as_a_fixed_width_reader(spark, write):
    specs = [spec(0, 4, "Code"), spec(4, 10, "qty"), spec(10, 18, "day"), spec(18, 40, "note")]
    text = (
        "AB    1.502021013 hello  \n"
        "CD\n"
        "\n"
        "                          \n"
        'E"F   NA \t20210131"q" x\n'
        "GH  -3    20210131\n"
    )
    rows, types, _ = load(spark, write({"x.txt": text}), fixed(*specs))
    want = pd.read_fwf(
        io.StringIO(text), colspecs=[(s["start_pos"], s["end_pos"]) for s in specs],
        names=[s["field_mapped_to"] for s in specs], header=None,
    ).dropna(how="all")
    assert types["qty"] == "double" and types["day"] == "bigint" and "Code" in types
    assert len(rows) == len(want)
    for got, expected in zip(rows, want.itertuples(index=False)):
        for a, b in zip(got, expected):
            assert (a is None and b != b) or a == b


def test_skips_raw_lines(spark, write):
    folder = write({"x.txt": "\nheader\nAB1\nCD2\n", "y.txt": "h\n\nEF3\n"})
    feed = fixed(spec(0, 2, "code"), spec(2, 3, "n"), datastartingrownumber=3)
    assert load(spark, folder, feed)[0] == [("AB", 1), ("CD", 2), ("EF", 3)]


def test_position_before_the_line_is_null(spark, write):
    feed = fixed(spec(-1, 3, "before"), spec(0, 2, "code"))
    assert load(spark, write({"x.txt": "ABC\n"}), feed)[0] == [(None, "AB")]


def test_bounds_and_order(spark):
    mapping = spark.createDataFrame(
        [(3, 1, 2, 4, "a"), (1, 1, 6, 2, "b"), (2, 2, 1, 5, "c")],
        "fixedwidth_field_mapping_id int, client_file_config_id int, starting_position int, length int, field_mapped_to string",
    )
    assert [(r["field_mapped_to"], r["start_pos"], r["end_pos"]) for r in field_specs(mapping, 1).collect()] == [
        ("b", 4, 6), ("a", 0, 4),
    ]
    assert slice_bounds(mapping, origin=1).filter("length = 5").first()["start_pos"] == 0


def test_across_splits(spark, write, tiny_splits):
    text = "skip me\n" + "".join(f"{i:5d}{'x' if i % 3 else ' '}\n" + ("      \n" if i % 7 == 0 else "") for i in range(300))
    rows, _, _ = load(spark, write({"x.txt": text}), fixed(spec(0, 5, "n"), spec(5, 6, "x"), datastartingrownumber=2))
    assert rows == [(i, "x" if i % 3 else None) for i in range(300)]


def test_file_without_data_is_rejected(spark, write):
    feed = fixed(spec(0, 2, "code"), datastartingrownumber=2)
    assert load(spark, write({"x.txt": "only a header\n"}), feed)[2] == {"x.txt": "empty file"}


def test_booleans_have_three_casings(spark, write):
    text = "True tRuE True\nFALSEtrue \n"
    rows, types, _ = load(spark, write({"x.txt": text}), fixed(spec(0, 5, "a"), spec(5, 10, "b"), spec(10, 15, "c")))
    assert rows == [(True, "tRuE", True), (False, "true", None)]
    assert (types["a"], types["b"], types["c"]) == ("boolean", "string", "boolean")
