"""First lines of files, and profiles made from them."""

from pyspark.sql import functions as F

from helpers import ROW, make_feed
from tidegate.plans import stage
from tidegate.plans.config import feed_of
from tidegate.plans.stage import profile_paths, row_offsets, typed_rows
from tidegate.sources import heads
from tidegate.sources.lines import read_lines

AB = {"a": "A", "b": "B"}


def sizes(spark, folder):
    return read_lines(spark, folder).groupBy("file_path").agg(F.max("file_size").alias("file_size"))


def staged(spark, folder, feed):
    """Rows with their file, problems, and types, as found with or without known first lines."""
    found = profile_paths(spark, feed, folder, None, sizes(spark, folder))
    problems = {row["file_path"].rsplit("/", 1)[1]: row["problem"] for row in found.files.collect()}
    frame = typed_rows(found, row_offsets(found))
    return sorted(frame.collect(), key=lambda row: row["rownum"]), problems, found.types


def both(spark, monkeypatch, folder, feed):
    want = staged(spark, folder, feed)
    monkeypatch.setattr(stage, "LARGE_FILE", 0)
    monkeypatch.setattr(stage, "count_blocks", None)  # lines are not counted
    got = staged(spark, folder, feed)
    monkeypatch.undo()
    assert got == want
    return got


FILES = {
    "a.csv": "Title\n \t\na,b\n1,x\n2,y\n" + "3,z\n" * 40,
    "b.csv": "Title\nb,a\n" + "".join(f"t{i},{i}\n" for i in range(30)),
    "repeats.csv": "Title\na,b\n7,x\na,b\nTitle\n8,y\n",
    "other.csv": "Another title, longer than a split of these is, to the end of it and on\n\n\n\na,b\n9,1\n",
    "short.csv": "Title\n",
    "unknown.csv": "Title\na,c\n1,2\n",
    "wide.csv": "Title\na,b\n1,2,3\n",
    "same.csv": "a,b\na,b\na,b\n5,q\n",
    "empty_rows.csv": ",\na,b\n,\n4,\n,\n",
}


def test_rows_are_those_of_counted_lines(spark, write, monkeypatch):
    rows, problems, types = both(spark, monkeypatch, write(FILES), make_feed(AB, headerrownumber=2))
    assert problems == {name: None for name in FILES} | {
        "short.csv": "no header line", "unknown.csv": "unknown header name", "wide.csv": "row wider than the columns"}
    assert types == ["string", "string"] and len(rows) == 42 + 30 + 4 + 1 + 2 + 1


def test_first_lines_in_several_splits(spark, write, monkeypatch, tiny_splits):
    both(spark, monkeypatch, write(FILES), make_feed(AB, headerrownumber=2))


def test_fixed_width_lines_above_the_data(spark, write, monkeypatch):
    specs = [{"start_pos": 0, "end_pos": 2, "field_mapped_to": "Code"}, {"start_pos": 2, "end_pos": 5, "field_mapped_to": "Qty"}]
    feed = feed_of(ROW | {"textdelimiter": "fixedwidth", "datastartingrownumber": 3}, specs)
    files = {"x.txt": "TITLE\n\nAB123\nCD 45\nTITLE\n", "y.txt": "TITLE\nAB  1\nAB  1\n\nAB  1\n", "z.txt": "TITLE\n"}
    rows, problems, _ = both(spark, monkeypatch, write(files), feed)
    assert [tuple(row)[:2] for row in rows] == [("AB", "123"), ("CD", "45"), ("TI", "TLE"), ("AB", "1"), ("AB", "1")]
    assert problems == {"x.txt": None, "y.txt": None, "z.txt": "empty file"}


def test_too_many_different_first_lines_are_not_named(spark, write, monkeypatch):
    monkeypatch.setattr(heads, "DISTINCT_HEADS", 2)
    folder = write({f"{i}.csv": f"Title {i}\na,b\n{i},x\n" for i in range(5)})
    monkeypatch.setattr(stage, "LARGE_FILE", 0)
    rows, problems, _ = staged(spark, folder, make_feed(AB, headerrownumber=2))
    assert [row["a"] for row in rows] == list(range(5)) and set(problems.values()) == {None}


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_heads_are_read_without_the_files(spark, tmp_path):
    """Bytes read from a file for its first lines. A task that stops is not always stopped at once by Spark,
    so the least of some attempts counts."""
    folder = tmp_path / "in"
    folder.mkdir()
    text = "title\na,b\n" + "".join(f"{i},some text of the row {i}\n" for i in range(700_000))
    (folder / "x.csv").write_text(text)
    spent = []
    for _ in range(4):
        before = bytes_read(spark)
        found = heads.first_lines(spark, str(folder), None, F.lit(True), 2)
        assert [row["value"] for row in found.orderBy("number").collect()] == ["title", "a,b"]
        spent.append(bytes_read(spark) - before)
    assert min(spent) < len(text) / 5
