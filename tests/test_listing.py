"""Folders as they are: files without bytes, hidden names, odd names, and many files."""

from pathlib import Path

from catalog.render import write_files
from tidegate.sources.listing import list_files


def listed(spark, *folders):
    rows = list_files(spark, list(folders)).collect()
    return sorted((row["key"].rsplit("/", 1)[1], row["file_size"], row["readable"], row["modified"] is not None) for row in rows)


def test_files_spark_does_not_read_are_listed(spark, write):
    files = {"a 1.csv": "x", "ü+%20.csv": "xy", "none.csv": "", "_h.csv": "q", "_none.csv": "", ".d": "q", "c._COPYING_": "z", "_a=b.csv": "1"}
    folder = write(files, "G[1] {x}*?")
    Path(folder, "sub").mkdir()
    Path(folder, "sub", "deep.csv").write_text("x")
    Path(folder, "_folder").mkdir()
    hidden = {"_h.csv", "_none.csv", ".d", "c._COPYING_"}
    want = sorted((name, len(text.encode()), name not in hidden, True) for name, text in files.items())
    assert [row for row in listed(spark, folder) if not row[0].endswith(".crc")] == want
    keys = {row["key"]: row["file_path"] for row in list_files(spark, [folder]).collect()}
    assert all("%20" not in key or "ü" in key for key in keys)


def test_empty_and_missing_folders(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert listed(spark, str(tmp_path / "empty"), str(tmp_path / "missing")) == []
    assert listed(spark) == []


def test_no_call_per_object(spark, tmp_path, monkeypatch):
    """100,000 files, of which some are hidden or empty, cost a bounded number of calls into the JVM."""
    folders = [tmp_path / f"f{i}" for i in range(4)]
    for folder in folders:
        folder.mkdir()
        for i in range(25_000):
            (folder / f"{i}.csv").write_bytes(b"x")
    (folders[0] / "none.csv").write_bytes(b"")
    (folders[1] / "_h.csv").write_bytes(b"x")
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *args, **options: calls.append(1) or send(*args, **options))
    found = list_files(spark, [str(folder) for folder in folders])
    assert found.count() == 100_002
    assert len(calls) < 3000


def test_no_call_per_file_that_spark_does_not_read(spark, tmp_path, monkeypatch):
    """3,000 empty and 3,000 hidden files cost a bounded number of calls into the JVM."""
    for i in range(3000):
        (tmp_path / f"é {i}\n.csv").write_bytes(b"")
        (tmp_path / f"_{i}%20.csv").write_bytes(b"x")
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *args, **options: calls.append(1) or send(*args, **options))
    found = listed(spark, str(tmp_path))
    assert len(calls) < 3000
    want = [(f"é {i}\n.csv", 0, True, True) for i in range(3000)] + [(f"_{i}%20.csv", 1, False, True) for i in range(3000)]
    assert found == sorted(want)


def test_files_of_rows_are_made_by_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, "a b", "_" if i % 2 else "", "" if i % 3 else f"{i}|ü\n") for i in range(2000)]
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    files = spark.createDataFrame(rows + rows[:10], "number int, segment string, mark string, content string")
    monkeypatch.setattr(client, "send_command", lambda *args, **options: calls.append(1) or send(*args, **options))
    write_files(files, f"{tmp_path}/x%20 y")
    assert len(calls) < 1000
    made = {path.name: path.read_text() for path in (tmp_path / "x%20 y" / "a b").iterdir() if not path.name.endswith(".crc")}
    assert made == {f"{mark}c {number}.csv": content for number, _, mark, content in rows}
