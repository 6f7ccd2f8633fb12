from tidegate.plans.config import feed_of
from tidegate.plans.stage import profile_paths, row_offsets, typed_rows

ROW = {
    "clientfileconfigid": 1, "clientid": 7, "filetypeid": 2, "srcfilepath": "/", "filemask": "*",
    "columnstring": "{}", "hasheader": True, "headerrownumber": 1, "datastartingrownumber": 1,
    "textdelimiter": ",", "fileextension": "csv",
}


def make_feed(mapping=None, specs=(), **changes):
    text = {"columnstring": repr(mapping)} if mapping else {}
    return feed_of(ROW | text | changes, list(specs))


def load(spark, folder, feed):
    """Rows in row-number order, types by column, and problems by file name."""
    assert feed.problem is None, feed.problem
    found = profile_paths(spark, feed, folder)
    problems = {row["file_path"].rsplit("/", 1)[1]: row["problem"] for row in found.files.collect()}
    if not found.n_good:
        return [], {}, problems
    frame = typed_rows(found, row_offsets(found))
    rows = sorted(frame.collect(), key=lambda row: row["rownum"])
    assert [row["rownum"] for row in rows] == list(range(1, len(rows) + 1))
    names = [name for name in frame.columns if name != "rownum"]
    return [tuple(row[name] for name in names) for row in rows], dict(frame.dtypes), problems
