import csv
import gzip

import pytest
from pyspark.errors import PySparkException

from burstline.sources.csv_rows import ROW_KEY, header_columns, read_csv_rows
from burstline.sources.quarantine import LABEL, SHORT, UNCLOSED, split_rows

HEADER = ["Time", "V1", "Amount", "Class"]
LINES = [
    "Time,V1,Amount,Class",
    "0,1.5,10.0,0",
    '1,2.5,20.0,"0"',
    "2,3.5",
    "3,3.5,30.0,",
    "4,4.5,40.0,1,surplus,more",
    "5,bad,50.0,0",
    "6,5.5,,0",
    "",
    '7,"6,5",60.0,1',
    '8,"say ""hi"", you",70.0,0',
    '9,"a,b"',
    ",,,",
    "10,7.5,80.0,abc",
    '11,"x,y",1,0,"p,q"',
]


def kept_by_python(path):
    with open(path, encoding="utf-8") as lines:
        rows = csv.reader(lines)
        headers = next(rows)
        return [row[: len(headers)] for row in rows if len(row) >= len(headers)]


def test_rows_match_python_csv(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    assert header_columns(spark, str(path)) == HEADER
    rows = read_csv_rows(spark, str(path)).collect()
    actual = [["" if row[c] is None else row[c] for c in HEADER] for row in rows]
    assert sorted(actual) == sorted(kept_by_python(path))
    assert len({row[ROW_KEY] for row in rows}) == len(rows)


def test_row_verdict_does_not_depend_on_the_columns_read(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    rows = read_csv_rows(spark, str(path))
    assert rows.select("Amount").count() == rows.count() == len(kept_by_python(path))


def test_each_file_has_its_own_header(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("Time,Class\n1,0\n2,1\n", encoding="utf-8")
    rows = read_csv_rows(spark, str(tmp_path)).collect()
    assert sorted(row.Time for row in rows) == ["1", "1", "2", "2"]
    assert len({row[ROW_KEY] for row in rows}) == 4


def test_quoted_line_breaks_with_multi_line(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('Time,Note\n1,"two\nlines"\n2,x\n', encoding="utf-8")
    rows = read_csv_rows(spark, str(path), multi_line=True).collect()
    assert sorted(row.Note for row in rows) == ["two\nlines", "x"]


def test_unclosed_quotes_fail_without_multi_line(spark, tmp_path):
    for k, text in enumerate(['Time,Note,V1\n1,"two\nlines",3\n', 'Time,Note\n1,"two\nlines"\n']):
        path = tmp_path / f"{k}.csv"
        path.write_text(text, encoding="utf-8")
        for action in ("collect", "count"):
            with pytest.raises(PySparkException, match="unclosed quote"):
                getattr(read_csv_rows(spark, str(path)), action)()
    path.write_text('Time,Note\n1,5" pipe\n2,"a ""b"", c"\n,\n', encoding="utf-8")
    assert read_csv_rows(spark, str(path)).count() == 3


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Time,Amount,Class\n1,10,0\n2,20\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('\nClass,"Amount",Time\n0,99,2\n1,5\n', encoding="utf-8")
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    (tmp_path / "sub folder").mkdir()
    with gzip.open(tmp_path / "sub folder" / "c.csv.gz", "wt") as file:
        file.write("V1,Time\r\n7,3\r\n")
    names = ["Time", "Amount", "Class", "V1"]
    assert header_columns(spark, str(tmp_path)) == names
    rows = read_csv_rows(spark, str(tmp_path)).collect()
    assert sorted(tuple(r[n] for n in names) for r in rows) == [
        ("1", "10", "0", None), ("2", "99", "0", None), ("3", None, None, "7"),
    ]
    assert len({r[ROW_KEY] for r in rows}) == 3
    wanted = ["V1", "Class", "Time", "Amount", "Note"]
    assert read_csv_rows(spark, str(tmp_path), wanted).columns == [*wanted, ROW_KEY]
    with pytest.raises(ValueError, match="c.csv.gz has unknown columns: V1"):
        read_csv_rows(spark, str(tmp_path), names[:3])
    (tmp_path / "d.csv").write_text("Time,Time\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="twice"):
        read_csv_rows(spark, str(tmp_path))


def test_no_files_with_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("\n", encoding="utf-8")
    assert read_csv_rows(spark, str(tmp_path), ["Time"]).collect() == []
    with pytest.raises(ValueError, match="header"):
        split_rows(spark, str(tmp_path), str(tmp_path / "out"))


def test_kept_and_refused_lines_are_all_lines(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [*LINES, "Time,V1,Amount,Class", "13,1,2, 1 ", '12,"open,1,2']
    (source / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (source / "b.csv").write_text("Class,Time\nno,1\n1,2\n3\n", encoding="utf-8")
    split = split_rows(spark, str(source), str(tmp_path / "out"))
    refused = sorted((r.raw_line, r.reason, r.file.rsplit("/", 1)[1]) for r in split.refused.collect())
    assert refused == sorted([
        ("2,3.5", SHORT, "a.csv"), ('9,"a,b"', SHORT, "a.csv"), ('12,"open,1,2', UNCLOSED, "a.csv"),
        ("10,7.5,80.0,abc", LABEL, "a.csv"), ("Time,V1,Amount,Class", LABEL, "a.csv"),
        ("no,1", LABEL, "b.csv"), ("3", SHORT, "b.csv"),
    ])
    kept = split.kept.collect()
    good = [r for r in kept_by_python(source / "a.csv") if r[3] != "abc"]
    good = [r for r in good if r[0] not in ("Time", "12")] + [["2", "", "", "1"]]
    assert sorted([r[c] or "" for c in HEADER] for r in kept) == sorted(good)
    blank = 1
    assert split.n_lines == len(lines) - 1 - blank + 3
    assert (split.n_kept, split.n_refused) == (len(kept), len(refused))
    assert split.n_kept + split.n_refused == split.n_lines
    assert len({r[ROW_KEY] for r in kept}) == len(kept)
    with pytest.raises(PySparkException, match="(?i)exists"):
        split_rows(spark, str(source), str(tmp_path / "out"))
