import csv
import random

import pytest

from saleskeep.contract import SOURCE_COLUMNS
from saleskeep.sources import sales, split_csv
from saleskeep.sources.split_csv import UnclosedQuoteError, read_split_csv

HEADER = ",".join(SOURCE_COLUMNS)
PLAIN = ["", "a", " b ", 'pipe 5" wide', "ñandú", "\t", "it's"]
QUOTED = ['""', '"x"', '"a,b"', '"he said ""no"""', '"two\nlines"', '"\n\n"', '","', '""""',
          '"""\n"""', '"a\nb\nc\nd ""e""\n"', '"end\n,\n"', '",,,,,,\n1,2,3,4,5,6,7\n"']


@pytest.fixture
def split_read(spark, workspace, monkeypatch):
    """Read with files cut every `size` bytes, as large ones are every few megabytes."""
    limits = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": 1}
    keep = workspace.keep

    def keep_with_limits(df, name):
        for limit, value in limits.items():
            if name == "lines":
                spark.conf.set(limit, value)
        try:
            return keep(df, name)
        finally:
            for limit in limits:
                spark.conf.unset(limit)

    monkeypatch.setattr(workspace, "keep", keep_with_limits)

    def read(path, size=1_000_000):
        limits["spark.sql.files.maxPartitionBytes"] = size
        return read_split_csv(spark, str(path), workspace)

    return read


def some_file(seed, records, share, end):
    draw = random.Random(seed)
    rows = [HEADER]
    for n in range(records):
        cells = [draw.choice(QUOTED if draw.random() < share else PLAIN) for _ in SOURCE_COLUMNS]
        rows.append(",".join([str(n), *cells[1:]]))
        rows.extend([""] * (draw.random() < 0.1))
    return end.join(rows) + end * draw.randrange(2)


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("share", [0.1, 0.9])
@pytest.mark.parametrize("size", [70, 400])
def test_split_files_read_like_whole_ones(spark, split_read, tmp_path, size, share, end):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(3):
        text = some_file(part, 25, share, end)
        (folder / f"{part}.csv").write_bytes(text.encode())
    whole = rows_of(sales.read_csv(spark, str(folder)))
    assert len(whole) == 75
    found = split_read(folder, size)
    assert rows_of(found) == whole
    # Filters are pushed towards the scan, but never parse a part of a record.
    assert rows_of(found.filter("cantidad = 'a'")) == [row for row in whole if row[5] == "a"]


def test_a_file_is_read_by_many_tasks(split_read, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(some_file(1, 200, 0.2, "\n"))
    assert split_read(path, 500).count() == 200
    lines = next((tmp_path / next(tmp_path.glob("saleskeep-*")).name).glob("lines-*"))
    assert len(list(lines.glob("part-*"))) > 4


@pytest.mark.parametrize("bad", ["1,2026-08-01,p", "1,2026-08-01,p,c,r,1,2,extra", '1,2,"a\nb"'])
def test_records_of_another_width_fail(split_read, tmp_path, bad):
    path = tmp_path / "x.csv"
    path.write_text(f"{HEADER}\n{bad}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        split_read(path).collect()


@pytest.mark.parametrize("size", [30, 1_000_000])
def test_an_open_quote_at_the_end_fails(spark, split_read, tmp_path, size):
    path = tmp_path / "x.csv"
    path.write_text(f'{HEADER}\n1,2,"p,c,r,1,2\n' + "2,2,p,c,r,1,2\n" * 20)
    with pytest.raises(UnclosedQuoteError, match="x.csv"):
        split_read(path, size)


@pytest.mark.parametrize("text", ["", "\n", HEADER, HEADER + "\n", HEADER + "\n\n \n"])
def test_files_without_records(split_read, tmp_path, text):
    path = tmp_path / "x.csv"
    path.write_text(text)
    assert split_read(path).collect() == []


def test_a_record_over_many_blocks(split_read, tmp_path):
    path = tmp_path / "x.csv"
    long = "\n".join(f"line {n}, and more" for n in range(200))
    path.write_text(f'{HEADER}\n1,2,"{long}",c,r,1,2\n2,2,p,c,r,1,2\n')
    found = rows_of(split_read(path, 100))
    assert [row[2] for row in found] == [long, "p"]


def test_a_header_of_several_lines_and_repeated_headers(split_read, tmp_path):
    path = tmp_path / "x.csv"
    names = HEADER.replace("producto", '"producto\nor\nservice, any"')
    path.write_text(f"{names}\n1,2,p,c,r,1,2\n{HEADER}\n2,2,p,c,r,1,2\n")
    for size in (20, 1_000_000):
        assert [r[0] for r in rows_of(split_read(path, size))] == ["1", "2"]


@pytest.mark.parametrize("size", [60, 1_000_000])
def test_lines_are_put_in_order_by_parts_of_bounded_size(spark, split_read, workspace, tmp_path, monkeypatch, size):
    """And the rows that are shuffled for it name their part without the path of its file."""
    monkeypatch.setattr(split_csv, "PART_BITS", 2)
    kept, keep = {}, workspace.keep
    monkeypatch.setattr(workspace, "keep", lambda df, name: kept.setdefault(name, keep(df, name)))
    rows = [[f"{n}", "2026-01-02", f"a{n}" + "\nb" * (n % 9), 'c "d"', "e", "1", "2"] for n in range(60)]
    with open(tmp_path / "in.csv", "w", newline="") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator="\n")
        writer.writerows([SOURCE_COLUMNS, *rows])
    found = split_read(tmp_path / "in.csv", size).collect()
    assert sorted(map(list, found)) == sorted(rows)
    assert split_csv.FILE not in kept["records"].columns
    assert kept["records"].groupBy(split_csv.FIRST).count().agg({"count": "max"}).first()[0] == 4
