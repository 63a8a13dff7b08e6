"""Raw files split inside quoted cells, against Python's csv module on whole files."""

import csv
import io
import random

import pytest

from shiftlake.sources import raw_csv, records


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that records cross many of them."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def cell(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return '"' + rng.choice(["a\nb", "line\r\nbreak", "x|y", 'say ""hi""', "\n\n", '""', "|\n|", "tail \n" * 30]) + '"'
    if kind == 1:
        return rng.choice(['5" pipe', 'a"b"c', "NA", "", " pad ", 'end"'])
    if kind == 2:
        return '"closed"' + rng.choice(["", "rest", 'x"y'])
    return f"v{rng.randrange(1000)}"


def written(path, rng, rows, columns, eol="\n", last=True):
    lines = ["|".join(columns)] + ["|".join([str(k), *(cell(rng) for _ in columns[1:])]) for k in range(rows)]
    text = eol.join(lines) + (eol if last else "")
    path.write_bytes(text.encode())
    return text


def records_of(text):
    """Whole records by one walk over the whole text."""
    out, held = [], []
    for line in text.split("\n"):
        inside = records.ends_in_quotes(line, bool(held), "|", '"')
        held.append(line)
        if not inside:
            out.append("\n".join(held))
            held = []
    return [r for r in out + ["\n".join(held)] * bool(held) if r.strip()]


@pytest.mark.parametrize("size", [60, 150, 1000, 1 << 20])
def test_any_split_gives_the_same_records(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    texts = {f"f{k}.csv": written(tmp_path / f"f{k}.csv", rng, 25, ["id", "a", "b", "c"], "\r\n" if k == 1 else "\n", k != 2) for k in range(4)}
    (tmp_path / "f4.csv").write_text("")
    (tmp_path / "f5.csv").write_text("\n\nid|a|b|c\n1|2|3|4\n")
    texts["f5.csv"] = "id|a|b|c\n1|2|3|4\n"
    small_splits(size)
    found = records.catalogue(spark, [str(tmp_path / "f*.csv")], "|", '"', str(tmp_path / "cat"))
    assert found.multi_line and found.headers == ["id|a|b|c"] and found.n_files == 5
    assert size > 150 or found.n_splits > 12
    got = records.assembled(spark, [str(tmp_path / "f*.csv")], found, "|", '"').collect()
    by_file = {}
    for r in sorted(got, key=lambda r: (r.file, r.block, r.pos)):
        if r.record.strip():
            by_file.setdefault(r.file.split("/")[-1], []).append(r.record)
    assert by_file == {name: records_of(text)[1:] for name, text in texts.items()}


def test_cells_equal_the_one_task_read(spark, tmp_path, small_splits):
    """Well-formed cells: as Python's csv module and as Spark's own multi-line read see the whole file."""
    rng = random.Random(1)
    values = ["a\nb", "x|y", 'say "hi"', "\n\n", "plain", "v", "long\n" * 50, "z"]
    rows = [[str(k), *(rng.choice(values) for _ in range(3))] for k in range(200)]
    out = io.StringIO()
    csv.writer(out, delimiter="|", lineterminator="\n").writerows([["id", "a", "b", "c"], *rows])
    (tmp_path / "timesheet.csv").write_text(out.getvalue())
    one = spark.read.options(sep="|", quote='"', escape='"', header=True, multiLine=True).csv(str(tmp_path / "timesheet.csv"))
    want = sorted(tuple(x.strip() if x else x for x in r) for r in one.collect())
    small_splits(900)
    got = raw_csv.extract_timesheets(spark, str(tmp_path))
    assert got.columns == ["id", "a", "b", "c", "_ingest"]
    assert sorted(tuple(r)[:4] for r in got.collect()) == want == sorted(tuple(x.strip() for x in r) for r in rows)
    order = [r.id for r in got.orderBy("_ingest").collect()]
    assert order == [str(k) for k in range(200)]


def test_jobs_do_not_follow_the_number_of_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for k in range(n):
            (folder / f"timesheet_{k}.csv").write_text(f"id|a{k % 2}\n{k}|x\n")
        group = f"files-{n}"
        spark.sparkContext.setJobGroup(group, group)
        rows = raw_csv.extract_timesheets(spark, str(folder)).collect()
        assert len(rows) == n and all((r.a0 is None) == (int(r.id) % 2 == 1) for r in rows)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(40) == jobs(80)  # from 33 paths on Spark lists them by a job of its own


@pytest.mark.parametrize("broken_lines", [False, True])
def test_rejects(spark, tmp_path, broken_lines):
    """Text beyond the header is caught at any position; empty cells beyond it, and missing cells, aren't rejects."""
    last = '5|"q\nr"' if broken_lines else '5|"q|r"'
    good = ["1|a", "2", "3|b|", "4|c||||||||||||", last, '6|"x ""|"" y"', '7|""']
    bad = ["10|a|b", "11|a||||||||||lost", '12|"a|b"|"c"', '13|"a""b"|c', "14||| |x"]
    (tmp_path / "employee.csv").write_text("\n".join(["id|v", *good[:3], *bad, *good[3:]]) + "\n")
    wide = "\n".join(["id|v|w|x|y", "20|a|b|c|d", "21|a|b|c|d|e"])
    (tmp_path / "employee_2.csv").write_text(wide)
    with pytest.raises(Exception, match="employee files match"):
        raw_csv.extract_employees(spark, str(tmp_path))
    rows = raw_csv.extract_employees(spark, str(tmp_path), several="all", keep_rejects=True)
    assert sorted(r.record for r in raw_csv.rejected(rows).collect()) == sorted([*bad, "21|a|b|c|d|e"])
    kept = {r.id: (r.v, r.y) for r in raw_csv.accepted(rows).collect()}
    assert kept == {"1": ("a", None), "2": (None, None), "3": ("b", None), "4": ("c", None), "5": ("q\nr" if broken_lines else "q|r", None),
                    "6": ('x "|" y', None), "7": (None, None), "20": ("a", "d")}
    first = raw_csv.extract_employees(spark, str(tmp_path), several="first", keep_rejects=True)
    assert first.columns[:2] == ["id", "v"] and first.count() == len(good) + len(bad)
    with pytest.raises(Exception, match="more cells than the header"):
        raw_csv.extract_employees(spark, str(tmp_path), several="first").collect()


def test_header_names():
    assert raw_csv.header_names('﻿id||a|a|"b|c"|a') == ["id", "Unnamed: 1", "a", "a.1", "b|c", "a.2"]


def test_other_splits_fail(spark, tmp_path, small_splits):
    rng = random.Random(2)
    written(tmp_path / "f.csv", rng, 50, ["id", "a", "b"])
    small_splits(50)
    found = records.catalogue(spark, [str(tmp_path / "f.csv")], "|", '"', str(tmp_path / "cat"))
    small_splits(80)
    with pytest.raises(Exception, match="split otherwise"):
        records.assembled(spark, [str(tmp_path / "f.csv")], found, "|", '"').collect()
