"""Quoted, multi-line files read in several splits equal the whole-file read."""

import os
import random

import numpy as np
import pytest

from sunlight.plans import prescriptions_raw
from sunlight.sources import read_csv_union, read_text_csv, read_tolerant_tsv
from sunlight.sources import records as R


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1200", "spark.sql.files.openCostInBytes": "1"}
    saved = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def field(rng, sep):
    kind = rng.randint(0, 9)
    word = lambda: "".join(rng.choice("abé\\ ") for _ in range(rng.randint(1, 9)))
    if kind < 4:
        return word().strip() or "x"
    if kind == 4:
        return ""
    parts = [word(), '""', "\n", sep, "\n\n", '""""', " \n"]
    return '"' + "".join(rng.choice(parts) for _ in range(rng.randint(0, 30 if kind == 9 else 5))) + '"'


def made(rng, n, width, sep, ends="\n", ragged=0.0):
    rows = []
    for _ in range(n):
        w = width + (rng.choice([-1, 1, 2]) if rng.random() < ragged else 0)
        fields = [field(rng, sep) for _ in range(w)]
        fields[0] = fields[0] or "k"
        rows.append(sep.join(fields))
    return "".join(r + ends for r in rows)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tasks_with_rows(df):
    return sum(1 for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n)


@pytest.mark.parametrize("seed, sep, ends, encoding", [(1, ";", "\n", "UTF-8"), (2, ",", "\n", "ISO-8859-1"), (3, "\t", "\n", "UTF-8")])
def test_split_read_equals_whole_read(spark, small_splits, tmp_path, seed, sep, ends, encoding):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        head = sep.join(f"C{i}" for i in range(4)) + ends
        (tmp_path / name).write_bytes((head + made(rng, 110, 4, sep, ends, ragged=0.1)).encode(encoding))
    whole = read_csv_union(spark, str(tmp_path), sep=sep, encoding=encoding)
    split = read_csv_union(spark, str(tmp_path), sep=sep, encoding=encoding, whole_file_bytes=0)
    assert rows_of(split.rows) == rows_of(whole.rows)
    assert len(rows_of(split.rows)) > 150
    assert rows_of(split.rejected.select("record")) == rows_of(whole.rejected.select("record"))
    assert {os.path.basename(r["file"]) for r in split.rejected.collect()} == {"a.csv", "b.csv"}
    assert split.rows.count() == whole.rows.count()
    assert split.rows.select("c2").count() == whole.rows.count()
    assert tasks_with_rows(split.rows) > 4


def test_one_record_longer_than_several_splits(spark, small_splits, tmp_path):
    long = "\n".join(f'line {i}, ""quoted""; and more' for i in range(400))
    p = tmp_path / "x.csv"
    p.write_text(f'id;note\n1;"{long}"\n2;plain\n3;"{long}"\n\n4;"two\nlines"')
    got = dict(rows_of(read_text_csv(spark, str(p), sep=";", whole_file_bytes=0)))
    text = long.replace('""', '"')
    assert got == {"1": text, "2": "plain", "3": text, "4": "two\nlines"}
    assert rows_of(read_text_csv(spark, str(p), sep=";")) == rows_of(read_text_csv(spark, str(p), sep=";", whole_file_bytes=0))


def test_quotes_inside_plain_fields_open_nothing(spark, small_splits, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("id;note\n" + "".join(f'{i};5" pipe and 6" pipe{" x" * (i % 40)}\n{i};"a"b"c\n{i};x"\n' for i in range(60)))
    whole, split = (rows_of(read_text_csv(spark, str(p), sep=";", whole_file_bytes=n)) for n in (1 << 30, 0))
    assert split == whole and len(split) == 180


def test_windows_line_ends(spark, small_splits, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes(("a;b\r\n" + "".join(f'{i};"q {i}"\r\n{i};plain\r\n' for i in range(100)) + "\r\n").encode())
    got = rows_of(read_text_csv(spark, str(p), sep=";", whole_file_bytes=0))
    assert got == sorted([(str(i), f"q {i}") for i in range(100)] + [(str(i), "plain") for i in range(100)])


def test_unclosed_quote_at_the_end_is_one_record(spark, small_splits, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("id;note\n" + "".join(f"{i};n\n" for i in range(300)) + '9999;"never closed\nmore;x\nend')
    read = read_csv_union(spark, str(p), sep=";", whole_file_bytes=0)
    assert read.rows.count() + read.rejected.count() == 301


def test_tolerant_tsv_in_splits(spark, small_splits, tmp_path):
    p = tmp_path / "c.txt"
    p.write_bytes(("k\tv\tw\n" + made(random.Random(9), 200, 3, "\t", ragged=0.2)).encode("latin-1"))
    columns = {0: "k", 2: "w"}
    whole, split = (read_tolerant_tsv(spark, str(p), columns, whole_file_bytes=n) for n in (1 << 30, 0))
    assert rows_of(split) == rows_of(whole)
    assert split.count() > 100


def test_loader_passes_options_through(spark, small_splits, tmp_path):
    (tmp_path / "y.csv").write_text("A;B\n" + "".join(f'{i};"x\n{i}"\n' for i in range(80)))
    broken = "b like '%\n%'"
    assert prescriptions_raw(spark, str(tmp_path), whole_file_bytes=0).where(broken).count() == 80
    assert prescriptions_raw(spark, str(tmp_path), multi_line=False).where(broken).count() == 0
    from sunlight.sources import list_files
    (f,) = list_files(spark, str(tmp_path))
    assert prescriptions_raw(spark, str(tmp_path), headers={f: ["A", "B"]}).columns == ["a", "b"]


def test_states_equal_one_line_after_the_other():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.random(40) < 0.4, rng.random(40) < 0.7
        for before in (False, True):
            want, now = [], before
            for x, y in zip(a, b):
                now = bool(y if now else x)
                want.append(now)
            assert R.states(a, b, before).tolist() == want


def test_changed_splits_are_refused():
    with pytest.raises(RuntimeError, match="splits"):
        R._Cutter({1: (False, True)}, True, False)._start(2)
