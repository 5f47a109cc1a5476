import csv
import io
import random

import pytest

from wardlight.sources.quoted import read_quoted_csv, records


def made(rnd, n):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"]))
    rows = [["".join(rnd.choice('ab,"\né\r ') for _ in range(rnd.randrange(8))) or "x" for _ in range(3)] for _ in range(n)]
    writer.writerows(rows)
    return out.getvalue().encode(), rows


def test_ranges_give_every_record_once():
    rnd = random.Random(6)
    for _ in range(150):
        data, rows = made(rnd, rnd.randrange(1, 12))
        want = list(csv.reader(io.StringIO(data.decode(), newline="")))
        size, got = rnd.randrange(1, 30), []
        for start in range(0, len(data), size):
            inside = bool(data[:start].count(b'"') & 1)
            got += records(io.BytesIO(data), start, min(start + size, len(data)), inside)
        assert got == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(str(i), "".join(rnd.choice('ab,"\né ') for _ in range(rnd.randrange(60))), "z" * (i % 3)) for i in range(3000)]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([("id", "text", "odd name`s"), *rows])
    with open(tmp_path / "b.csv", "w", newline="", encoding="utf-8") as f:
        f.write('﻿text,more,id\r\n"q ""w""\r\nx",1,b1\r\n\r\nshort\r\n,,,,\r\n')
    df = read_quoted_csv(spark, str(tmp_path), 1000)
    assert df.columns == ["id", "text", "odd name`s", "more"] and df.rdd.getNumPartitions() > 50
    got = {r["id"]: tuple(r)[1:] for r in df.filter("id is not null and id <> '' and id <> 'b1'").collect()}
    assert got == {i: (t, z, None) for i, t, z in rows}
    rest = sorted((tuple(r) for r in df.filter("id is null or id = '' or id = 'b1'").collect()), key=str)
    assert rest == [("", "", None, ""), ("b1", 'q "w"\r\nx', None, "1"), (None, "short", None, None)]
    empty = tmp_path / "c"
    empty.mkdir()
    (empty / "only.csv").write_text("id,text\n")
    assert read_quoted_csv(spark, str(empty)).count() == 0


def test_files_whose_quotes_tell_nothing_are_refused(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('a,b\n1,5" pipe\n2,x\n')
    with pytest.raises(ValueError, match="multi_line"):
        read_quoted_csv(spark, str(tmp_path / "odd.csv"))
    (tmp_path / "stray.csv").write_text('a,b\n1,x"y"z\n2,x\n')
    with pytest.raises(Exception, match="not quoted"):
        read_quoted_csv(spark, str(tmp_path / "stray.csv")).count()
    with pytest.raises(ValueError):
        read_quoted_csv(spark, str(tmp_path / "nothing*"))
