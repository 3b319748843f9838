"""Malformed lines: each is counted, and none takes another record along."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from opinara.operators.cleaning import cleaning_report, clean_reviews
from opinara.roles import HOTEL_CSV
from opinara.sources.csv import CSV_RULES, read_hotel_csv, read_raw_hotel_csv
from opinara.sources.csv_records import BROKEN_QUOTE, WRONG_FIELDS, Dialect, read_records

HEADER = list(HOTEL_CSV.values())


def review(i, **over):
    values = {name: str(i) for name in HEADER} | {"Hotel_Name": f"h{i}", "Negative_Review": f"bad {i}", "Positive_Review": f"good {i}", "lat": "1.5", "lng": "2.5", "Average_Score": "8.1"}
    return [{**values, **over}[name] for name in HEADER]


def line(values):
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(values)
    return out.getvalue()


@pytest.fixture
def broken_file(tmp_path):
    rows = [line(HEADER)]
    rows += [line(review(i)) for i in range(5)]
    rows.append(line(review(5, Negative_Review="the first line\nand, a second\n\nand a last")))
    rows.append(line(review(6)))
    rows.append(line(review(7, Negative_Review="MARK")).replace("MARK", '"never closed'))
    rows.append(line(review(8, Negative_Review='he said "no", twice')))
    rows.append("h9,short line")
    rows.append(line([*review(10), "one", "more"]))
    rows.append(line(review(11, Positive_Review="two\nlines")))
    rows.append("")
    rows.append(line(review(12)))
    rows.append(line(review(13, Positive_Review="MARK")).replace("MARK", '"open to the end'))
    path = tmp_path / "reviews.csv"
    path.write_text("\n".join(rows) + "\n")
    return str(path)


SOUND = {0, 1, 2, 3, 4, 5, 6, 8, 11, 12}


@pytest.mark.parametrize("split", [None, 150, 331])
def test_broken_lines_are_counted_and_take_nothing_along(spark, broken_file, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        raw = read_raw_hotel_csv(spark, broken_file, line_breaks=True, escape='"').cache()
        report = {r.outcome: r.n for r in cleaning_report(raw, CSV_RULES).collect()}
        assert report == {"kept": len(SOUND), f"malformed: {BROKEN_QUOTE}": 2, f"malformed: {WRONG_FIELDS}": 2}
        kept = {r.entity: r for r in clean_reviews(raw, CSV_RULES).collect()}
        assert set(kept) == {f"h{i}" for i in SOUND}
        assert kept["h5"].neg_text == "the first line\nand, a second\n\nand a last"
        assert kept["h8"].neg_text == 'he said "no", twice' and kept["h11"].pos_text == "two\nlines"
        raw.unpersist()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_lines_alone_are_counted_by_sparks_reader(spark, broken_file):
    raw = read_raw_hotel_csv(spark, broken_file, escape='"')
    report = {r.outcome: r.n for r in cleaning_report(raw, CSV_RULES).collect()}
    assert report[f"malformed: {WRONG_FIELDS}"] >= 4  # the short and the long line, and what follows the line breaks
    kept = {r.entity for r in read_hotel_csv(spark, broken_file, escape='"').collect()}
    assert {f"h{i}" for i in SOUND - {5, 11}} <= kept
    assert "malformed" not in read_hotel_csv(spark, broken_file).columns


def test_a_sound_file_has_nothing_malformed(spark, tmp_path):
    path = tmp_path / "sound.csv"
    path.write_text("\n".join(map(line, [HEADER, *(review(i) for i in range(20))])))
    for breaks in (False, True):
        raw = read_raw_hotel_csv(spark, str(path), line_breaks=breaks)
        assert raw.where("malformed is not null").collect() == [] and raw.select("entity").count() == 20


def test_no_records(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text(line(HEADER) + "\n")
    assert read_hotel_csv(spark, str(path), line_breaks=True).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_any_sound_file_is_read_as_python_reads_it(spark, tmp_path, seed):
    """Texts with quotes, separators and line breaks, over splits of any size."""
    draw = random.Random(seed)
    pieces = ["word", ",", "\n", '"', "é", " ", ",,", '""']
    dialect = Dialect(3, escape='"')

    def row(i):
        made = [f"r{i}", "".join(draw.choices(pieces, k=draw.randrange(8))), draw.choice(["x", "y z"])]
        # a text of which a line is a whole record would end there
        return row(i) if any(dialect.count(part) == 3 for part in line(made).split("\n")[1:]) else made

    rows = [row(i) for i in range(draw.randrange(1, 40))]
    path = tmp_path / "any.csv"
    path.write_text("a,b,c\n" + "\n".join(map(line, rows)) + draw.choice(["", "\n"]))
    expected = sorted((a, b or None, c) for a, b, c in rows)
    sizes = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", draw.choice([1 << 20, 40, 90]))
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = read_records(spark, str(path), ["a", "b", "c"], header="a,b,c", escape='"')
        assert sorted(tuple(r)[:3] for r in got.collect()) == expected
        assert got.where(F.col("malformed").isNotNull()).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", sizes[0])
        spark.conf.set("spark.sql.files.openCostInBytes", sizes[1])
