"""Text sources: one rule per test (FIXTURES.md §3)."""

from __future__ import annotations

import pytest
from rating_files import rating_file, write_rating_files

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tastes.sources.text import parse_ratings, read_ratings, read_titles


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ratings_parse_header_and_lines(spark, tmp_path):
    d = write_rating_files(
        tmp_path / "r",
        {
            "mv_1.txt": rating_file(1, ["10,3,2005-01-01", "11,5,2005-01-02"]),
            "mv_2.txt": rating_file(2, ["10,1,2004-12-31"]),
        },
    )
    assert rows(read_ratings(spark, str(d))) == [
        (1, 10, 3, "2005-01-01"),
        (1, 11, 5, "2005-01-02"),
        (2, 10, 1, "2004-12-31"),
    ]


def test_ratings_arity_rules(spark, tmp_path):
    lines = [
        "bad,row",  # two fields: dropped
        "1,2,2005-01-01,extra",  # four fields: dropped
        "",  # blank: dropped
        "7,3,2005-01-01,",  # trailing empty field ignored: kept
        "8,3,",  # only two fields once trailing empties go: dropped
        "9,4,2005-02-02,,,",  # kept
    ]
    d = write_rating_files(tmp_path / "r", {"mv_5.txt": rating_file(5, lines)})
    assert rows(read_ratings(spark, str(d))) == [(5, 7, 3, "2005-01-01"), (5, 9, 4, "2005-02-02")]


def test_ratings_crlf_and_blanks_around_fields(spark, tmp_path):
    text = rating_file(6, [" 7 , 3 ,2005-01-01 ", "\t8,\t2,2005-01-02\t"], newline="\r\n")
    d = write_rating_files(tmp_path / "r", {"mv_6.txt": text})
    assert rows(read_ratings(spark, str(d))) == [(6, 7, 3, "2005-01-01"), (6, 8, 2, "2005-01-02")]


def test_ratings_signed_integers(spark, tmp_path):
    d = write_rating_files(tmp_path / "r", {"a.txt": "+7:\n+10,-1,2005-01-01\n007,3,d\n"})
    assert rows(read_ratings(spark, str(d))) == [(7, 7, 3, "d"), (7, 10, -1, "2005-01-01")]


def test_ratings_header_with_blanks(spark, tmp_path):
    d = write_rating_files(tmp_path / "r", {"a.txt": " 42 :\n1,2,2005-01-01\n"})
    assert rows(read_ratings(spark, str(d))) == [(42, 1, 2, "2005-01-01")]


def test_ratings_only_txt_files_directly_in_directory(spark, tmp_path):
    d = write_rating_files(
        tmp_path / "r",
        {"mv_1.txt": rating_file(1, ["10,3,2005-01-01"]), "notes.md": "not a rating file\n"},
    )
    assert rows(read_ratings(spark, f"  {d}/  ")) == [(1, 10, 3, "2005-01-01")]


def test_ratings_keep_duplicate_lines_for_the_operators(spark, tmp_path):
    d = write_rating_files(
        tmp_path / "r",
        {
            "a.txt": rating_file(1, ["10,3,2005-01-01", "10,3,2005-01-01"]),
            "b.txt": rating_file(1, ["10,3,2005-01-01"]),
        },
    )
    assert len(rows(read_ratings(spark, str(d)))) == 3


def test_large_file_split_across_tasks_keeps_its_header(spark, tmp_path):
    lines = [f"{u},{u % 5 + 1},2005-01-01" for u in range(20000)]
    d = write_rating_files(tmp_path / "r", {"big.txt": rating_file(9, lines)})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_ratings(spark, str(d))
        assert df.select("movieId").distinct().collect()[0][0] == 9
        assert df.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "files",
    [
        {"a.txt": rating_file(1, ["abc,3,2005-01-01"])},  # bad customer id
        {"a.txt": rating_file(1, ["10,x,2005-01-01"])},  # bad rating
        {"a.txt": rating_file(1, ["10,5.0,2005-01-01"])},  # not an integer
        {"a.txt": rating_file(1, ["99999999999,5,2005-01-01"])},  # out of INT range
        {"a.txt": "10,3,2005-01-01\n"},  # no header line
        {"a.txt": "x:\n10,3,2005-01-01\n"},  # non-numeric movie id
        {"a.txt": "1:\n2:\n10,3,2005-01-01\n"},  # two header lines
    ],
)
def test_ratings_malformed_input_fails(spark, tmp_path, files):
    d = write_rating_files(tmp_path / "r", files)
    with pytest.raises(PySparkException, match="malformed|no header line|more than one header"):
        read_ratings(spark, str(d)).collect()


def test_titles_rules(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_text(
        "\n".join(
            [
                "1,2003,Dinosaur Planet",
                "2,2004,One, Two",  # comma kept in the title
                '3,1997,Say "Hi"',  # quotes are literal
                "4,2000",  # short line: dropped
                "5,2001,",  # empty title: dropped
                "",  # blank: dropped
                " 6 , 1999 , Padded ",
            ]
        )
        + "\n"
    )
    assert rows(read_titles(spark, str(path))) == [
        (1, "2003", "Dinosaur Planet"),
        (2, "2004", "One, Two"),
        (3, "1997", 'Say "Hi"'),
        (6, "1999", "Padded"),
    ]


def test_titles_first_line_with_comma(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_text("1,2000,A, B, C\n2,2001,Plain\n")
    assert rows(read_titles(spark, str(path))) == [(1, "2000", "A, B, C"), (2, "2001", "Plain")]


def test_titles_bad_id_fails(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_text("one,2000,Title\n")
    with pytest.raises(PySparkException, match="malformed title id"):
        read_titles(spark, str(path)).collect()


def test_header_join_without_broadcast_gives_same_rows(spark, tmp_path, shuffled_joins):
    files = {f"mv_{m}.txt": rating_file(m, [f"{u},{(u + m) % 5 + 1},2005-01-0{m}" for u in range(30)]) for m in range(1, 6)}
    d = write_rating_files(tmp_path / "r", files)
    shuffled = rows(read_ratings(spark, str(d)))
    assert len(shuffled) == 150
    assert shuffled == sorted((m, u, (u + m) % 5 + 1, f"2005-01-0{m}") for m in range(1, 6) for u in range(30))


def test_a_colon_outside_the_header_is_text(spark, tmp_path):
    d = write_rating_files(
        tmp_path / "r",
        {"a.txt": "1:\n10,3,2005-01-01 10:30\n11,4,12:00:00\n", "b.txt": " 2 :\n12,5,2005-01-01\n", "c.txt": ""},
    )
    assert rows(read_ratings(spark, str(d))) == [
        (1, 10, 3, "2005-01-01 10:30"), (1, 11, 4, "12:00:00"), (2, 12, 5, "2005-01-01")]


def test_hot_file_is_dealt_over_many_tasks(spark, shuffled_joins):
    lines = spark.range(20000).selectExpr("'big' as file", "concat(id, ',', id % 5 + 1, ',d') as value")
    lines = lines.union(spark.sql("select 'big' as file, '7:' as value"))
    found = parse_ratings(lines)
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 20000
    assert max(r["count"] for r in per_task) < 12000


def test_titles_of_blanks_and_trailing_commas(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_text("1,2000,   \n2,2001,Title,\n3,2002,\n4\n")
    assert rows(read_titles(spark, str(path))) == [(1, "2000", ""), (2, "2001", "Title,")]


def test_duplicates_within_and_across_files_count_once(spark, tmp_path):
    from tastes.operators import rating_stats

    d = write_rating_files(
        tmp_path / "r",
        {
            "a.txt": rating_file(1, ["10,3,2005-01-01", "10,3,2005-01-01", "11,5,2005-01-01"]),
            "b.txt": rating_file(1, ["10,3,2005-01-01", "12,1,2005-01-01"]),
        },
    )
    assert rows(rating_stats(read_ratings(spark, str(d)))) == [(1, 3.0, 3)]


def test_files_in_subfolders_are_not_read(spark, tmp_path):
    d = write_rating_files(tmp_path / "r", {"mv_1.txt": rating_file(1, ["10,3,2005-01-01"])})
    write_rating_files(d / "archive", {"mv_2.txt": rating_file(2, ["11,4,2005-01-01"])})
    assert rows(read_ratings(spark, str(d))) == [(1, 10, 3, "2005-01-01")]


def test_titles_with_crlf_line_ends(spark, tmp_path):
    path = tmp_path / "titles.txt"
    path.write_bytes(b"1,2000,First\r\n2,2001,Second, Part\r\n")
    assert rows(read_titles(spark, str(path))) == [(1, "2000", "First"), (2, "2001", "Second, Part")]


def test_header_that_is_not_the_first_line_fails(spark, tmp_path):
    folder = write_rating_files(tmp_path / "late", {"mv_1.txt": "7,5,2001-01-01\n1:\n8,4,2001-01-02\n"})
    with pytest.raises(Exception, match="not the first line"):
        read_ratings(spark, str(folder)).collect()
    folder = write_rating_files(tmp_path / "blank", {"mv_1.txt": "\n1:\n8,4,2001-01-02\n"})
    with pytest.raises(Exception, match="not the first line"):
        read_ratings(spark, str(folder)).collect()


def test_a_split_file_keeps_its_header(spark, tmp_path):
    lines = [f"{u},{u % 5 + 1},2001-01-{u % 28 + 1:02d}" for u in range(4000)]
    folder = write_rating_files(tmp_path / "split", {"mv_3.txt": rating_file(3, lines), "mv_4.txt": rating_file(4, lines[:9])})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 1
        got = [tuple(r) for r in read_ratings(spark, str(folder)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r[1] for r in got if r[0] == 3) == list(range(4000))
    assert sorted(r[1] for r in got if r[0] == 4) == list(range(9))


def test_lines_are_derived_once(spark, tmp_path):
    folder = write_rating_files(tmp_path / "once", {"mv_1.txt": rating_file(1, ["7,5,2001-01-01", "8,4,2001-01-02"])})
    df = read_ratings(spark, str(folder))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 1 and "ReusedExchange" in plan
