"""End to end: text files in, one CSV file out, compared as sorted lines."""

from __future__ import annotations

from pathlib import Path

from rating_files import rating_file, write_rating_files

from tastes.job import parse_args, run_job
from tastes.params import JobParams, TasteParams

# The original job's golden case (five movies, R=5, M=3, U=4).
GOLDEN_RATINGS = {
    1: """11111,3,2005-09-06
222222,5,2005-05-13
4444,4,2005-12-26
55555,3,2004-05-03
6666,4,2005-11-17
777777,4,2004-08-05
8888,3,2004-04-22
99999,4,2004-05-09
100000,3,2005-05-11""",
    2: """99999,5,2005-02-08
100000,5,2005-05-15
4444,5,2005-05-30
55555,1,2005-04-27
11111,4,2005-07-10
8888,5,2005-03-14
6666,3,2005-04-27
777777,4,2005-06-10
222222,5,2005-07-12
33333,4,2005-08-11""",
    3: """11111,4,2003-03-29
33333,5,2004-02-01
100000,5,2004-07-03
55555,5,2005-07-22""",
    4: """222222,3,2005-09-06
4444,1,2004-06-28
33333,5,2004-10-16
100000,3,2005-10-29
99999,1,2005-02-21
55555,1,2004-05-17
11111,2,2004-09-13
8888,4,2004-09-22
6666,4,2004-03-15
777777,5,2004-08-26""",
    5: """4444,4,2005-09-05
55555,3,2005-04-19
777777,4,2005-04-22
8888,5,2005-11-21
99999,4,2004-11-13
6666,2,2004-12-06
222222,3,2005-07-21
100000,4,2004-12-10
33333,4,2005-02-24
11111,3,2005-05-23""",
}
GOLDEN_TITLES = """1,2003,Dinosaur Planet
2,2004,Isle of Man TT 2004 Review
3,1997,Character
4,2003,Paula Abdul's Get Up & Dance
5,2004,The Rise and Fall of ECW
"""
GOLDEN_REPORT = """100000,Isle of Man TT 2004 Review,2004,2005-05-15
6666,Dinosaur Planet,2003,2005-11-17
55555,Character,1997,2005-07-22
11111,Isle of Man TT 2004 Review,2004,2005-07-10
"""
GOLDEN_PARAMS = TasteParams(min_ratings=5, top_items=3, top_users=4)


def write_golden(root: Path) -> tuple[Path, Path]:
    ratings = write_rating_files(
        root / "training_set",
        {
            f"mv_{movie:07d}.txt": rating_file(movie, text.splitlines())
            for movie, text in GOLDEN_RATINGS.items()
        },
    )
    titles = root / "movie_titles.txt"
    titles.write_text(GOLDEN_TITLES)
    return ratings, titles


def report_lines(output_dir: Path) -> list[str]:
    parts = [p for p in output_dir.iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1, parts
    return sorted(line.strip() for line in parts[0].read_text().splitlines() if line.strip())


def expected_lines(text: str) -> list[str]:
    return sorted(line.strip() for line in text.splitlines() if line.strip())


def test_golden_report(spark, tmp_path):
    ratings, titles = write_golden(tmp_path)
    out = tmp_path / "report"
    run_job(
        spark,
        JobParams(str(ratings), str(titles), str(out), GOLDEN_PARAMS, partitions=8),
    )
    assert report_lines(out) == expected_lines(GOLDEN_REPORT)


def test_golden_report_without_materializing(spark, tmp_path):
    ratings, titles = write_golden(tmp_path)
    out = tmp_path / "report"
    run_job(
        spark,
        JobParams(str(ratings), str(titles), str(out), GOLDEN_PARAMS, materialize_ratings=False),
    )
    assert report_lines(out) == expected_lines(GOLDEN_REPORT)


def test_command_line_names(tmp_path):
    params = parse_args(
        [
            "--movie-ratings-dir", "r",
            "--movie-titles-file", "t",
            "--output-dir", "o",
            "--min-rate-users-number", "5",
            "--top-movies-number", "3",
            "--contrarian-users-number", "4",
            "--partitions-number", "8",
        ]
    )
    assert params.tastes == GOLDEN_PARAMS
    assert (params.ratings_dir, params.titles_file, params.output_dir) == ("r", "t", "o")
    assert params.partitions == 8
    defaults = parse_args(["--ratings-dir", "r", "--titles-file", "t", "--output-dir", "o"])
    assert defaults.tastes == TasteParams(min_ratings=50, top_items=5, top_users=25)


def test_report_quotes_titles_with_commas(spark, tmp_path):
    ratings = write_rating_files(
        tmp_path / "training_set",
        {
            "mv_1.txt": rating_file(1, ["10,1,2005-01-01", "11,1,2005-01-02", "12,2,2005-01-03"]),
            "mv_2.txt": rating_file(2, ["10,5,2005-02-01", "11,5,2005-02-02", "12,5,2005-02-03"]),
            "mv_3.txt": rating_file(3, ["10,4,2005-03-01", "11,3,2005-03-02"]),
        },
    )
    titles = tmp_path / "movie_titles.txt"
    titles.write_text('1,2001,Alpha\n2,2002,"Quoted", Title, With Commas\n3,2003,Gamma\n')
    out = tmp_path / "report"
    run_job(
        spark,
        JobParams(str(ratings), str(titles), str(out), TasteParams(min_ratings=2, top_items=1, top_users=2)),
    )
    # top item: 2 (more than 2 rows, best average); users 10, 11, 12 tie on it
    # and the two lowest ids stay; each user's own best is item 2 itself
    assert report_lines(out) == sorted(
        [
            '10,"\\"Quoted\\", Title, With Commas",2002,2005-02-01',
            '11,"\\"Quoted\\", Title, With Commas",2002,2005-02-02',
        ]
    )


def test_shuffle_partitions_sized_from_input(spark, tmp_path, monkeypatch):
    import sys

    job = sys.modules["tastes.job"]
    ratings, _ = write_golden(tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert job.input_bytes(spark, str(ratings)) == sum(
        p.stat().st_size for p in ratings.glob("*.txt")
    )
    # a small input never lowers the session setting
    assert job.wanted_shuffle_partitions(spark, str(ratings)) == int(before)
    # a large one raises it: with a target of one byte per partition
    monkeypatch.setattr(job, "BYTES_PER_PARTITION", 1)
    assert job.wanted_shuffle_partitions(spark, str(ratings)) > int(before)


def test_a_job_restores_the_session(spark, tmp_path):
    ratings, titles = write_golden(tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_job(
        spark, JobParams(str(ratings), str(titles), str(tmp_path / "a"), GOLDEN_PARAMS, partitions=3)
    )
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_short_option_names():
    params = parse_args("-mrd r -mtf t -o o -mrun 5 -tmn 3 -cun 4 -pn 8".split())
    assert (params.ratings_dir, params.titles_file, params.output_dir) == ("r", "t", "o")
    assert params.tastes == GOLDEN_PARAMS and params.partitions == 8
