"""Column names and explicit schemas of the three record kinds.

Ratings and titles are plain DataFrames. Key columns may be INT (text
sources) or BIGINT (tables derived from the driver's parquet data); every
operator works with either.
"""

from pyspark.sql import types as T

# Ratings: one row per rating line.
MOVIE_ID = "movieId"
CUSTOMER_ID = "customerId"
RATING = "rating"
RATING_DATE = "ratingDate"
RATING_COLUMNS = (MOVIE_ID, CUSTOMER_ID, RATING, RATING_DATE)

# Titles: one row per catalogue line.
ID = "id"
RELEASE_YEAR = "releaseYear"
TITLE = "title"
TITLE_COLUMNS = (ID, RELEASE_YEAR, TITLE)

# Computed columns.
AVG_RATING = "avgRating"
RATINGS_COUNT = "ratingsCount"
MAX_RATING = "maxRating"
POSITION = "position"

# Report: one row per contrarian user.
MOVIE_TITLE = "movieTitle"
MOVIE_RELEASE_YEAR = "movieReleaseYear"
REPORT_COLUMNS = (CUSTOMER_ID, MOVIE_TITLE, MOVIE_RELEASE_YEAR, RATING_DATE)

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField(MOVIE_ID, T.IntegerType(), True),
        T.StructField(CUSTOMER_ID, T.IntegerType(), True),
        T.StructField(RATING, T.IntegerType(), True),
        T.StructField(RATING_DATE, T.StringType(), True),
    ]
)

TITLES_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.IntegerType(), True),
        T.StructField(RELEASE_YEAR, T.StringType(), True),
        T.StructField(TITLE, T.StringType(), True),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField(CUSTOMER_ID, T.IntegerType(), True),
        T.StructField(MOVIE_TITLE, T.StringType(), True),
        T.StructField(MOVIE_RELEASE_YEAR, T.StringType(), True),
        T.StructField(RATING_DATE, T.StringType(), True),
    ]
)
