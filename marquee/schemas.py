"""Explicit schemas for every input document, so no scan infers types."""

from pyspark.sql import types as T

from marquee.functions import fixed

GENRE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("popularity", T.DoubleType())])
CAST_MEMBER = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("character", T.StringType()),
     T.StructField("popularity", T.DoubleType())]
)
CREW_MEMBER = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("job", T.StringType()),
     T.StructField("popularity", T.DoubleType())]
)

MOVIE_DETAILS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("budget", T.LongType()),
        T.StructField("revenue", T.LongType()),
        T.StructField("runtime", T.IntegerType()),
        T.StructField("popularity", T.DoubleType()),
        T.StructField("vote_average", T.DoubleType()),
        T.StructField("vote_count", T.LongType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("overview", T.StringType()),
        T.StructField("genres", T.ArrayType(GENRE)),
    ]
)

CREDITS_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField(
            "credits",
            T.StructType(
                [T.StructField("cast", T.ArrayType(CAST_MEMBER)), T.StructField("crew", T.ArrayType(CREW_MEMBER))]
            ),
        ),
    ]
)

TRAILERS = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("video_id", T.StringType()),
        T.StructField(
            "trailer_stats",
            T.StructType(
                [T.StructField(c, T.StringType()) for c in ("viewCount", "likeCount", "commentCount")]
            ),
        ),
        T.StructField("comments", T.ArrayType(T.StringType())),
    ]
)

CREDITS_ENTRY = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("cast", T.ArrayType(CAST_MEMBER)),
        T.StructField("directors", T.ArrayType(PERSON)),
        T.StructField("composers", T.ArrayType(PERSON)),
    ]
)
CREDITS_MAP = T.MapType(T.StringType(), CREDITS_ENTRY)

ARTICLE_ENTRY = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("wikipedia_page", T.StringType()),
        T.StructField("worldwide_box_office", T.DoubleType()),
        T.StructField("domestic_box_office", T.DoubleType()),
        T.StructField("budget", T.DoubleType()),
    ]
)
ARTICLE_MAP = T.MapType(T.StringType(), ARTICLE_ENTRY)

SERIES_MAP = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

SENTIMENT = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("youtube_sentiment", T.DoubleType()),
        T.StructField("sentiment_volatility", T.DoubleType()),
    ]
)

SNIPPETS = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField(
            "google_snippets",
            T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("title", "description", "url")])),
        ),
    ]
)

REPORT_ROW = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("actual_revenue", T.DoubleType()),
        T.StructField("predicted_revenue", T.DoubleType()),
        T.StructField("error_percentage", T.DoubleType()),
    ]
)
REPORT = T.StructType([T.StructField("total_count", T.LongType()), T.StructField("results", T.ArrayType(REPORT_ROW))])

PREDICTION = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("predicted_revenue", T.DoubleType()),
        T.StructField("success_class", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

RECORD = "movie_id bigint, " + ", ".join(f"{name} {dtype}" for name, dtype, _ in fixed.RECORD_FIELDS)
