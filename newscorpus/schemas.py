"""Explicit schemas for every source; nothing is inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Where readers put a record that does not fit its schema.
CORRUPT = "_corrupt_record"

#: One article as the news API nests it.
API_ARTICLE = T.StructType(
    [
        T.StructField("source", _strings("id", "name")),
        *_strings(
            "title", "author", "description", "url", "urlToImage", "publishedAt", "content"
        ).fields,
    ]
)

#: One API response.
API_RESPONSE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("totalResults", T.IntegerType()),
        T.StructField("articles", T.ArrayType(API_ARTICLE)),
    ]
)

#: Flat article table.
ARTICLE = _strings(
    "source_id",
    "source_name",
    "author",
    "title",
    "description",
    "url",
    "url_to_image",
    "published_at",
    "content",
    "category",
)

#: One summarization result.
PREDICTION = T.StructType(
    [
        T.StructField("article_id", T.LongType()),
        T.StructField("original_text", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("original_summary", T.StringType()),
    ]
)
