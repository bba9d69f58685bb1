"""Fixed schemas. Nothing in the library infers a schema from data files.

Inference per folder breaks as soon as one day has only empty ``entities`` arrays: that day is read as
``array<string>`` and no longer unions with ``array<struct>``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, D, B, L, TS = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.TimestampType()

ARTICLE = _struct(
    source=_struct(id=S, name=S),
    author=S,
    title=S,
    description=S,
    url=S,
    urlToImage=S,
    publishedAt=S,
    content=S,
)

ENVELOPE = _struct(
    category=S, status=S, totalResults=L, articles=T.ArrayType(ARTICLE), code=S, message=S
)

SENTIMENT = _struct(label=S, scores=_struct(positive=D, negative=D, neutral=D))

ENTITY = _struct(text=S, category=S, subcategory=S, confidenceScore=D)

SILVER = _struct(
    id=S,
    url=S,
    title=S,
    body_snippet=S,
    source=S,
    publishedAt=S,
    author=S,
    nlpStatus=S,
    nlpError=S,
    sentiment=SENTIMENT,
    entities=T.ArrayType(ENTITY),
    keyPhrases=T.ArrayType(S),
    hasPii=B,
    content_vector=T.ArrayType(T.FloatType()),
    vectorStatus=S,
    vectorError=S,
    ingestedAt=S,
    enrichedAt=S,
    contentTruncated=B,
    category=S,
    article_date=T.DateType(),
)

SEARCH_DOC = _struct(
    id=S,
    url=S,
    title=S,
    body_snippet=S,
    source=S,
    category=S,
    published_at=TS,
    sentiment_label=S,
    sentiment_score_positive=D,
    entities=T.ArrayType(S),
    key_phrases=T.ArrayType(S),
    content_vector=T.ArrayType(T.FloatType()),
)

#: What each search field may be used for.
SEARCH_FIELD_USES = {
    "id": {"key", "filterable", "retrievable"},
    "url": {"retrievable"},
    "title": {"searchable", "retrievable"},
    "body_snippet": {"searchable", "retrievable"},
    "source": {"filterable", "facetable", "retrievable"},
    "category": {"filterable", "facetable", "retrievable"},
    "published_at": {"filterable", "sortable", "retrievable"},
    "sentiment_label": {"filterable", "facetable", "retrievable"},
    "sentiment_score_positive": {"filterable", "sortable", "retrievable"},
    "entities": {"searchable", "filterable", "retrievable"},
    "key_phrases": {"searchable", "retrievable"},
    "content_vector": {"vector"},
}

EVENT = _struct(eventType=S, subject=S, eventTime=TS, data=_struct(url=S, contentLength=L))

QUEUE_MSG = _struct(blobPath=S, urlHash=S, category=S, ingestedAt=S)

DEDUP = _struct(partitionKey=S, rowKey=S, url=S, category=S, ingestedAt=S)

AUDIT = _struct(rowKey=S, urlHash=S, event=S, details=S, ts=TS, audit_date=T.DateType())

ERROR = _struct(
    urlHash=S, blobPath=S, errorMeta=_struct(error=S, stage=S), failedAt=S, category=S, article_date=T.DateType()
)

REQUEST = _struct(
    query_id=L,
    q=S,
    top=S,
    category=S,
    source=S,
    sentiment=S,
    semantic=S,
    vector=S,
    date_from=S,
    date_to=S,
)

#: Fixed values of the data model.
CATEGORIES = ("technology", "business", "science", "health")
SENTIMENT_LABELS = ("positive", "negative", "neutral", "mixed")
VECTOR_STATUSES = ("ok", "empty_content", "failed", "unknown")
NLP_STATUSES = ("ok", "failed", "unknown")
BRONZE_CONTAINER = "articles-bronze"
FILE_CREATED = "Microsoft.Storage.BlobCreated"

#: Columns a silver table must have before the gold job touches it.
SILVER_REQUIRED = ("id", "category", "publishedAt", "nlpStatus", "sentiment", "entities", "keyPhrases")
