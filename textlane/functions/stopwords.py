"""Stop-word tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The English stop-word list (198 words, the list the text
# cleaning step must remove to give the same tokens), in its published order.
ENGLISH_STOPWORDS = (
    'a', 'about', 'above', 'after', 'again', 'against', 'ain', 'all', 'am', 'an',
    'and', 'any', 'are', 'aren', "aren't", 'as', 'at', 'be', 'because', 'been',
    'before', 'being', 'below', 'between', 'both', 'but', 'by', 'can', 'couldn',
    "couldn't", 'd', 'did', 'didn', "didn't", 'do', 'does', 'doesn', "doesn't",
    'doing', 'don', "don't", 'down', 'during', 'each', 'few', 'for', 'from', 'further',
    'had', 'hadn', "hadn't", 'has', 'hasn', "hasn't", 'have', 'haven', "haven't",
    'having', 'he', "he'd", "he'll", 'her', 'here', 'hers', 'herself', "he's", 'him',
    'himself', 'his', 'how', 'i', "i'd", 'if', "i'll", "i'm", 'in', 'into', 'is',
    'isn', "isn't", 'it', "it'd", "it'll", "it's", 'its', 'itself', "i've", 'just',
    'll', 'm', 'ma', 'me', 'mightn', "mightn't", 'more', 'most', 'mustn', "mustn't",
    'my', 'myself', 'needn', "needn't", 'no', 'nor', 'not', 'now', 'o', 'of', 'off',
    'on', 'once', 'only', 'or', 'other', 'our', 'ours', 'ourselves', 'out', 'over',
    'own', 're', 's', 'same', 'shan', "shan't", 'she', "she'd", "she'll", "she's",
    'should', 'shouldn', "shouldn't", "should've", 'so', 'some', 'such', 't', 'than',
    'that', "that'll", 'the', 'their', 'theirs', 'them', 'themselves', 'then', 'there',
    'these', 'they', "they'd", "they'll", "they're", "they've", 'this', 'those',
    'through', 'to', 'too', 'under', 'until', 'up', 've', 'very', 'was', 'wasn',
    "wasn't", 'we', "we'd", "we'll", "we're", 'were', 'weren', "weren't", "we've",
    'what', 'when', 'where', 'which', 'while', 'who', 'whom', 'why', 'will', 'with',
    'won', "won't", 'wouldn', "wouldn't", 'y', 'you', "you'd", "you'll", 'your',
    "you're", 'yours', 'yourself', 'yourselves', "you've",
)


def stopword_table(spark: SparkSession, lang: str = "english",
                   words: tuple[str, ...] | None = None) -> DataFrame:
    """``(lang, term)`` table for one language (bounded, broadcast-safe)."""
    words = ENGLISH_STOPWORDS if words is None else tuple(words)
    schema = T.StructType([T.StructField("lang", T.StringType(), False),
                           T.StructField("term", T.StringType(), False)])
    return spark.createDataFrame([(lang, w) for w in dict.fromkeys(words)], schema)


def sql_list(words: tuple[str, ...] = ENGLISH_STOPWORDS) -> str:
    """The words as a SQL ``IN`` list body."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
