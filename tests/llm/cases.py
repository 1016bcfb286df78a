"""Small documents for the operator tests, and plain helpers."""

import re

from pyspark.sql import types as T

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"

# columns whose names the operators use inside
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("score", T.DoubleType()), ("uid", T.LongType()), ("h", T.LongType()),
    ("bucket", T.IntegerType()), ("block", T.LongType()), ("component", T.LongType()), ("key", T.LongType()))])


def words(n, seed=0):
    """n different-looking words, reproducible."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join(chr(97 + (x >> s) % 26) for s in (3, 8, 13, 18, 23)))
    return out


def rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(words(30_000, 9))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO"), (6, long_text), (7, long_text),
             (8, "same text here for all"), (8, "same text here for all"), (9, "é" * 500), (10, "1234 5678"),
             (11, "x" * 100_000), (None, "a row without id but with several words"), (None, None),
             (12, " ".join(words(80, 3))), (13, " ".join(words(40, 4) + words(80, 3)))]
    return [(i, t, None if i in (4, None) else "en", None if i in (5, None) else f"s{(i or 0) % 3}", None, 0.5, 1, 2, 3, 4, 5, 6)
            for i, t in texts]


def edge_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def shingle_set(text, k=5):
    w = spaced(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
