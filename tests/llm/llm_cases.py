from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

WORDS = "the of and with river stone light under seven houses walk slowly toward morning bridges open water falls silent bright".split()


def sentence(seed, n=40):
    return " ".join(WORDS[(seed * 7 + i * i * (seed % 5 + 1)) % len(WORDS)] + str((seed * i) % 17) for i in range(n))
