"""Small tables and the cases that every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

SF = "/root/testdata/sf0.001"
PROSE = ("the river ran past the old mill and the children of the village went down to it in the "
         "evening to watch the boats that came with salt and cloth from the towns along the coast ")


def docs(spark, rows):
    """``rows`` of (id, text, lang, source)."""
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCS)


def odd(spark):
    """Nulls in every column, empty, blank, very long and repeated rows."""
    long = " ".join(f"word{i % 977} the of" for i in range(12_000))
    return docs(spark, [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n ", None, "a"), (4, PROSE * 3, "en", "a"),
        (4, PROSE * 3, "en", "a"), (5, long, "en", "b"), (None, PROSE, "en", "b"), (6, PROSE * 3, None, None),
        (7, "x", "fr", "b"), (8, "été à la plage. " * 20, "fr", "b"), (9, "12 345 6789", "en", "b")])


#: Names that operators use inside, as extra columns of their input.
CLASHES = ("h", "h1", "n", "token", "tokens", "words", "score", "bucket", "depth", "prefix", "__t", "__w", "__lang", "__id",
           "__text", "word", "weight", "topic", "component", "cluster", "unit", "size", "kept", "spans", "frame", "item_id")


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("?") for c in _new_names(df)})


def _new_names(df):
    return [c for c in CLASHES if c not in df.columns]


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
