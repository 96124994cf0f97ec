"""Small tables for the tests of the training-data operators."""

from pyspark.sql import DataFrame, SparkSession

#: Columns that operators use inside, to be sure that the caller's columns of these names do no harm.
CLASHING = "key string, fp string, hash int, value string, words int, score string, label string, n int"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text[, lang]) rows with the columns of documents and clashing ones."""
    full = [(d, t, lang[0] if lang else "en", "src0", len(t or ""), "k", "f", 1, "v", 2, "s", "l", 3) for d, t, *lang in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


EDGES = [(1, None), (2, ""), (3, "   \n\t "), (4, "x"), (5, "the same words again and again"), (5, "the same words again and again"), (None, "a text without an id of its own"), (7, "long " * 20000 + "end"), (8, "!!! ??? ..."), (9, "naïve Ünïcode İ ẞ 漢字   x")]


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [(0, "x")]).where("doc_id < 0")
