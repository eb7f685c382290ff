"""Small tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """rows: (doc_id, text) or (doc_id, text, lang, source); extra: names of further columns."""
    full = [(*r, "en", "s")[:4] if len(r) == 2 else r for r in rows]
    d = spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)
    for name in extra:
        from pyspark.sql import functions as F

        d = d.withColumn(name, F.lit(name))
    return d
