"""Odd rows that every operator has to take, and small tables of the given data."""

import pandas as pd

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, component string, word string, part int"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns whose names operators use inside."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog\nshared line\n", "en", "src0"),
        (2, "the quick brown fox jumps over the lazy dog\nshared line\n", "en", "src0"),
        (2, "the quick brown fox jumps over the lazy dog\nshared line\n", "en", "src0"),
        (3, None, "en", "src1"), (4, "", None, None), (5, LONG, "en", "src0"), (6, "12 34 !!", "de", "src3"),
        (7, "  Shared Line \t\nder schnelle braune fuchs springt\n\n\n", "de", None), (None, "le renard brun saute par dessus", "fr", "src2"),
        (None, None, None, None), (8, "x", "fr", "src9"), (8, "y z", "fr", "src9"), (9, "Ünïcode 💡 text\r\nwith\x0bodd\x0cblanks", "es", "src9"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 7, "c", "w", 3) for r in rows], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def some_docs(spark, sf_dir, n=None):
    pdf = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    return pdf if n is None else pdf.sort_values("doc_id").head(n)


def as_docs(spark, texts, **more):
    pdf = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": "src0", "n_chars": [len(t or "") for t in texts]} | more)
    return spark.createDataFrame(pdf, "doc_id long, text string, lang string, source string, n_chars long")
