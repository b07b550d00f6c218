"""Small tables with the cases every operator must take: NULLs, empties, repeats, clashing names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

CLASHING = (
    "kept boolean, size long, fp string, component_id string, u int, root int, words int,"
    " hits int, item_id int, n_hit int, position string, taken string, host int, rule int"
)


def docs(spark, texts, sources=None):
    sources = sources or [None] * len(texts)
    rows = [
        (i, t, "en", s, None if t is None else len(t))
        for i, (t, s) in enumerate(zip(texts, sources, strict=True))
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The table with extra columns named like what operators compute."""
    from pyspark.sql import functions as F

    for part in CLASHING.split(","):
        name, kind = part.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df
