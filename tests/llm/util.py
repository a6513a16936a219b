"""Small document tables for the operators' edge cases."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        key, text, lang, source = (*r, *("en", "src0")[len(r) - 2 :])
        full.append((key, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOCS)


def odd_docs(spark: SparkSession) -> DataFrame:
    """NULLs in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "the same words here"), (2, "the same words here"), (2, "the same words here"), (3, ""), (4, None), (None, "no id at all"),
        (None, None, None, None), (5, "x"), (6, long, "en", None), (7, long, None, "src1"), (5, "x"), (8, " \t\n ", "de", "src2"),
    ]
    df = docs_of(spark, rows)
    clashing = ["__id", "__hash", "_mask", "_removed", "_copies", "_copy", "_n", "_language", "__parts", "__gaps", "lines"]
    df = df.selectExpr("*", *[f"'mine {c}' as `{c}`" for c in clashing], "'dotted' as `a.b`")
    return df.selectExpr("*", "'r' as rank", "1 as size", "2 as _bucket", "'v' as variant", "'l' as label", "3 as fp")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def keeps_columns(before: DataFrame, after: DataFrame) -> bool:
    """The user's own columns are all there, with their values."""
    mine = [c for c in before.columns if c.startswith("_")]
    return after.select(*mine).distinct().collect() == before.select(*mine).distinct().collect()
