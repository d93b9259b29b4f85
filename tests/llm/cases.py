"""Small tables for the text operators: nulls, blanks, long and repeated texts, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the quick brown fox jumps over the lazy dog while nobody in the village looks up from work "


def documents(spark: SparkSession, texts: list, lang: str | None = "en", first: int = 0) -> DataFrame:
    rows = [
        t if isinstance(t, tuple) else (first + i, t, lang, "src", len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Every null there can be, blanks, one very long line, ties and repeated rows."""
    return documents(spark, [
        (0, None, "en", "a", None), (1, "", None, None, 0), (2, " \n\t ", "en", "a", 4),
        (3, "one", "en", "a", 3), (4, "Two words", "de", "a", 9), (None, "no id", "en", "a", 5),
        (None, None, None, None, None), (5, PROSE * 400, "en", "a", 0), (6, PROSE * 400, "en", "a", 0),
        (6, PROSE * 400, "en", "a", 0), (7, "x" * 30_000, "en", "a", 0), (8, "naïve café ☕ 😀 <|endoftext|> z", "fr", "a", 0),
        (9, "a b c\x0bd\x0ce\r\nf", "en", "a", 0), (9, "a b c\x0bd\x0ce\r\nf", "en", "a", 0),
        (10, " " * 9000 + "x" + "\n" * 9000, "en", "a", 0),
    ])


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{SF}/{name}.parquet")


def bag(frame: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
