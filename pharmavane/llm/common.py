"""Small helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.session import scratch_path

# Fixed: the white space of all text contracts, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """A column of whatever name, also one with dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` alone, so that no other column can clash; null text is empty."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def carried(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` and all other columns as one, ``rest``, out of the way of any name."""
    others = [column(c) for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*others) if others else F.lit(None)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), rest.alias("rest")
    )


def restored(rows: DataFrame, columns: list[str], id_col: str, text_col: str, fresh: dict[str, Column] | None = None) -> DataFrame:
    """The columns that ``carried`` took apart, in their order, some computed anew."""
    known = {id_col: F.col("doc_id"), text_col: F.col("text")} | (fresh or {})
    return rows.select(*[known.get(c, F.col("rest").getField(c)).alias(c) for c in columns])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """The runs of characters other than ``SPACES``, in order."""
    return F.filter(F.split(text, SPACE_RUN), lambda word: word != "")


def count_words(text: Column) -> Column:
    """The number of ``words``, without building them."""
    return F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("long")
