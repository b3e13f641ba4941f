"""The registry of queries and their DuckDB twins, and what they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where a row stands in its table: among equals, the row that is read first.
PLACE = ("file_path", "row_index")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table with its rows' places."""
    return table(spark, sf_dir, name).select("*", *[F.col(f"_metadata.{c}").alias(c) for c in PLACE])


_FILLER = "The samples were measured twice and averaged over all runs of the device. " * 4
#: Sections appended to documents by doc_id % 12, so that every rule sees both outcomes.
SECTIONS = (
    "This work was supported by the National Science Foundation under Grant No. AB-1234.", "This research is partially funded by the European Research Council (ERC).",
    "The claim is supported by the evidence in the first table of this paper.", "We acknowledge the financial support of the Example Foundation and its council. " * 20, "The author would like to thank all organizers for their support.",
    "[12] Smith, J. et al. Journal of Grants 4 (2010) 1-10.", "| a | 1 | b | 2 | c |\n|---|---|---|---|---|", "12\n13\n14\n15\n16",
    _FILLER + "Funding: this study was funded by the council through grant number 77. " + _FILLER, _FILLER * 2 + "J. Doe was supported by a fellowship from the trust. " + _FILLER + "Nothing else is said here! " + _FILLER,
    "This work was supported by a research grant award (grant number RG-55). Financial support funding sponsored by the foundation.",
)


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a section appended to eleven of twelve."""
    docs = table(spark, sf_dir, "documents")
    section = F.get(F.array(*map(F.lit, SECTIONS)), F.pmod("doc_id", F.lit(12)).cast("int"))
    return docs.withColumn("text", F.concat_ws("\n\n", "text", section, F.lit("The end.")))


def literal(s: str) -> str:
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in s.split("\n"))


WORKS = "works AS (SELECT doc_id, lang, source, concat_ws(chr(10) || chr(10), text, CASE doc_id % 12 " + " ".join(f"WHEN {i} THEN " + literal(s) for i, s in enumerate(SECTIONS)) + " END, 'The end.') AS text FROM documents)"
