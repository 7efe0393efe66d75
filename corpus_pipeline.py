"""A corpus from ``documents``: five stages, each one operator of ``hearth.llm``.

Every stage reads what its predecessor wrote. All but the last return the columns of
``documents``, and other columns of the table, whatever their names, come back unchanged: a row
travels in a struct beside its key, the hash of its file and its place in it, which Spark
knows for every row of a written table. Verdicts are written as narrow tables of keys and joined
back, so rows that agree in id, text or everything are still told apart. Null ids and texts are
handled as the operators say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import materialize, read_table
from hearth.llm.decontaminate import decontaminate
from hearth.llm.packing import pack
from hearth.llm.pii import personal_data, redact
from hearth.llm.quality import judge
from hearth.llm.queries import tokenizer_path
from hearth.llm.simhash import near_duplicates

#: no stage but the first two base rules could be stated in SQL (XXH64, the tokenizer, learned cut-offs)
ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """``row, doc``: a key for each row that is the same whenever it is read, and the row's columns.

    A frame that is no plain read of files is written first.
    """
    def keyed(frame: DataFrame) -> DataFrame:
        at = frame.metadataColumn("_metadata")
        return frame.select(F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("place")).alias("row"), F.struct(*[frame[c] for c in frame.columns]).alias("doc"))

    try:
        return keyed(docs)
    except AnalysisException:
        return keyed(materialize(docs, "stage-input"))


def _narrow(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("row", *[F.col(f"doc.{c}").alias(c) for c in columns])


def _without(rows: DataFrame, keys: DataFrame, label: str) -> DataFrame:
    """The documents whose rows are not among ``keys``; Spark broadcasts the keys only where their
    written table is small."""
    gone = materialize(keys.select(F.col("key").alias("row")), label)
    return rows.join(gone, "row", "left_anti").select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff of their language reject go.

    Null, empty and blank texts fail the base rules. Equal rows share their verdict, rows of one id
    and text in two languages may not. Without labels only the base rules act.
    """
    rows = _rows(docs)
    found = judge(_narrow(rows, "doc_id", "text", "lang"), read_table(spark, sf_dir, "labels"), key_col="row")
    return _without(rows, found.filter(~F.col("kept")), "rejected")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints the document with the smallest id stays.

    Ids compare as their type does; null ids come last; of equal ids the first row by key stays, so
    of repeated rows one is left. Texts without words are one group.
    """
    rows = _rows(docs)
    found = near_duplicates(_narrow(rows, "doc_id", "text"), max_bits=4, shingle=4, key_col="row").select("id", "key", "root")
    found = materialize(found, "groups")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("x")).select("x.key")
    return _without(rows, found.join(first.hint("merge"), "key", "left_anti"), "copies")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Without items all stay."""
    rows = _rows(docs)
    found = decontaminate(_narrow(rows, "doc_id", "text"), read_table(spark, sf_dir, "benchmark"), key_col="row")
    return _without(rows, found.filter("n_hit > 0"), "leaked")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; ``n_chars`` follows the new text.

    Documents without any, null texts among them, come back as they are.
    """
    rows = _rows(docs)
    found = personal_data(_narrow(rows, "doc_id", "text"), key_col="row").filter(F.size("spans") > 0)
    told = rows.join(materialize(found.select(F.col("key").alias("row"), "spans"), "spans"), "row", "left")
    text = F.when(F.col("spans").isNotNull(), redact(F.col("doc.text"), F.col("spans"))).otherwise(F.col("doc.text"))
    told = told.withColumn("text", text)
    size = F.when(F.col("spans").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text")} | ({} if size is None else {"n_chars": size})
    return told.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, and their places in sequences of 2048 tokens.

    Null and empty texts bring the end id alone; repeated rows each bring their pieces.
    """
    return pack(docs, tokenizer_path(), length=2048, end_id=1, ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("benchmark", benchmark),
    ("personal", personal),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
