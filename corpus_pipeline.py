"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, folder) and returns rows with the columns of `docs`; the last returns the
digests of the encoded texts. Results are written as Parquet and read again by the next stage.

Defined results: null ids are kept by every stage and take no part in links; null and empty texts pass
every stage; rows that repeat an id stay or go together; an empty table stays empty; extra columns
are carried through, whatever their names.

`run`, the registered query, deletes repeated runs of lines to both ends. `drop_repeated_lines` by itself, as in STAGES,
goes by forward windows and keeps a run's last lines if fewer than 50 words remain from them to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlark import runtime
from feedlark.llm import bpe, decontam, linededup, neardup, toxicity
from feedlark.llm.queries import BPE_FILE, table


def _prepare(spark: SparkSession) -> None:
    runtime.set_scratch_if_unset(spark)
    runtime.small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a score below 0.5. The classifier learns from the labels of rows that are not held out."""
    _prepare(spark)
    model = toxicity.fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("doc"), "text"), model)
    return scored.filter("predicted = 0").select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str, both_sides: bool = False) -> DataFrame:
    """Documents without the passages that stand earlier; those of which no word is left go. The text
    and its length change, nothing else. With `both_sides` repeated runs go with their last lines."""
    _prepare(spark)
    rest = F.struct(*(c for c in docs.columns if c != "text"))  # texts are stored once
    cleaned = linededup.dedup_lines(docs.select(rest.alias("doc"), "doc_id", "text"), both_sides=both_sides)
    empty = (F.col("n_deleted") > 0) & ~F.regexp_like("kept_text", F.lit(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_deleted") > 0, F.length("kept_text").cast("long"))
    changed = {"text": F.col("kept_text"), "n_chars": F.coalesce(length, F.col("doc")["n_chars"]) if "n_chars" in docs.columns else None}
    columns = [(changed[c] if c in changed else F.col("doc")[c]).alias(c) for c in docs.columns]
    return cleaned.filter(F.col("kept_text").isNull() | ~empty).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies, by the rule of op7, the document of the smallest id."""
    _prepare(spark)
    return neardup.keep_one(docs, shingle=3, share=(85, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty stand in a benchmark window."""
    _prepare(spark)
    packed = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    judged = decontam.decontaminate(packed, table(spark, folder, "benchmark"), carry=["doc"])
    return judged.filter(~F.col("contaminated")).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Tokens of the whole texts, by number and digest, with the digest of the text decoded from them."""
    import public_tokenizers

    _prepare(spark)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return bpe.with_round_trip(docs.select(*kept, "text"), public_tokenizers.path(BPE_FILE)).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# What the flow asks of a stage beyond its defaults, which the stage's own test defines
ASKED = {"line dedup": {"both_sides": True}}

ORACLE_SQL = None  # SQL cannot express the classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = runtime.materialise(stage(spark, docs, sf_dir, **ASKED.get(name, {})), name.replace(" ", "-"))
    return docs
