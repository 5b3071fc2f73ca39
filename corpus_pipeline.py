"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept;
``run`` writes each result to the shared folder and reads it again. All stages but the
last return the columns of ``docs``, whatever else they are called; null texts count as
empty, and empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import decontaminate, lines, packing, quality, simhash
from trendloom.llm.queries import load_byte_bpe, table
from trendloom.sources.workspace import materialise

_READ = ("doc_id", "text", "lang")


def _shielded(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns that no stage reads renamed, so that no result clashes."""
    names = [n if n in _READ else f"__kept{i}" for i, n in enumerate(docs.columns)]
    return docs.toDF(*names), names


def _restored(done: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return done.select(*[F.col(f"`{n}`") for n in names]).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language reference."""
    inner, names = _shielded(docs)
    if "lang" not in names:
        inner = inner.withColumn("lang", F.lit(None).cast("string"))
    judged = quality.judge(inner, quality.fit_references(inner))
    return _restored(judged.where("kept"), names, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat windows seen before; ``n_chars`` follows."""
    inner, names = _shielded(docs)
    done = _restored(lines.dedup_lines(inner), names, docs)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _text_hash() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the smallest id."""
    inner, names = _shielded(docs)
    groups = simhash.simhash_groups(inner, shingle=3, limit=2)
    chosen = groups.where("chosen").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    keyed = inner.withColumn("__text_hash", _text_hash())
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    left = keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "__text_hash"])
    return _restored(left, names, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even within its error budget."""
    inner, names = _shielded(docs)
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), _text_hash())
    keyed = inner.withColumn("__key", key)
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    leaks = decontaminate.find_leaks(keyed.select("__key", "text"), items, doc="__key")
    return _restored(keyed.join(leaks.select("__key").distinct(), "__key", "left_anti"), names, docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(docs.select("doc_id", "text"), load_byte_bpe)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
#: SQL can express neither the fingerprints nor edit matching nor tokenising.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
