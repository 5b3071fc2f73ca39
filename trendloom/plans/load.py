"""Batch jobs: load facts, build aggregate tables, enrich and store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendloom.functions import (
    category_name,
    country_from_file,
    engagement_rate,
    like_ratio,
    split_tags,
    virality_score,
)
from trendloom.operators import aggregates
from trendloom.operators.cleaning import narrow_types
from trendloom.operators.joins import broadcast_if_small
from trendloom.schemas import FACT_PARTITIONS, FACT_VIDEOS, category_dimension
from trendloom.sources.sinks import (
    collect_statistics,
    create_tables,
    insert_partitions,
    replace_partitions,
    write_table,
)
from trendloom.sources.workspace import materialise


def load_facts(raw: DataFrame) -> DataFrame:
    """Typed facts with derived measures, country and category name."""
    facts = narrow_types(raw).withColumns(
        {
            "engagement_rate": engagement_rate(),
            "like_ratio": like_ratio(),
            "country": country_from_file(),
        }
    )
    if "category_name" in facts.columns:
        return facts
    return facts.withColumn("category_name", category_name())


#: Aggregate tables with their usual partitions.
_AGGREGATES = {
    "channel_statistics": (aggregates.channel_statistics, ["country"]),
    "category_trends": (aggregates.category_trends, ["year", "month", "country"]),
    "time_series_metrics": (aggregates.time_series_metrics, ["country"]),
}
#: Built by ``job_load`` where asked for: sketches from which distinct counts roll up.
_SKETCHES = {"channel_reach": (aggregates.channel_reach, ["year", "month", "country"])}


def _partition_values() -> dict[str, Column]:
    """An empty country is stored as NULL."""
    return {
        "year": F.year("trending_date"),
        "month": F.month("trending_date"),
        "country": F.nullif(F.col("country"), F.lit("")),
    }


@dataclass(frozen=True)
class Changes:
    """The partitions of aggregates that new facts fall in: years, months and countries.

    They are as many as the folders that the load writes, by month; not as many as rows.
    """

    values: frozenset[tuple]

    @classmethod
    def of(cls, facts: DataFrame) -> Changes:
        columns = [c.alias(n) for n, c in _partition_values().items()]
        return cls(frozenset(tuple(r) for r in facts.select(*columns).distinct().collect()))

    def touched(self, partitions: Sequence[str]) -> Column:
        """Whether a fact belongs to a changed partition of a table with this layout.

        A condition on the fact table's own partition columns, so that others are not read.
        """
        known = list(_partition_values())
        chosen = [known.index(p) for p in partitions]
        columns = [_partition_values()[p] for p in partitions]
        return _any_of({tuple(v[i] for i in chosen) for v in self.values}, columns)


def _any_of(rows: set[tuple], columns: list[Column]) -> Column:
    """Whether the columns have the values of one of the rows; NULL is a value.

    Values of the last column that go with the same other values share one comparison.
    """
    if not rows:
        return F.lit(False)
    if not columns:
        return F.lit(True)
    *rest, last = columns
    before: dict = {}
    for *others, value in rows:
        before.setdefault(value, set()).add(tuple(others))
    alike: dict = {}
    for value, others in before.items():
        alike.setdefault(frozenset(others), []).append(value)
    out = F.lit(False)
    for others, values in alike.items():
        given = [v for v in values if v is not None]
        found = last.isin(given) if given else F.lit(False)
        found = F.coalesce(found, F.lit(False))
        if None in values:
            found = found | last.isNull()
        out = out | (found & _any_of(set(others), rest) if rest else found)
    return out


def build_aggregates(
    facts: DataFrame,
    changes: Changes | None = None,
    layout: dict[str, list[str]] | None = None,
) -> dict[str, tuple[DataFrame, list[str]]]:
    """Aggregate tables by name, each with its partition columns.

    With ``changes`` only the partitions that they touch, from all facts of these.
    """
    out = {}
    for name, (build, usual) in {**_AGGREGATES, **_SKETCHES}.items():
        partitions = (layout or {}).get(name, usual)
        rows = facts if changes is None else facts.where(changes.touched(partitions))
        out[name] = (build(rows), partitions)
    return out


def job_load(
    raw: DataFrame,
    target: str,
    *,
    partitions: dict[str, list[str]] | None = None,
    tables: Sequence[str] | None = None,
) -> dict[str, str]:
    """Facts and aggregate tables as partitioned ORC below ``target``.

    Facts of other partitions stay, so days can be loaded one by one and again. Of the
    aggregates only the partitions that the new facts touch are built again, from all
    facts stored for these; an aggregate without partitions is built from all.
    ``partitions`` overrides the layout of single tables, for data too thin for
    a folder per day; ``tables`` limits the aggregates built.
    """
    spark = raw.sparkSession
    layout = partitions or {}
    paths = {"facts": f"{target}/facts"}
    new = load_facts(raw)
    replace_partitions(new, paths["facts"], layout.get("facts", FACT_PARTITIONS))
    wanted = [n for n in {**_AGGREGATES, **_SKETCHES} if n in (_AGGREGATES if tables is None else tables)]
    if wanted:
        facts = spark.read.orc(paths["facts"])
        built = build_aggregates(facts, Changes.of(new), layout)
        for name in wanted:
            paths[name] = f"{target}/{name}"
            replace_partitions(built[name][0], paths[name], built[name][1])
    return paths


def job_load_tables(raw: DataFrame, database: str) -> DataFrame:
    """As ``job_load`` into catalog tables; returns the storage summary."""
    spark = raw.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    fact_table = f"{database}.trending_facts"
    new = load_facts(raw)
    write_table(new, fact_table, FACT_PARTITIONS)
    facts = spark.table(fact_table)
    built = build_aggregates(facts, Changes.of(new))
    for name, (df, partitions) in ((n, built[n]) for n in _AGGREGATES):
        buckets = (10, "date_key") if name == "time_series_metrics" else None
        write_table(df, f"{database}.{name}", partitions, buckets)
    return aggregates.storage_summary(facts)


@dataclass(frozen=True)
class EnrichMetrics:
    records: int
    partitions: int
    saved_percent: float


def enrich(raw: DataFrame) -> DataFrame:
    """Unguarded measures, tag arrays and the loose country code."""
    return (
        raw.withColumn("engagement_rate", engagement_rate("unguarded"))
        .withColumn("like_ratio", like_ratio("unguarded"))
        .withColumn("virality_score", virality_score())
        .withColumn("tags", split_tags())
        .withColumn("country", country_from_file("loose"))
    )


def job_batch_enrich(
    raw: DataFrame, path: str, partitions: Sequence[str] = FACT_PARTITIONS
) -> EnrichMetrics:
    """Enrich, write partitioned ORC, and report.

    Rows, text sizes and partitions are observed while the write runs, so the input
    is read once and what is stored not at all. Other partitions stay.
    """
    seen, made = Observation("input"), Observation("output")
    observed = raw.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.sum(aggregates.row_chars(raw)).alias("chars"),
    )
    enriched = enrich(observed)
    replace_partitions(
        enriched.observe(made, F.sum(aggregates.row_chars(enriched)).alias("chars")), path, partitions
    )
    stored = raw.sparkSession.read.orc(path)  # the folders alone say how many there are
    parts = aggregates.distinct_partitions(stored, partitions).first()["partitions"]
    before = seen.get["chars"]
    saved = (1 - (made.get["chars"] or 0) / before) * 100 if before else 0.0
    return EnrichMetrics(seen.get["records"], parts, saved)


def update_channels(facts: DataFrame, stored: DataFrame, name: str) -> None:
    """Bring the channel dimension ``name`` up to date after ``facts`` came to ``stored``.

    Channels that the new facts name are built again from all their stored facts, the
    rows of all others stay as they are; a rerun is harmless.
    """
    named = facts.select("channel_title").where(F.col("channel_title").isNotNull()).distinct()
    named = materialise(named, "channels")  # both joins below can be planned by its true size
    built = aggregates.channel_dimension(stored.join(named, "channel_title", "left_semi"))
    others = facts.sparkSession.table(name).join(named, "channel_title", "left_anti")
    # a table cannot be read while it is overwritten
    whole = materialise(built.unionByName(others), "dimension")
    whole.select(*facts.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


def job_fill_tables(raw: DataFrame, database: str) -> dict[str, str]:
    """The whole data model, created and filled: facts, dimensions and aggregates.

    ``raw`` are text observations; tags and virality are added on the way. Partitions
    of other days stay, and aggregates are built again where the new facts fall.
    """
    spark = raw.sparkSession
    create_tables(spark, database)
    names = (
        "fact_videos", "dim_channels", "dim_categories", "channel_statistics", "category_trends",
        "time_series_metrics",
    )
    tables = {n: f"{database}.{n}" for n in names}
    facts = load_facts(raw).withColumn("virality_score", virality_score())
    tags = split_tags() if "tags" in raw.columns else F.lit(None)
    facts = facts.withColumn("tags", tags)
    if "description" not in facts.columns:
        facts = facts.withColumn("description", F.lit(None))
    typed = facts.select(*[F.col(f.name).cast(f.dataType) for f in FACT_VIDEOS])
    insert_partitions(typed, tables["fact_videos"], FACT_PARTITIONS)
    month = F.trunc("trending_date", "MM").alias("trending_date")
    # what the load names, in one more pass over its input; all that follows reads this
    named = materialise(typed.select("channel_title", month, "country").distinct(), "named")
    dim = category_dimension(spark).select(*spark.table(tables["dim_categories"]).columns)
    dim.coalesce(1).write.insertInto(tables["dim_categories"], overwrite=True)
    update_channels(named, spark.table(tables["fact_videos"]), tables["dim_channels"])
    names = spark.table(tables["dim_categories"]).select("category_id", "category_name")
    stored = spark.table(tables["fact_videos"]).join(broadcast_if_small(names), "category_id", "left")
    built = build_aggregates(stored, Changes.of(named))
    for name, (df, partitions) in ((n, built[n]) for n in _AGGREGATES):
        contract = spark.table(tables[name]).schema
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in contract])
        insert_partitions(df, tables[name], partitions)
    collect_statistics(spark, list(tables.values()))
    return tables
