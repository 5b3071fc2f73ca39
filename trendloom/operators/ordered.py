"""Windows, ranks and quantiles that stay parallel when one key holds most of the rows.

Spark evaluates a window group inside one task. That is right for most keys, so rows are
routed by a histogram of their keys: rows of a key within the limit are one group, as
usual; rows of a hot key are cut into slices at borders drawn from the key's own rows,
every slice is a group, and what crosses its border (the running total, the row count and
the last few rows before it) comes from a table of slices. Where no key is hot, what is
left is the plain window. Counting keys reads their columns once, for all sets of keys
that a plan needs. Where one is hot, rows are stored once with their slices.

Ranks work on value counts, so that equal values are one row. Exact quantiles are selected
by histograms over ranges of values that are refined where a quantile falls.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from trendloom.sources.workspace import materialise

#: Rows of one key that one task evaluates.
HOT_ROWS = 1_000_000
#: Slices of all hot keys together; beyond, they hold more rows each. What is broadcast
#: has a row per hot key or slice and an entry per border, so this bounds its size.
MOST_SLICES = 50_000
#: Rows drawn for each border.
_DRAWN = 16
#: Borders are looked up level by level, fewer than ``_FAN`` of them at each.
_FAN, _LEVELS = 16, 4


def _sort_columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    """NULLs are first upwards and last downwards."""
    return [F.col(n).desc() if d == "desc" else F.col(n).asc() for n, d in order]


def _sort_key(df: DataFrame, order: Sequence[tuple[str, str]]) -> Column:
    """The order as one struct that compares as the sort columns sort; ties by hash."""
    parts = []
    for name, direction in order:
        if direction == "desc":
            if not isinstance(df.schema[name].dataType, T.NumericType):
                raise ValueError(f"{name} is no number and cannot be sorted downwards here")
            parts += [F.col(name).isNull(), -F.col(name)]
        else:
            parts.append(F.col(name))
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate([*parts, F.col("_tie")])])


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left copy of the keys."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


# --- routing of hot keys -----------------------------------------------------

Hot = dict[tuple[str, ...], DataFrame | None]


def hot_keys(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    hot_rows: int = HOT_ROWS,
    most_rows: int | None = None,
) -> Hot:
    """For each set of keys the values with too many rows for one task, None without any.

    That is over ``hot_rows`` rows, or over all rows divided by ``MOST_SLICES`` where that
    is more, so there are at most ``MOST_SLICES`` of them. They are stored; the driver learns
    only which sets have any. Columns are the keys and ``_size``, the rows a slice should
    have. With at most ``most_rows`` in all, where the caller knows that, there is nothing
    to count.
    """
    sets = [tuple(k) for k in key_sets]
    if most_rows is not None and most_rows <= hot_rows:
        return dict.fromkeys(sets)
    names = list(dict.fromkeys(n for keys in sets for n in keys))
    counts = df.groupingSets([[*keys] for keys in [(), *sets]], *names).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")
    )
    most = materialise(counts.where(F.col("_n") > hot_rows), "hot")
    largest = {r["_set"]: r["_n"] for r in most.groupBy("_set").agg(F.max("_n").alias("_n")).collect()}
    bits = {n: 1 << (len(names) - 1 - i) for i, n in enumerate(names)}
    total = max(largest.values(), default=0)
    size = max(hot_rows, -(-total // MOST_SLICES))
    out: Hot = {}
    for keys in sets:
        mine = sum(b for n, b in bits.items() if n not in keys)
        found = most.where((F.col("_set") == mine) & (F.col("_n") > size))
        found = found.select(*keys, F.lit(size).cast("bigint").alias("_size"))
        out[keys] = found if largest.get(mine, 0) > size else None
    return out


def _borders(base: DataFrame, hot: DataFrame, keys: list[str], key: Column) -> DataFrame:
    """The hot keys, each with the sorted keys of order at which its slices begin."""
    rows = join_null_safe(base, F.broadcast(hot), keys)
    lot = F.pmod(F.xxhash64("_tie", F.lit("border")), F.col("_size"))
    # copies of one row are drawn together, and count once
    drawn = rows.where(lot < _DRAWN).select(*keys, key.alias("_key")).distinct()
    sorted_keys = F.array_sort(F.collect_list("_key"))
    last = F.lit(_DRAWN - 1)
    return drawn.groupBy(*keys).agg(
        F.filter(sorted_keys, lambda _, i: i % _DRAWN == last).alias("_borders")
    )


def _at_or_before(sorted_keys: str, key: str, low: int = 0, high: int | None = None) -> Column:
    """How many of fewer than ``_FAN`` sorted keys are at or before ``key``, by bisection.

    Written out, since a higher-order function is not compiled. NULL is beyond all keys.
    """
    high = _FAN - 1 if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(
        F.get(sorted_keys, F.lit(middle)) <= F.col(key),
        _at_or_before(sorted_keys, key, middle + 1, high),
    ).otherwise(_at_or_before(sorted_keys, key, low, middle))


def _level(borders: DataFrame, keys: list[str], above: int, stride: int) -> DataFrame:
    """Every ``stride``-th border, as arrays that begin at each ``above``-th (a node)."""

    def inside(node: Column) -> Column:  # NULL beyond the last border
        places = F.sequence(F.lit(stride - 1), F.lit(above - stride - 1), F.lit(stride))
        return F.transform(places, lambda p: F.get("_borders", node * above + p))

    nodes = F.sequence(F.lit(0), F.floor(F.size("_borders") / above).cast("int"))
    return borders.select(*keys, F.posexplode(F.transform(nodes, inside)).alias("_node", "_at"))


def _tree(borders: DataFrame, keys: list[str]) -> DataFrame:
    """All levels in one table, numbered like a heap: those below the root share a broadcast.

    A table that has been made so is taken as it is.
    """
    if "_at" in borders.columns:
        return borders
    levels, first, above = [], 0, _FAN**_LEVELS
    while above > 1:
        stride = above // _FAN
        level = _level(borders, keys, above, stride)
        levels.append(level.withColumn("_node", F.col("_node") + first))
        first, above = first * _FAN + 1, stride
    return reduce(DataFrame.unionAll, levels)


def _with_slices(
    df: DataFrame, borders: DataFrame, keys: list[str], key: Column, how: str
) -> DataFrame:
    """``_slice``: how many borders of its key are at or before a row; 0 for keys that are not hot.

    A row that is joined to an array is copied with it, so all borders of a key at once
    would make a row cost as much as its key has slices. The borders are therefore a tree,
    in which a row meets ``_FAN`` of them a level. ``_node`` is a place in the heap: the
    children of n begin at n * ``_FAN`` + 1, and slices are what is below the last level.
    """
    rows, tree = df.withColumns({"_node": F.lit(0), "_key": key}), F.broadcast(_tree(borders, keys))
    for _ in range(_LEVELS):
        rows = join_null_safe(rows, tree, [*keys, "_node"], how)
        below = F.col("_node") * _FAN + 1 + _at_or_before("_at", "_key")
        rows = rows.withColumn("_node", below).drop("_at")
    first = sum(_FAN**n for n in range(_LEVELS))
    return rows.withColumn("_slice", F.col("_node") - first).drop("_key", "_node")


def _edges(
    rows: DataFrame, keys: list[str], order: Sequence[tuple[str, str]], value: str, depth: int
) -> DataFrame:
    """Per slice after the first of its key: rows, total and last values before it."""
    parts = rows.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s")
    )
    by_key = W.partitionBy(*keys)
    earlier = by_key.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    if depth:
        # Spark trims each input partition to the last rows of a slice before the shuffle
        turned = [(n, "asc" if d == "desc" else "desc") for n, d in order]
        backwards = W.partitionBy(*keys, "_slice").orderBy(*_sort_columns(turned))
        last = rows.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= depth)
        last = last.groupBy(*keys, "_slice").agg(
            F.array_sort(F.collect_list(F.struct("_back", F.col(value).alias("v")))).alias("_a")
        )
        nearest = last.select(*keys, "_slice", F.transform("_a", lambda s: s["v"]).alias("_last"))
        parts = join_null_safe(parts, nearest, [*keys, "_slice"])
        near = by_key.orderBy("_slice").rowsBetween(-depth, -1)
        tail = F.slice(F.flatten(F.reverse(F.collect_list("_last").over(near))), 1, depth)
    else:
        tail = F.lit(None).cast("array<string>")
    return (
        parts.withColumn("_pos0", F.sum("_n").over(earlier))
        .withColumn("_sum0", F.sum("_s").over(earlier))
        .withColumn("_tail", tail)
        .where(F.col("_pos0").isNotNull())
        .select(*keys, "_slice", "_pos0", "_sum0", "_tail")
    )


def ordered_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | tuple[str, str]],
    value: str,
    *,
    previous: str | None = None,
    moving: tuple[str, int] | None = None,
    running: str | None = None,
    position: str | None = None,
    of: DataFrame | None = None,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add row-wise window columns over ``keys`` in ``order``.

    ``previous`` names the column for the value one row earlier, ``moving`` is
    (name, n) for the mean over n preceding rows and the current one,
    ``running`` the cumulative sum, ``position`` the 1-based row number.
    ``order`` must be total up to rows that are interchangeable. Rows that tie in it
    are dealt out by a hash of the row, so ties do not pile up in one slice; only copies
    of a whole row stay together. ``of`` has the rows of ``df`` before columns were added
    that cost something: histogram and borders are read from it. ``hot`` is what
    ``hot_keys`` found, where it was asked for several windows at once; keys that it
    lacks are one group each. No keys are one key.
    """
    names, base = df.columns, df if of is None else of
    if not keys:
        one = {"_one": F.lit(1)}
        placed = ordered_windows(
            df.withColumns(one), ["_one"], order, value, previous=previous, moving=moving,
            running=running, position=position, of=base.withColumns(one), hot_rows=hot_rows,
        )
        return placed.drop("_one")
    keys, depth = list(keys), moving[1] if moving else (1 if previous else 0)
    order = [(o, "asc") if isinstance(o, str) else o for o in order]
    key = _sort_key(base, order)
    found = (hot or hot_keys(base, [keys], hot_rows))[tuple(keys)]
    total = [*order, ("_tie", "asc")]
    tie = F.xxhash64(*[F.col(c) for c in base.columns])
    rows = df.withColumn("_tie", tie)
    if found is not None:
        borders = materialise(_borders(base.withColumn("_tie", tie), found, keys, key), "borders")
        tree = materialise(_tree(borders, keys), "tree")
        # whole rows, stored: one plan less holds the tree, and rows are sliced once
        rows = materialise(_with_slices(rows, tree, keys, key, "left"), "sliced")
        cut = join_null_safe(rows, F.broadcast(found.select(*keys)), keys)
        edges = materialise(_edges(cut, keys, total, value, depth), "edges")
    group = keys if found is None else [*keys, "_slice"]

    w = W.partitionBy(*group).orderBy(*_sort_columns(total))
    local = {}
    if position or (found is not None and (previous or moving)):
        local["_rn"] = F.row_number().over(w)
    if running:
        local["_run"] = F.sum(value).over(w.rowsBetween(W.unboundedPreceding, 0))
    if previous:
        local["_prev"] = F.lag(value, 1).over(w)
    if moving:
        frame = w.rowsBetween(-depth, 0)
        local["_msum"] = F.sum(value).over(frame)
        local["_mcnt"] = F.count(value).over(frame)
    rows = rows.withColumns(local)
    if found is not None:
        rows = _joined_edges(rows, edges, keys, value, depth, local)

    out = []
    if previous:
        out.append(F.col("_prev").alias(previous))
    if moving:
        mean = F.try_divide(F.col("_msum").cast("double"), F.col("_mcnt"))
        out.append(mean.alias(moving[0]))
    if running:
        out.append(F.col("_run").alias(running))
    if position:
        out.append(F.col("_rn").cast("bigint").alias(position))
    return rows.select(*names, *out)


def _joined_edges(
    rows: DataFrame, edges: DataFrame, keys: list[str], value: str, depth: int, local: dict
) -> DataFrame:
    """Add to the columns of ``local`` what comes from earlier slices."""
    joined = join_null_safe(rows, F.broadcast(edges), ["_slice", *keys], "left")
    done = {}
    if "_prev" in local:
        done["_prev"] = F.when(F.col("_rn") == 1, F.get("_tail", F.lit(0))).otherwise(F.col("_prev"))
    if "_msum" in local:
        missing = F.greatest(F.lit(depth + 1) - F.col("_rn"), F.lit(0))
        known = F.filter(F.slice("_tail", F.lit(1), missing), lambda x: x.isNotNull())
        use = (missing > 0) & F.col("_tail").isNotNull()
        added = F.when(use, F.aggregate(known, F.lit(0.0), lambda a, x: a + x))
        sums = F.coalesce(F.col("_msum").cast("double"), F.lit(0.0)) + F.coalesce(added, F.lit(0.0))
        counts = F.col("_mcnt") + F.coalesce(F.when(use, F.size(known)), F.lit(0))
        done["_msum"], done["_mcnt"] = F.when(counts > 0, sums), counts
    if "_run" in local:
        done["_run"] = F.when(F.col("_sum0").isNull(), F.col("_run")).otherwise(
            F.coalesce(F.col("_run"), F.lit(0)) + F.col("_sum0")
        )
    if "_rn" in local:
        done["_rn"] = F.col("_rn") + F.coalesce(F.col("_pos0"), F.lit(0))
    return joined.withColumns(done)


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """All rows with their 0-based place in ``order``, which should be total.

    Sorted parts are stored, each numbered on its own; one row per part tells how many
    rows are before it.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    kept = materialise(
        parts.withColumns(
            {"_part": F.shiftright(place, 33), "_nth": place.bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "numbered",
    )
    earlier = W.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    placed = kept.join(F.broadcast(bases), "_part")  # a row per stored part
    return placed.select(*df.columns, (F.col("_base") + F.col("_nth")).alias(name))


# --- ranks -------------------------------------------------------------------

def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    descending: bool = False,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per distinct (keys, value): its rank and percent rank.

    Columns added: ``n`` rows with that value, ``cum`` rows up to and including
    it, ``total`` rows of the key, ``rank`` and ``pct_rank`` as the window
    functions define them. Equal values are merged before the ordered step, so
    only distinct values are sorted, and ties cannot build up in one task.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    order = [(value, "desc" if descending else "asc")]
    if keys and hot is None:
        hot = hot_keys(df, [keys], hot_rows)  # a key has no more values than rows
    if keys and hot[tuple(keys)] is not None:
        counts = materialise(counts, "values")  # read for borders, slices, ranks and totals
    ranked = ordered_windows(
        counts, keys, order, "n", running="cum", hot=hot if keys else None, hot_rows=hot_rows
    )
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    if keys and hot[tuple(keys)] is None:  # the rows of a key are together already
        ranked = ranked.withColumn("total", F.sum("n").over(W.partitionBy(*keys)))
    elif keys:
        ranked = join_null_safe(ranked, totals, keys)
    else:
        ranked = ranked.withColumn("total", totals.scalar())
    rank = F.col("cum") - F.col("n") + 1
    return ranked.withColumn("rank", rank).withColumn(
        "pct_rank", F.when(F.col("total") > 1, (rank - 1) / (F.col("total") - 1)).otherwise(0.0)
    )


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    *,
    limit: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """RANK by ``value`` descending inside ``keys``; ``limit`` keeps ranks up to it.

    With a limit, Spark trims each input partition before the shuffle.
    """
    if limit is not None:
        return join_null_safe(df, top_ranks(df, keys, value, name, limit), [*keys, value])
    ranks = value_ranks(df, keys, value, descending=True, hot_rows=hot_rows)
    return join_null_safe(
        df, ranks.select(*keys, value, F.col("rank").alias(name)), [*keys, value]
    )


def top_ranks(
    df: DataFrame, keys: Sequence[str], value: str, name: str, limit: int
) -> DataFrame:
    """(keys, value, rank) for ranks up to ``limit``: the ``limit`` largest values suffice."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(*keys).orderBy(F.col(value).desc())
    top = counts.withColumn("_d", F.row_number().over(w)).filter(F.col("_d") <= limit).drop("_d")
    above = F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1))
    return (
        top.withColumn(name, F.coalesce(above, F.lit(0)) + 1)
        .filter(F.col(name) <= limit)
        .drop("n")
    )


def with_percent_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    *,
    of: DataFrame | None = None,
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """PERCENT_RANK by ``value`` ascending inside ``keys``.

    ``of`` ranks against another frame (the whole table) than the rows returned.
    """
    ranks = value_ranks(df if of is None else of, keys, value, hot=hot, hot_rows=hot_rows)
    return join_null_safe(
        df, ranks.select(*keys, value, F.col("pct_rank").alias(name)), [*keys, value]
    )


# --- quantiles ---------------------------------------------------------------

#: Ranges of values between a number and its double; and parts of a range beyond that.
_RANGES, _PARTS = 1024, 65_536


def _range_of(value: Column) -> Column:
    """The range a number lies in: never falls as the number rises.

    NaN is above all numbers, as Spark sorts it.
    """
    wide = value.cast("double")
    found = F.floor(F.signum(wide) * F.log1p(F.abs(wide)) * (_RANGES / math.log(2)))
    return F.when(F.isnan(wide), F.lit((1 << 63) - 1)).otherwise(found)


def _part_of(value: Column, low: Column, high: Column) -> Column:
    """Which of ``_PARTS`` equal parts between two numbers a number lies in."""
    width = high.cast("double") - low.cast("double")
    share = (value.cast("double") - low.cast("double")) / width
    usable = (width > 0) & (width < float("inf"))
    return F.when(usable, F.floor(share * _PARTS)).otherwise(F.lit(0).cast("bigint"))


def _wanted(
    counts: DataFrame, group: list[str], place: str, wants: Column, carried: list[str]
) -> DataFrame:
    """Rows of ``counts`` that hold a wanted position, counted from their own first row.

    ``counts`` has ``_n`` rows per ``place`` of a group, ``wants`` are positions in the
    group.
    """
    by = W.partitionBy(*group) if group else W.partitionBy(F.lit(1))
    upto = F.sum("_n").over(by.orderBy(place).rowsBetween(W.unboundedPreceding, 0))
    placed = counts.withColumns({"_last": upto, "_total": F.sum("_n").over(by)})
    first = F.col("_last") - F.col("_n")
    here = F.filter(wants, lambda w: (w["_k"] >= first) & (w["_k"] < F.col("_last")))
    moved = F.transform(
        here,
        lambda w: F.struct(w["_q"].alias("_q"), (w["_k"] - first).alias("_k"), w["_part"].alias("_part")),
    )
    return placed.select(*group, place, moved.alias("_wants"), *carried).where(
        F.size("_wants") > 0
    )


def _pinned(targets: DataFrame, keys: list[str]) -> DataFrame:
    """Found once, before the next pass: a few rows per quantile and key."""
    if keys:
        return materialise(targets, "targets")
    return F.broadcast(targets.sparkSession.createDataFrame(targets.collect(), targets.schema))


def _largest(targets: DataFrame) -> int:
    """Rows in the largest target that has more than one value."""
    several = targets.where(F.col("_low") < F.col("_high"))
    return several.agg(F.coalesce(F.max("_n"), F.lit(0))).first()[0]


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    named: dict[str, float],
    *,
    interpolate: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact quantiles of numbers per key, one column per entry of ``named``.

    Discrete (a value that occurs) or linearly interpolated. NULLs are ignored. A first
    pass counts rows by range of values, about a thousand for each doubling, and finds
    the ranges that quantiles fall in; while such a range has more than ``hot_rows`` rows,
    a pass cuts it into equal parts; the last one counts single values there. Counts are
    combined before they are shuffled, and no group's rows are sorted or gathered.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    rows = rows.withColumn("_range", _range_of(F.col("_v")))

    def position(q: int, k: Column, part: Column) -> Column:
        return F.struct(F.lit(q).alias("_q"), k.cast("bigint").alias("_k"), part.alias("_part"))

    total, wants = F.col("_total"), []
    for i, p in enumerate(named.values()):
        if interpolate:
            h = (total - 1) * F.lit(p)
            wants.append(position(2 * i, F.floor(h), h - F.floor(h)))
            wants.append(position(2 * i + 1, F.ceil(h), h - F.floor(h)))
        else:
            k = F.greatest(F.ceil(total * F.lit(p)), F.lit(1)) - 1
            wants.append(position(2 * i, k, F.lit(0.0)))

    ends = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    counts = rows.groupBy(*keys, "_range").agg(*ends)
    on, carried, most = ["_range"], ["_low", "_high", "_n"], math.inf
    targets = _pinned(_wanted(counts, keys, "_range", F.array(*wants), carried), keys)
    while hot_rows < (largest := _largest(targets)) < most:
        most, piece = largest, f"_piece{len(on)}"
        near = targets.select(*keys, *on, "_low", "_high")
        inside = join_null_safe(rows, near, [*keys, *on])
        rows = inside.withColumn(piece, _part_of(*[F.col(c) for c in ("_v", "_low", "_high")]))
        rows = rows.drop("_low", "_high")
        counts = rows.groupBy(*keys, *on, piece).agg(*ends)
        counts = join_null_safe(counts, targets.select(*keys, *on, "_wants"), [*keys, *on])
        targets = _wanted(counts, [*keys, *on], piece, F.col("_wants"), carried)
        targets, on = _pinned(targets, keys), [*on, piece]
    inside = join_null_safe(rows, targets.select(*keys, *on), [*keys, *on])
    values = inside.groupBy(*keys, *on, "_v").agg(F.count(F.lit(1)).alias("_n"))
    values = join_null_safe(values, targets.select(*keys, *on, "_wants"), [*keys, *on])
    hits = _wanted(values, [*keys, *on], "_v", F.col("_wants"), [])
    found = hits.select(*keys, "_v", F.inline("_wants"))

    def at(q: int) -> Column:
        return F.max(F.when(F.col("_q") == q, F.col("_v")))

    aggs = []
    for i, name in enumerate(named):
        if interpolate:
            part = F.max(F.when(F.col("_q") == 2 * i, F.col("_part")))
            aggs.append((at(2 * i) + (at(2 * i + 1) - at(2 * i)) * part).alias(name))
        else:
            aggs.append(at(2 * i).alias(name))
    return found.groupBy(*keys).agg(*aggs)


def approx_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    named: dict[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """The sketch-based counterpart of ``exact_quantiles``."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, p, accuracy).alias(n) for n, p in named.items()]
    )
