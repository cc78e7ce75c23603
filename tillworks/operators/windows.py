"""Ranking and running windows that spread one group over many tasks.

A plain window sends each group to one task: all rows for a global rank, a sixth of the rows
for a rank per product category, a third of them for one very busy user. Here the rows are cut
into parts by ranges of (group, order, tie), so a large group simply covers several parts. The
bounds of the ranges are taken once from a sample of fixed size and stand in the plan as values:
a row's part depends on the row alone, so it can be computed again, and one exchange by part
serves all windows of a pass. Each part computes its share of the window, and one small row per
part carries what the parts before it (or, for peers, after it) add. That carry table has as many
rows as there are parts, never more, which is what makes it safe to broadcast.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_NUMBER = "row_number"
RANK = "rank"
DENSE_RANK = "dense_rank"
RUNNING_TOTAL = "running_total"
LAG = "lag"
LEAD = "lead"
TOTAL = "total"
PEER_FUNCTIONS = {RANK, DENSE_RANK, RUNNING_TOTAL}

PART = "_part"
# Sampled rows per part, and parts at most unless the caller asks for more: the bounds are a tree
# of comparisons in the plan.
SAMPLED = 32
PARTS = 2048


def ascending(column: str) -> list[Column]:
    """Sort keys for an ascending column with nulls first."""
    return [F.col(column).isNotNull(), F.col(column)]


def descending(column: str) -> list[Column]:
    """Ascending sort keys that order a numeric column downwards, nulls last."""
    return [F.col(column).isNull(), -F.col(column)]


def _chained_sums(
    parts: DataFrame, order: Column, chains: Mapping[str, tuple[Column, Column, Column]]
) -> DataFrame:
    """Add up neighbours' amounts over chains of linked partitions.

    Each chain is (amount, linked, through): ``linked`` says that the neighbour's edge belongs
    to the same group as this partition's edge, ``through`` that the neighbour holds nothing
    else, so that the chain goes on past it.
    """
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps, sums, bases, results = {}, {}, {}, {}
    for name, (amount, linked, through) in chains.items():
        step, total, base = F.col(f"_step_{name}"), F.col(f"_sum_{name}"), F.col(f"_base_{name}")
        steps[f"_step_{name}"] = F.coalesce(F.when(linked, amount), F.lit(0))
        sums[f"_sum_{name}"] = F.sum(step).over(so_far)
        start = F.when(~(linked & through), total - step)
        bases[f"_base_{name}"] = F.last(start, ignorenulls=True).over(so_far)
        results[name] = total - base
    chained = parts.withColumns(steps).withColumns(sums).withColumns(bases).withColumns(results)
    return chained.drop(*steps, *sums, *bases)


def _carries(local: DataFrame, functions: set[str]) -> DataFrame:
    """One row per partition: what the rows in other partitions add to its edge groups."""

    def edge(flag: str, value: Column) -> Column:
        return F.max(F.when(F.col(flag), F.struct(value.alias("at"))))["at"]

    def tail(value: Column) -> Column:
        return edge("_is_last", value)

    def head(value: Column) -> Column:
        return edge("_is_first", value)

    row, rank, item = F.col("_row"), F.col("_rank"), F.col("_value")
    place = F.struct("_group", "_order")
    edges = {"head_group": head(F.col("_group")), "tail_group": tail(F.col("_group"))}
    if functions & PEER_FUNCTIONS:
        edges |= {"head_value": head(place), "tail_value": tail(place)}
    if functions & {ROW_NUMBER, RANK}:
        edges["tail_count"] = tail(row)
    if TOTAL in functions:
        edges["part_rows"] = tail(row)
    if RANK in functions:
        edges["tail_peers"] = tail(row - rank + 1)
    if DENSE_RANK in functions:
        edges["tail_dense"] = tail(F.col("_dense"))
    if RUNNING_TOTAL in functions:
        for name in ("sum", "filled"):
            column = F.col(f"_run_{name}")
            edges |= {f"head_{name}": head(column), f"tail_{name}": tail(column)}
    if LAG in functions:
        edges["tail_item"] = tail(item)
    if LEAD in functions:
        edges["head_item"] = head(item)
    parts = (
        local.filter(F.col("_is_first") | F.col("_is_last"))
        .groupBy(PART)
        .agg(*[value.alias(name) for name, value in edges.items()])
    )

    # A chain links each partition to its neighbour: first along the edge groups, then, where
    # peers matter, along the edge values.
    line = Window.orderBy(PART)

    def before(name: str) -> Column:
        return F.lag(name).over(line)

    def after(name: str) -> Column:
        return F.lead(name).over(line)

    def equal(one: Column, other: str, neighbour: Column) -> Column:
        return neighbour.isNotNull() & one.eqNullSafe(F.col(other))

    previous, following = before(PART), after(PART)
    links = {
        "same_group": equal(before("tail_group"), "head_group", previous),
        "one_group": F.col("head_group").eqNullSafe(F.col("tail_group")),
    }
    if LEAD in functions:
        links["next_same_group"] = equal(after("head_group"), "tail_group", following)
    if functions & PEER_FUNCTIONS:
        links |= {
            "same_value": equal(before("tail_value"), "head_value", previous),
            "next_same_value": equal(after("head_value"), "tail_value", following),
            "one_value": F.col("head_value").eqNullSafe(F.col("tail_value")),
        }
    parts = parts.withColumns(links)
    if DENSE_RANK in functions:
        # A value that began in an earlier partition is not a new one here.
        again = F.when(F.col("one_group") & F.col("same_value"), 1).otherwise(0)
        parts = parts.withColumn("tail_new", F.col("tail_dense") - again)

    flags = [c for c in ("one_group", "one_value") if c in parts.columns]
    tails = [c for c in parts.columns if c.startswith("tail_") and c[5:] not in ("group", "value")]
    heads = [c for c in parts.columns if c.startswith("head_") and c[5:] not in ("group", "value")]
    parts = parts.withColumns(
        {
            **{f"prev_{c}": F.coalesce(before(c), F.lit(False)) for c in flags},
            **{f"next_{c}": F.coalesce(after(c), F.lit(False)) for c in flags},
            **{f"prev_{c[5:]}": before(c) for c in tails},
            **{f"next_{c[5:]}": after(c) for c in heads},
        }
    )
    forward = {
        f"carry_{c[5:]}": (
            F.col(f"prev_{c[5:]}"),
            *(
                (F.col("same_value"), F.col("prev_one_value"))
                if c == "tail_peers"
                else (F.col("same_group"), F.col("prev_one_group"))
            ),
        )
        for c in tails
        if c in ("tail_count", "tail_peers", "tail_new", "tail_sum", "tail_filled")
    }
    backward = {
        f"ahead_{c[5:]}": (
            F.col(f"next_{c[5:]}"),
            F.col("next_same_value"),
            F.col("next_one_value"),
        )
        for c in heads
        if c in ("head_sum", "head_filled")
    }
    if forward:
        parts = _chained_sums(parts, F.col(PART).asc(), forward)
    if backward:
        parts = _chained_sums(parts, F.col(PART).desc(), backward)
    if TOTAL in functions:
        parts = parts.withColumn("all_rows", F.sum("part_rows").over(Window.partitionBy()))
    kept = ("head_group", "head_value", "tail_value", "same_group", "same_value", "all_rows",
            "next_same_group", "prev_item", "next_item", *forward, *backward)
    return parts.select(PART, *[c for c in kept if c in parts.columns])


def _bounds(df: DataFrame, keys: Sequence[Column], tie: Sequence[str], parts: int) -> list[Column]:
    """Up to ``parts - 1`` places of (group, order, tie) that cut the rows into like shares.

    One job: the rows with the smallest hashes of their unique key, ``SAMPLED`` per part, in order.
    """
    names = [f"k{i}" for i in range(len(keys))]
    keyed = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.xxhash64(*tie).alias("_drawn"))
    types = {f.name: f.dataType for f in keyed.schema}
    drawn = (
        keyed.orderBy("_drawn", *names)
        .limit(SAMPLED * parts)
        .orderBy(*names)
        .select(*[F.col(n).cast("string").alias(n) for n in names])
        .collect()
    )
    steps = [drawn[len(drawn) * i // parts] for i in range(1, parts)] if drawn else []
    return [
        F.struct(*[F.lit(row[n]).cast(types[n]).alias(n) for n in names])
        for row in dict.fromkeys(steps)
    ]


def _part(place: Column, bounds: Sequence[Column]) -> Column:
    """How many bounds the place has reached, by halving."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(place >= bounds[middle], between(middle + 1, high)).otherwise(
            between(low, middle)
        )

    return between(0, len(bounds))


def spread_window(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    tie: Sequence[str],
    outputs: Mapping[str, str],
    value: str | None = None,
    partitions: int | None = None,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Add window columns per group without ever holding a whole group in one task.

    ``order`` lists ascending sort keys (see ``ascending`` and ``descending``); rows with equal
    keys are peers for ``rank``, ``dense_rank`` and ``running_total``. ``tie`` is a unique key:
    it makes ``row_number``, ``lag`` and ``lead`` repeatable and lets a long run of peers be
    split. ``outputs`` maps new column names to the functions of this module. ``partitions`` is
    the number of parts, by default that of shuffle partitions, ``PARTS`` at most. The bounds are
    drawn from ``sampled`` where the same rows can be had there at less cost. ``TOTAL``, the number
    of all rows, is for the empty group.
    """
    if TOTAL in outputs.values() and group:
        raise ValueError("a total is of all rows: leave the group empty")
    functions = set(outputs.values())
    keyed = df.withColumns(
        {
            "_group": F.struct(*group) if group else F.struct(F.lit(0)),
            "_order": F.struct(*[key.alias(f"k{i}") for i, key in enumerate(order)]),
            "_tie": F.struct(*tie),
            "_value": F.col(value) if value else F.lit(None).cast("int"),
        }
    )
    keys = [*[F.col(c) for c in group], *order, *[F.col(c) for c in tie]]
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = df if sampled is None else sampled
    bounds = _bounds(source, keys, tie, partitions or min(default, PARTS))
    place = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    ranged = keyed.withColumn(PART, _part(place, bounds))

    in_part = Window.partitionBy(PART).orderBy("_group", "_order", "_tie")
    by_row = Window.partitionBy(PART, "_group").orderBy("_order", "_tie")
    peers = Window.partitionBy(PART, "_group").orderBy("_order")
    local = {
        "_is_first": F.lag(F.lit(1)).over(in_part).isNull(),
        "_is_last": F.lead(F.lit(1)).over(in_part).isNull(),
        "_row": F.row_number().over(by_row),
    }
    if LAG in functions:
        local["_lag"] = F.lag("_value").over(by_row)
    if LEAD in functions:
        local["_lead"] = F.lead("_value").over(by_row)
    if RANK in functions:
        local["_rank"] = F.rank().over(peers)
    if DENSE_RANK in functions:
        local["_dense"] = F.dense_rank().over(peers)
    if RUNNING_TOTAL in functions:
        local["_run_sum"] = F.sum("_value").over(peers)
        local["_run_filled"] = F.count("_value").over(peers)
    parted = ranged.withColumns(local).drop("_tie")

    rows = parted.join(F.broadcast(_carries(parted, functions)), PART, "left")
    zero = F.lit(0)
    carried = F.col("_group").eqNullSafe(F.col("head_group")) & F.col("same_group")

    def carry(name: str, when: Column) -> Column:
        return F.when(when, F.col(name)).otherwise(zero)

    def answer(function: str) -> Column:
        place = F.struct("_group", "_order")
        if function == ROW_NUMBER:
            return (F.col("_row") + carry("carry_count", carried)).cast("bigint")
        if function == RANK:
            at_head = place.eqNullSafe(F.col("head_value")) & F.col("same_value")
            earlier = carry("carry_count", carried) - carry("carry_peers", at_head)
            return (F.col("_rank") + earlier).cast("bigint")
        if function == DENSE_RANK:
            begun = F.when(carried & F.col("same_value"), 1).otherwise(0)
            return (F.col("_dense") + carry("carry_new", carried) - begun).cast("bigint")
        if function == RUNNING_TOTAL:
            # Null until the first value, as a running sum is.
            at_tail = place.eqNullSafe(F.col("tail_value"))
            filled = carry("carry_filled", carried) + carry("ahead_filled", at_tail)
            added = carry("carry_sum", carried) + carry("ahead_sum", at_tail)
            return F.when(
                F.col("_run_filled") + filled > 0, F.coalesce("_run_sum", zero) + added
            )
        if function == TOTAL:
            return F.col("all_rows").cast("bigint")
        if function == LAG:
            outside = carried & (F.col("_row") == 1)
            return F.when(outside, F.col("prev_item")).otherwise(F.col("_lag"))
        if function == LEAD:
            outside = F.col("_is_last") & F.col("next_same_group")
            return F.when(outside, F.col("next_item")).otherwise(F.col("_lead"))
        raise ValueError(f"no such window function: {function}")

    return rows.select(
        *[rows[c] for c in df.columns],
        *[answer(function).alias(name) for name, function in outputs.items()],
    )


def ntile(position: Column, total: Column, tiles: int) -> Column:
    """The tile of a row number out of ``total`` rows; the first tiles take the remainder."""
    small = F.floor(total / tiles)
    extra = total % tiles
    in_large = position <= extra * (small + 1)
    return (
        F.when(in_large, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(
            extra + F.floor((position - 1 - extra * (small + 1)) / F.greatest(small, F.lit(1))) + 1
        )
        .cast("int")
    )


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    tie: Sequence[str],
    rank: str,
    tile: str | None = None,
    tiles: int = 4,
    partitions: int | None = None,
) -> DataFrame:
    """Position of each row in the whole table and, on request, its ntile."""
    outputs = {rank: ROW_NUMBER} | ({"_rows": TOTAL} if tile else {})
    ranked = spread_window(df, [], order, tie, outputs=outputs, partitions=partitions)
    if tile is None:
        return ranked
    return ranked.withColumn(tile, ntile(F.col(rank), F.col("_rows"), tiles)).drop("_rows")


# The transaction windows


def user_sequence(enriched: DataFrame, partitions: int | None = None, **names: str) -> DataFrame:
    """Number, running total and neighbours of each user's transactions by date.

    The running total takes all transactions of a day at once (they are peers).
    """
    outputs = {
        "user_transaction_number": ROW_NUMBER,
        "user_running_total": RUNNING_TOTAL,
        "previous_transaction_amount": LAG,
        "next_transaction_amount": LEAD,
        **names,
    }
    return spread_window(
        enriched,
        ["user_id"],
        ascending("transaction_date"),
        ["transaction_id"],
        outputs,
        value="amount",
        partitions=partitions,
    )


def rank_in_category(
    enriched: DataFrame, partitions: int | None = None, sampled: DataFrame | None = None
) -> DataFrame:
    return spread_window(
        enriched,
        ["category"],
        descending("amount"),
        ["transaction_id"],
        {"category_sales_rank": RANK},
        partitions=partitions,
        sampled=sampled,
    )


def rank_in_month(
    enriched: DataFrame, partitions: int | None = None, sampled: DataFrame | None = None
) -> DataFrame:
    return spread_window(
        enriched,
        ["transaction_year_month"],
        descending("amount"),
        ["transaction_id"],
        {"monthly_transaction_rank": DENSE_RANK},
        partitions=partitions,
        sampled=sampled,
    )


def apply_window_functions(
    enriched: DataFrame,
    partitions: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """All six transaction windows; the bounds of every pass are drawn from the input.

    A pass reads its rows three times. ``keep`` stores what the passes before have given (and
    returns it as read again), so that none is computed twice.
    """
    rows = keep(user_sequence(enriched, partitions))
    rows = keep(rank_in_category(rows, partitions, sampled=enriched))
    return rank_in_month(rows, partitions, sampled=enriched)
