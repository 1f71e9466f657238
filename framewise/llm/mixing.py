"""Mixing sources to target weights by temperature. DataFrame operations only.

A source's weight is its share of all tokens to the power of an exponent from 0 (all alike) to 1 (as
they are), normalised. The exponent is found by repeated sectioning, weights become budgets of tokens,
and budgets are met by permutations of each source's blocks, one for each time it is gone through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.columns import pack_row, whole_text, without
from framewise.settings import write_through

#: Exponents are multiples of one part in so many.
GRID = 10_000
#: Parts that one step of the search tries.
_SECTIONS = 10
#: Blocks of a source, as hexadecimal digits of a hash of the key: 4,096 blocks.
_BLOCK_DIGITS = 3


#: What counts as a token where no tokenizer has counted: a word, a number, or any other visible character.
TOKEN = r"\p{L}+|\p{N}+|[^\x09-\x0D\x20\p{L}\p{N}]"

#: A plan for more blocks than this, of all sources together, is joined by a shuffle instead of being sent to every task
#: (some hundred bytes for each).
PLAN_ROWS = 200_000


def text_tokens(text: str = "text") -> Column:
    """The tokens of a text by ``TOKEN``, at least 1."""
    return F.greatest(F.lit(1), F.regexp_count(whole_text(text), F.lit(TOKEN))).cast("long")


def _search(shares: DataFrame, entropy: float, repeats: float) -> int:
    """The exponent, in parts of ``GRID``.

    Entropy falls and repetition rises as the exponent moves away from its bound, so both
    conditions hold on one side of a border each. Each step tries a few exponents in one
    aggregation over the sources, of which a few numbers come to the driver, however many sources
    there are.
    """

    def tried(parts: list[int]) -> dict[int, tuple[float, float]]:
        a = F.col("part") / GRID
        rows = shares.select("share", F.explode(F.array(*map(F.lit, parts))).alias("part"))
        power = F.exp(a * F.ln("share"))
        found = rows.groupBy("part").agg(
            F.sum(power).alias("z"),
            F.sum(power * F.ln("share")).alias("s"),
            F.max("share").alias("most"),
            F.min("share").alias("least"),
            F.count("*").alias("n"),
        )
        level = (F.ln("z") - a * F.col("s") / F.col("z")) / F.ln("n")
        level = F.when(F.col("n") > 1, level).otherwise(1.0)
        times = F.exp((1 - a) * F.ln(F.col("most") / F.col("least")))
        found = found.select("part", level.alias("level"), times.alias("times"))
        return {r["part"]: (r["level"], r["times"]) for r in found.collect()}

    def border(low: int, high: int, fits) -> int:
        """The last part in ``[low, high]`` up to which ``fits``; ``low`` if none does."""
        while high > low:
            step = max(1, (high - low) // _SECTIONS)
            parts = sorted({*range(low, high, step), high})
            found = tried(parts)
            if not found:
                return GRID
            good = [p for p in parts if fits(*found[p])]
            if not good:
                return low
            low = max(good)
            high = min([p for p in parts if p > low], default=low)
            if high - low <= 1:
                return low
        return low

    flat = border(0, GRID, lambda level, _: level >= entropy - 1e-12)
    # Repetition falls with the exponent: the first part at which it is within the limit.
    first = border(0, GRID, lambda _, times: times > repeats + 1e-12)
    within = {p: t for p, (_, t) in tried([first, min(first + 1, GRID)]).items()}
    limited = first if within.get(first, 0) <= repeats + 1e-12 else min(first + 1, GRID)
    return max(flat, limited)


def source_weights(
    docs: DataFrame,
    source: str = "source",
    tokens: Column | None = None,
    entropy: float = 0.98,
    repeats: float = 4.0,
    budget: int | None = None,
) -> DataFrame:
    """For each source: _source, tokens, share, weight, budget (tokens to draw), exponent.

    Weights are as close to the shares as they can be with a normalised entropy (1: all alike) of at
    least ``entropy``; but if a source were then gone through more than ``repeats`` times as often as
    the largest one, the exponent is raised to where it isn't. Without a ``budget`` the draw is as
    long as it takes to use every source once in whole.
    """
    amount = F.coalesce(tokens if tokens is not None else text_tokens(), F.lit(0)).cast("long")
    sized = docs.select(F.col(source).alias("_source"), amount.alias("tokens"))
    counted = write_through(sized.groupBy("_source").agg(F.sum("tokens").alias("tokens")), "sources")
    counted = counted.where(F.col("tokens") > 0)
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    shares = counted.withColumn("share", F.col("tokens") / F.lit(total))
    part = _search(shares, entropy, repeats) if total else GRID
    power = F.exp(F.lit(part) / GRID * F.ln("share"))
    norm = shares.agg(F.sum(power)).first()[0] or 1.0
    weighted = shares.withColumn("weight", power / norm)
    if budget is None:
        length = weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
        target = F.greatest(F.round(F.lit(length) * F.col("weight")).cast("long"), F.col("tokens"))
    else:
        target = F.round(F.lit(float(budget)) * F.col("weight")).cast("long")
    return weighted.withColumns({"budget": target, "exponent": F.lit(part) / GRID})


def _order(*columns) -> Column:
    """A permutation's sort key: any two engines agree on it."""
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) if isinstance(c, str) else c for c in columns]))


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    tokens: Column | None = None,
    entropy: float = 0.98,
    repeats: float = 4.0,
    budget: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The drawn rows of ``docs`` with ``epoch``, ``block`` and ``place``.

    Each source is gone through in whole as often as its budget has room for, and once more as far as
    the budget goes. Each time the source's blocks (by a hash of ``key``) stand in a new order; of
    the block in which the budget ends, documents are drawn in the order of another hash, as long as
    they fit. ``place`` runs from 0 to 1 over a source's draw: sorted by it, sources interleave in
    their target weights.

    A null source is a source. Rows without a key form a block of their own in each source.
    Repeated rows are drawn alike, except in the block in which the budget ends, where only some may
    fit. A row counts at least one token by default, so an empty text has a place; with measures of
    0 throughout, a source is not drawn. Input columns with the three names are replaced, others
    pass through. An empty table gives an empty table.

    Blocks and budgets are summed before anything is ordered: windows run over the 4,096 blocks of a
    source, and over the documents of the one block in which a budget ends. Texts of any length are only counted.
    """
    docs = without(docs, "epoch", "block", "place")
    amount = F.coalesce(tokens if tokens is not None else text_tokens(), F.lit(0)).cast("long")
    weights = write_through(source_weights(docs, source, tokens, entropy, repeats, budget), "weights")
    seeded = F.lit(str(seed))
    block = F.conv(F.substring(_order(seeded, key), 1, _BLOCK_DIGITS), 16, 10).cast("int")
    rows = docs.select(
        pack_row(docs), F.col(source).alias("_source"), F.col(key).alias("_key"), amount.alias("_tokens"), block.alias("_block")
    )

    # Where each block of each time begins, in tokens.
    blocks = rows.groupBy("_source", "_block").agg(F.sum("_tokens").alias("filled"))
    plan = blocks.join(weights.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    times = F.explode(F.sequence(F.lit(0), F.expr("int((budget - 1) div tokens)")))
    plan = plan.where(F.col("budget") > 0).select("*", times.alias("_epoch"))
    turn = Window.partitionBy("_source", "_epoch").orderBy(_order(seeded, "_source", "_epoch", "_block"))
    ahead = F.coalesce(F.sum("filled").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = plan.withColumn("_before", ahead + F.col("_epoch") * F.col("tokens")).where(F.col("_before") < F.col("budget"))
    room = F.col("budget") - F.col("_before")
    plan = plan.select(
        F.col("_source").alias("_s"),
        F.col("_block").alias("_b"),
        "_epoch",
        "_before",
        "budget",
        F.when(room < F.col("filled"), room).alias("_room"),
    )
    # One row for each block of a source, 4,096 of them at most: where that is little, texts need not be shuffled to meet it.
    turns = F.collect_list(F.struct("_epoch", "_before", "_room"))
    plan = write_through(plan.groupBy("_s", "_b").agg(F.first("budget").alias("budget"), turns.alias("_turns")), "mix-plan")
    if plan.count() <= PLAN_ROWS:
        plan = F.broadcast(plan)

    drawn = rows.join(plan, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b"))).drop("_s", "_b")
    drawn = drawn.select("*", F.inline("_turns")).drop("_turns")
    whole = drawn.where(F.col("_room").isNull())
    within = Window.partitionBy("_source", "_block", "_epoch").orderBy(_order(seeded, "_key", "_epoch"), "_key", "_tokens")
    cut = drawn.where(F.col("_room").isNotNull())
    cut = cut.withColumn("_sum", F.sum("_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    drawn = whole.unionByName(cut.where(F.col("_sum") <= F.col("_room")).drop("_sum"))
    return drawn.select(
        *[F.col(f"_row.`{c}`") for c in docs.columns],
        F.col("_epoch").cast("int").alias("epoch"),
        F.col("_block").alias("block"),
        (F.col("_before") / F.col("budget")).alias("place"),
    )
