"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix has as many words as all documents together. Sources in code-point order, null
last, weigh ``WEIGHTS`` in turn; a source's target is its share by weight, at most
``REPEATS`` times its own words, and what it cannot take is shared again among the rest.

The mix is cut into blocks of ``BLOCK`` words. Blocks go one by one to the source with
the highest quotient target / (2 s - 1) at its s-th block, and in the same way from the
source to its shards, documents dealt out by a seeded digest. A shard is its documents
laid end to end in the order of that digest. Its quota is met by whole rounds over the
shard and a run of further blocks from a seeded start, so that all but the documents at
the two ends of the run are taken whole.

Sainte-Laguë needs no loop over blocks: each source's number of blocks is known up to
about one by division, and only the quotients in question are ranked. Everything is
built-in expressions; only words per source and per shard are ever brought together.

Null texts have no words. Documents without words are in no shard and take nothing.
Null ids share one place in the order; rows alike in id and size are interchangeable.
No documents, or none with words: targets and words taken are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.llm.common import GAP, ROW, WORD, settle, text_of, with_row

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 16
#: Words of a shard; a large source has as many shards as it needs.
SHARD = 1 << 20
SEED = "mix-1"

ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def number_of(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """Words of each document."""
    return with_row(
        docs,
        F.col("doc_id"),
        F.col("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Rank, size, weight and target of each source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    turn = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = ranked.withColumn(
        "weight", F.get(turn, (F.col("rank") - 1) % len(WEIGHTS)).cast("bigint")
    ).withColumn("most", REPEATS * F.col("source_size"))
    # Sources that reach their limit first come first; the level is what is left by then.
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(*ALL)
    left = weighed.select(
        "*",
        (
            F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
        ).alias("words_left"),
        (
            F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        ).alias("weight_left"),
    )
    full = F.col("most").cast("decimal(20,0)") * F.col("weight_left").cast("decimal(12,0)") <= F.col(
        "words_left"
    ).cast("decimal(20,0)") * F.col("weight").cast("decimal(12,0)")
    open_ = F.col("full") == F.lit(False)
    level = left.withColumn("full", full)
    words = F.max(F.when(open_, F.col("words_left"))).over(whole)
    weight = F.max(F.when(open_, F.col("weight_left"))).over(whole)
    share = (F.col("weight") * words).cast("double") / weight.cast("double")
    return level.select(
        "source",
        "rank",
        "source_size",
        "weight",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def apportion(parties: DataFrame, votes: str, seats: str, by: list[str], order: str) -> DataFrame:
    """``parties`` with ``quota``: the seats each gets by the highest quotients.

    ``by`` names the column of the election that a party is in (none: a single one);
    ``seats`` holds its number of seats, alike in all its parties. Ties go to the lower
    ``order``.
    """
    within = Window.partitionBy(*by)
    total = F.sum(votes).over(within.rowsBetween(*ALL))
    running = F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(within.rowsBetween(*ALL))
    known = parties.select("*", total.alias("all_votes"), (running / F.lit(2.0)).alias("slack"))
    # Rounding at a divisor that hands out too few seats gives seats that are certain,
    # at one that hands out too many those that are possible.
    few = F.floor(F.col(votes) * (F.col(seats) - F.col("slack")) / F.col("all_votes") + F.lit(0.5))
    many = F.floor(F.col(votes) * (F.col(seats) + F.col("slack")) / F.col("all_votes") + F.lit(1.5))
    some = F.col(votes) > 0
    sure = known.withColumn(
        "sure",
        F.when(some & (F.col(seats) > F.col("slack")), few).otherwise(0).cast("bigint"),
    ).withColumn("may", F.when(some, many).otherwise(0).cast("bigint"))
    rest = sure.withColumn(
        "rest", F.col(seats) - F.sum("sure").over(within.rowsBetween(*ALL))
    )
    # Places 1 up to may - sure stand for the quotients in question; place 0 for the party.
    asked = rest.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("may") - F.col("sure"))))
    quotient = F.when(
        F.col("place") > 0,
        F.col(votes) / (2 * (F.col("sure") + F.col("place")) - 1).cast("double"),
    )
    best = within.orderBy(F.col("quotient").desc_nulls_last(), order)
    won = (F.col("place") > 0) & (F.row_number().over(best) <= F.col("rest"))
    return (
        asked.withColumn("quotient", quotient)
        .withColumn("won", won.cast("bigint"))
        .groupBy(*parties.columns)
        .agg((F.first("sure") + F.sum("won")).alias("quota"))
    )


def mix(
    docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD, seed: str = SEED
) -> DataFrame:
    """Each row of ``docs`` by its key with size, target and the words that the mix takes.

    ``rounds`` is how often it is taken whole, ``from1`` to ``to1`` and ``from2`` to
    ``to2`` are the ranges of words taken besides (empty where from >= to).
    """
    sizes = settle(sized(docs), "mix-sizes")
    goals = targets(sizes)
    whole = Window.rowsBetween(*ALL)
    seats = F.floor(F.sum("source_size").over(whole) / block + F.lit(0.5)).cast("bigint")
    sources = settle(
        apportion(goals.withColumn("seats", seats), "target", "seats", [], "rank"), "mix-sources"
    )

    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    shards = F.ceil(F.col("source_size") / shard_words)
    here = sizes.withColumnRenamed("source", "own_source")
    placed = (
        here.join(sources, F.col("own_source").eqNullSafe(F.col("source")))
        .withColumn("draw", draw)
        .withColumn(
            "shard", F.when(F.col("size") > 0, number_of(F.col("draw")) % F.greatest(shards, F.lit(1)))
        )
    )
    shard_sizes = (
        placed.filter("size > 0")
        .groupBy("rank", "shard", "quota")
        .agg(F.sum("size").alias("shard_size"))
        .withColumnRenamed("quota", "seats")
    )
    start = F.md5(F.concat_ws("|", F.lit(seed), F.col("rank"), F.col("shard")))
    n_blocks = F.ceil(F.col("shard_size") / block)
    quotas = settle(
        apportion(
            shard_sizes.withColumn("votes", F.col("shard_size").cast("double")),
            "votes", "seats", ["rank"], "shard",
        )
        .withColumn("blocks", n_blocks)
        .withColumn("words", F.least(block * F.col("quota"), REPEATS * F.col("shard_size")))
        .select(
            F.col("rank").alias("of_rank"),
            F.col("shard").alias("of_shard"),
            F.floor(F.col("words") / F.col("shard_size")).alias("rounds"),
            F.floor((F.col("words") % F.col("shard_size")) / block + F.lit(0.5)).alias("more"),
            (number_of(start) % F.col("blocks")).alias("first"),
            F.col("blocks"),
        ),
        "mix-quotas",
    )

    laid = Window.partitionBy("rank", "shard").orderBy("draw", "doc_id", "size", *ROW)
    ends = F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    columns = ["doc_id", *ROW, "size", "source_size", "target"]
    run_end = F.col("first") + F.col("more")
    low, high = block * F.col("first"), block * F.least(run_end, F.col("blocks"))
    again = block * F.greatest(run_end - F.col("blocks"), F.lit(0))
    taking = (
        placed.filter("size > 0")
        .withColumn("ends", ends)
        .withColumn("starts", F.col("ends") - F.col("size"))
        .join(quotas, (F.col("rank") == F.col("of_rank")) & (F.col("shard") == F.col("of_shard")))
        .select(
            *columns,
            "rounds",
            F.greatest(low - F.col("starts"), F.lit(0)).alias("from1"),
            F.least(high - F.col("starts"), F.col("size")).alias("to1"),
            F.lit(0).cast("bigint").alias("from2"),
            F.least(again - F.col("starts"), F.col("size")).alias("to2"),
        )
    )
    zero = F.lit(0).cast("bigint")
    wordless = placed.filter("size = 0").select(
        *columns, *[zero.alias(n) for n in ("rounds", "from1", "to1", "from2", "to2")]
    )
    parts = F.greatest(F.col("to1") - F.col("from1"), zero) + F.greatest(
        F.col("to2") - F.col("from2"), zero
    )
    return taking.unionByName(wordless).withColumn(
        "taken", F.col("rounds") * F.col("size") + parts
    )


def mixed(docs: DataFrame, **options: int | str) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken, cut to the words taken.

    A document cut short has its words joined by one space; ``n_chars`` follows the text.
    """
    names = docs.columns
    drawn = mix(docs, **options).filter("taken > 0")
    piece = lambda a, b: F.when(
        F.col(b) > F.col(a), F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")))
    ).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    rounds = F.array_repeat(
        F.struct(F.lit(0).cast("bigint").alias("a"), F.col("size").alias("b")),
        F.col("rounds").cast("int"),
    )
    pieces = drawn.select(
        *ROW,
        "size",
        F.explode(F.concat(rounds, piece("from1", "to1"), piece("from2", "to2"))).alias("p"),
    )
    rows = with_row(docs, F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    words = F.split(F.regexp_replace(F.col("row.text"), f"^{GAP}", ""), GAP)
    cut = F.array_join(
        F.slice(words, F.col("p.a").cast("int") + 1, (F.col("p.b") - F.col("p.a")).cast("int")), " "
    )
    whole = (F.col("p.a") == 0) & (F.col("p.b") == F.col("size"))
    taken = rows.join(pieces, ROW).select(
        "row", F.when(whole, F.col("row.text")).otherwise(cut).alias("taken_text")
    )
    value = {
        "text": F.col("taken_text"),
        "n_chars": F.length("taken_text").cast("bigint"),
    }
    return taken.select(*[value.get(n, F.col(f"row.`{n}`")).alias(n) for n in names])
