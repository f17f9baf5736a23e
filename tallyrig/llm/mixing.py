"""Mixing sources to target shares of tokens."""

from __future__ import annotations

import base64
import heapq
import math
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyrig.session import written

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: how the byte-level vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens in a block, and in a shard of one source.
BLOCK_TOKENS, SHARD_TOKENS = 512, 4_000_000
#: More sources than this are refused, never cut off.
MOST_SOURCES = 1_000


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = "byte_bpe_50k.tiktoken") -> Column:
    """Tokens of the whole text; null counts none.

    The vocabulary is read from ``tokenizer_dir`` on the driver and sent along
    to the executors, which need no such folder.
    """
    path = Path(tokenizer_dir) / vocabulary
    if not path.is_file():
        raise FileNotFoundError(f"no vocabulary {vocabulary} in {tokenizer_dir}; give the folder as tokenizer_dir")
    SparkSession.active().sparkContext.addFile(str(path))

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(SparkFiles.get(vocabulary)).encode_ordinary
        return texts.map(lambda t: 0 if t is None else len(encode(t))).astype("int64")

    return count(text)


def apportion(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Sainte-Lague: ``seats`` go one by one to the highest quotient ``weight / (2 * given + 1)``.

    None gets more than its cap; seats beyond all caps are not given.  Ties go
    to the earlier.  All but the last few seats are given at once: with divisor
    ``d`` a weight has earned ``floor(weight / d + 1/2)`` seats, and a divisor a
    little too large gives none that the one-by-one rule would not give.
    """
    n = len(weights)
    caps = [seats] * n if caps is None else caps
    total = float(sum(w for w, c in zip(weights, caps) if c > 0))
    given = [0] * n
    if seats <= 0 or total <= 0:
        return given
    low, high = 0.0, 4.0 * total  # a divisor of `high` earns at most a seat in all
    earned = lambda d: [min(c, int(w / d + 0.5)) if w > 0 else 0 for w, c in zip(weights, caps)]
    for _ in range(200):
        middle = (low + high) / 2
        if middle > 0 and sum(earned(middle)) <= seats:
            high = middle
        else:
            low = middle
    given = earned(high)
    heap = [(-w / (2 * g + 1), i) for i, (w, g, c) in enumerate(zip(weights, given, caps)) if w > 0 and g < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * given[i] + 1), i))
    return given


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    tokens: str,
    id_column: str = "doc_id",
    source: str = "source",
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    seed: int = 0,
    total_tokens: int | None = None,
) -> DataFrame:
    """How often each document is used so that sources reach their target shares.

    ``documents`` has ``id_column``, ``source`` and ``tokens``; ``targets`` has
    ``source, target_share, max_repeats``, a row for each source.  Result:
    ``id_column, source, tokens, block, repeats`` with a row for each document used.

    Documents are dealt to shards by a seeded hash and, within shard and source,
    ordered by another and cut into blocks of equal tokens.  Blocks are apportioned
    to sources by Sainte-Lague quotients of the target shares, a source's blocks
    to its shards by quotients of their tokens, in two steps where there are
    many: to shelves of shards, then within each shelf.  Each shard then uses all
    its blocks equally often and a seeded choice of them once more.  Shards do not
    grow with the data, their number does, and shelves and shards a shelf with its
    square root; their quotas are found and stay on the executors.  A source is never
    used more than ``max_repeats`` times.  The size of the mix is ``total_tokens``,
    by default the largest that all target shares allow.

    What reaches the driver is one row a source.  Null ids, sources without a
    target, and documents without tokens are not used; repeated rows count once; a source without
    documents gets nothing and its share is lost.  Empty tables give no rows.
    """
    wanted = targets.groupBy("source").agg(F.max("target_share"), F.max("max_repeats")).limit(MOST_SOURCES + 1).collect()
    if len(wanted) > MOST_SOURCES:
        raise ValueError(f"a mix has at most {MOST_SOURCES} sources")
    goal = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in wanted if r[0] is not None}
    taken = (
        documents.select(F.col(id_column).alias("id"), F.col(source).alias("source"), F.col(tokens).cast("long").alias("tokens"))
        .filter(F.col("id").isNotNull() & (F.col("tokens") > 0) & F.col("source").isin(*goal))
        .groupBy("id")
        .agg(F.min("source").alias("source"), F.max("tokens").alias("tokens"))
    )
    taken = written(taken)
    sums = {r[0]: r[1] for r in taken.groupBy("source").agg(F.sum("tokens")).collect()}
    # Each source has shards of its own number, so that even those of a small source hold many blocks.
    shards = {s: max(1, int(n) // shard_tokens) for s, n in sums.items()}
    of = lambda numbers: F.element_at(F.create_map(*[F.lit(x) for s, n in (numbers or {"": 1}).items() for x in (s, n)]), F.col("source"))
    shelf = F.col("shard") % of({s: math.isqrt(n) for s, n in shards.items()})
    taken = taken.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(seed)), of(shards)))

    held = F.col("held")
    stock = taken.groupBy("source", "shard").agg(F.sum("tokens").alias("held"))
    stock = written(
        stock.withColumn("blocks", F.greatest(F.lit(1), F.floor(held / block_tokens + 0.5))).withColumn("shelf", shelf)
    )
    whole = {r[0]: r[1] for r in stock.groupBy("source").agg(F.sum("blocks")).collect()}
    plenty = [goal[s][1] * n / goal[s][0] for s, n in sums.items() if goal[s][0] > 0]
    size = total_tokens if total_tokens is not None else (min(plenty) if plenty else 0)
    names = sorted(s for s in sums if goal[s][0] > 0 and goal[s][1] > 0)
    caps = [goal[s][1] * whole[s] for s in names]
    seats = dict(zip(names, apportion([goal[s][0] for s in names], int(size / block_tokens + 0.5), caps)))

    def shelve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shelf")
        source = part["source"].iloc[0]
        most = [int(b) * goal[source][1] for b in part["blocks"]]
        return part[["source", "shelf"]].assign(seats=apportion(part["held"].tolist(), seats.get(source, 0), most))

    def deal(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        most = [int(b) * goal[part["source"].iloc[0]][1] for b in part["blocks"]]
        given = pd.Series(apportion(part["held"].tolist(), int(part["seats"].iloc[0]), most), index=part.index)
        return part[["source", "shard", "held", "blocks"]].assign(every=given // part["blocks"], extra=given % part["blocks"])

    quotas = stock.groupBy("source", "shelf").agg(F.sum("held").alias("held"), F.sum("blocks").alias("blocks"))
    quotas = quotas.groupBy("source").applyInPandas(shelve, "source string, shelf long, seats long").filter("seats > 0")
    plan = stock.join(quotas, ["source", "shelf"]).groupBy("source", "shelf")
    plan = plan.applyInPandas(deal, "source string, shard long, held long, blocks long, every long, extra long")

    before = Window.partitionBy("source", "shard").orderBy("spot", "id").rowsBetween(Window.unboundedPreceding, -1)
    dealt = taken.withColumn("spot", F.xxhash64("id", F.lit(seed + 1))).withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    turn = F.pmod(F.col("block") + F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), F.col("blocks")), F.col("blocks"))
    return (
        dealt.join(plan, ["source", "shard"])
        .withColumn("block", F.floor(F.col("before") * F.col("blocks") / held))
        .withColumn("repeats", F.col("every") + F.when(turn < F.col("extra"), 1).otherwise(0))
        .filter("repeats > 0")
        .select(F.col("id").alias(id_column), "source", "tokens", F.concat_ws("/", "source", "shard", "block").alias("block"), "repeats")
    )


def mix_shares(mix: DataFrame, targets: DataFrame, available: DataFrame) -> DataFrame:
    """The shares a mix reached: one row for each target source.

    Result: ``source, target_share, max_repeats, available_tokens, mixed_tokens,
    actual_share, most_repeats``.  Sources not used have zeros.
    """
    used = mix.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("most_repeats")
    )
    total = used.agg(F.sum("mixed_tokens").alias("__all"))
    there = available.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    # One row of totals; bounded by its definition.
    return (
        targets.join(there, "source", "left")
        .join(used, "source", "left")
        .join(F.broadcast(total), F.lit(True), "left")
        .select(
            "source",
            "target_share",
            "max_repeats",
            zero("available_tokens"),
            zero("mixed_tokens"),
            F.round(F.coalesce(F.col("mixed_tokens") / F.col("__all"), F.lit(0.0)), 6).alias("actual_share"),
            zero("most_repeats"),
        )
    )
