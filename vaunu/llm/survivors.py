"""Problem 7: the best representative of each group of duplicate records, field by field.

Every field is decided by weighted token votes. Texts are aligned token by token, progressively: each
spelling, nearest to the heaviest one first, is aligned with the profile of those before it; each
column of the profile goes to the token with most weight, and the existing value closest to that
consensus survives. A number is a single token; for a list of records the tokens are record ids, which
have no order: equal ids align, and the consensus holds every id voted for. There the rows have an order
of trust, and each outweighs all less trusted ones together (``elect``).

Groups never meet in one task: equal values are combined first, also on the map side, and votes are
summed. Spellings of a group are aligned in blocks of about ``BLOCK``; the profiles of several blocks
share the columns of the heaviest spelling, which is in each, and meet by these.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaunu.session import materialize

BLOCK = 32
GAP, CASE, OTHER = 2, 1, 3


def _fit(column: dict[str, float], token: str) -> int:
    """What it costs to put a token into a column: nothing if it is there, little if in other case."""
    return 0 if token in column else CASE if token.casefold() in {t.casefold() for t in column} else OTHER


def align(profile: list[dict[str, float]], tokens: list[str]) -> tuple[int, list[int]]:
    """The least cost of a global alignment, and where each token goes: column ``i``, or ``-1 - i`` for a new one before it."""
    n, m = len(profile), len(tokens)
    cost = [[GAP * (i + j) for j in range(m + 1)] for i in range(n + 1)]
    fits = [[_fit(c, t) for t in tokens] for c in profile]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + fits[i - 1][j - 1], cost[i - 1][j] + GAP, cost[i][j - 1] + GAP)
    placed, i, j = [], n, m
    while j:
        if i and cost[i][j] == cost[i - 1][j - 1] + fits[i - 1][j - 1]:
            i, j = i - 1, j - 1
            placed.append(i)
        elif cost[i][j] == cost[i][j - 1] + GAP:
            j -= 1
            placed.append(-1 - i)
        else:
            i -= 1
    return cost[n][m], placed[::-1]


def progressive(centre: str, spellings: list[tuple[str, float]]) -> list[tuple[int, int, str, float]]:
    """``slot, nth, token, weight`` of the profile of all spellings.

    Slot 2i+1 is the centre's token i, slot 2i the gap before it, whose new columns ``nth`` counts. The
    guide order is the distance to the centre; the centre itself opens the profile without a weight.
    """
    first = centre.split(" ")
    columns: list[tuple[int, dict[str, float]]] = [(2 * i + 1, {t: 0}) for i, t in enumerate(first)]
    bare = [{t: 0} for t in first]
    for _, value, weight in sorted((align(bare, v.split(" "))[0], v, w) for v, w in spellings):
        tokens = value.split(" ")
        _, places = align([c for _, c in columns], tokens)
        fresh: list[tuple[int, int, dict[str, float]]] = []
        for nth, (at, token) in enumerate(zip(places, tokens)):
            if at >= 0:
                columns[at][1][token] = columns[at][1].get(token, 0) + weight
            else:
                fresh.append((-1 - at, nth, {token: weight}))
        for at, _, column in reversed(fresh):
            slot = columns[at][0] // 2 * 2 if at < len(columns) else 2 * len(first)
            columns.insert(at, (slot, column))
    out, seen = [], {}
    for slot, column in columns:
        nth = seen.get(slot, 0)
        seen[slot] = nth + 1
        out += [(slot, nth, token, weight) for token, weight in column.items() if weight > 0]
    return out


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, centre, spellings in zip(batch["key"], batch["centre"], batch["spellings"]):
            rows += [(key, *vote) for vote in progressive(centre, [(s["value"], s["weight"]) for s in spellings])]
        yield pd.DataFrame(rows, columns=["key", "slot", "nth", "token", "weight"])


def text_consensus(df: DataFrame, key: str, column: str, weight: Column) -> DataFrame:
    """``key, value``: for each key the existing value of ``column`` closest to the token consensus.

    Null and blank values don't vote; a key without others has no row. Weights are summed over equal
    values, ``weight`` must be above 0. Ties: nearest, then heaviest, then first in code-point order.
    """
    spelled = (
        df.where(F.trim(F.col(column)) != "")
        .groupBy(F.col(key).alias("key"), F.col(column).alias("value"))
        .agg(F.sum(weight.cast("double")).alias("weight"))
    )
    centres = spelled.groupBy("key").agg(
        F.max(F.struct("weight", "value"))["value"].alias("centre"), F.sum("weight").alias("all"), F.count(F.lit(1)).alias("n")
    )
    single = centres.where("n = 1").select("key", F.col("centre").alias("value"))
    several = spelled.join(centres.where("n > 1"), "key")
    block = F.pmod(F.xxhash64("value"), F.ceil(F.col("n") / BLOCK))
    votes = (
        several.groupBy("key", "centre", block.alias("block"))
        .agg(F.collect_list(F.struct("value", "weight")).alias("spellings"))
        .select("key", "centre", "spellings")
        .mapInPandas(_votes, "key string, slot int, nth int, token string, weight double")
        .groupBy("key", "slot", "nth", "token")
        .agg(F.sum("weight").alias("weight"))
        .groupBy("key", "slot", "nth")
        .agg(F.max(F.struct("weight", "token")).alias("best"), F.sum("weight").alias("cast"))
    )
    kept = (
        votes.join(centres.select("key", "all"), "key")
        .where(F.col("cast") * 2 > F.col("all"))  # else most rows have nothing there
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "nth", F.col("best.token").alias("token")))).alias("slots"))
        .select("key", F.array_join(F.transform("slots", lambda s: s["token"]), " ").alias("consensus"))
    )
    closest = (
        several.join(kept, "key", "left")
        .groupBy("key")
        .agg(
            F.min(F.struct(F.levenshtein("value", F.coalesce("consensus", "centre")), -F.col("weight"), "value"))["value"].alias("value")
        )
    )
    return single.unionByName(closest)


def ballot(centre: list[str], spellings: list[tuple[list[str], int, int]]) -> list[tuple[str, str, int, int]]:
    """``column, token, trust, no``: the token votes of a block's values, each with the most trusted row that cast one.

    A row outweighs all less trusted ones together, so weights are powers of two, summed over the aligned
    values; the highest bit of a sum is its most trusted row, by which sums of other blocks compare too.
    Tokens ``slot=token`` are aligned progressively; others are names of things, unordered, and a column
    holds one of them.
    """
    order = sorted(spellings, key=lambda s: s[1:])
    weighted = [(tokens, 1 << (len(order) - 1 - i)) for i, (tokens, _, _) in enumerate(order)]
    if any("=" in t for t in centre):
        votes = [(f"{slot} {nth}", token, weight) for slot, nth, token, weight in progressive(" ".join(centre), [(" ".join(t), w) for t, w in weighted])]
    else:
        sums: dict[str, int] = {}
        for tokens, weight in weighted:
            for token in tokens:
                sums[token] = sums.get(token, 0) + weight
        votes = [(token, token, weight) for token, weight in sums.items()]
    return [(column, token, *order[len(order) - weight.bit_length()][1:]) for column, token, weight in votes]


def _ballots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, field, centre, spellings in zip(batch["key"], batch["field"], batch["centre"], batch["spellings"]):
            rows += [(key, field, *vote) for vote in ballot(list(centre), [(list(s["tokens"]), int(s["trust"]), int(s["no"])) for s in spellings])]
        yield pd.DataFrame(rows, columns=["key", "field", "column", "token", "trust", "no"])


def elect(values: DataFrame) -> DataFrame:
    """``key, field, no``: for each key and field the row whose value is closest to the consensus of the token votes.

    ``values`` has ``key, field, tokens, trust, no``: distinct tokens of a row's value, and its trust, the
    smaller the better. The values of a group are aligned in blocks and vote by :func:`ballot`; each column
    goes to its heaviest token, and these are the consensus. The distance to it counts tokens to put in or
    take out: those of the value and of the consensus less twice those in both. Ties go to the more trusted
    row, then to the smallest ``no``.
    """
    group, best = ["key", "field"], F.min(F.struct("trust", "no")).alias("best")
    spelled = values.groupBy(*group, F.array_sort("tokens").alias("tokens")).agg(best)
    groups = spelled.groupBy(*group).agg(F.min(F.struct("best", "tokens")).alias("first"), F.count(F.lit(1)).alias("n"))
    single = groups.where("n = 1").select(*group, F.col("first.best.no").alias("no"))
    several = spelled.join(groups.where("n > 1").select(*group, F.col("first.tokens").alias("centre"), "n"), group)
    block = F.pmod(F.xxhash64("tokens"), F.ceil(F.col("n") / BLOCK))
    elected = (
        several.groupBy(*group, "centre", block.alias("block"))
        .agg(F.collect_list(F.struct("tokens", "best.trust", "best.no")).alias("spellings"))
        .select(*group, "centre", "spellings")
        .mapInPandas(_ballots, "key string, field string, column string, token string, trust long, no long")
        .groupBy(*group, "column", "token")
        .agg(best)
        .groupBy(*group, "column")
        .agg(F.min(F.struct("best", "token"))["token"].alias("token"))
        .select(*group, "token", F.lit(1).alias("hit"))
    )
    cells = several.select(*group, "tokens", "best", F.explode("tokens").alias("token"))
    near = cells.join(elected, [*group, "token"], "left").groupBy(*group, "tokens").agg((F.count(F.lit(1)) - 2 * F.count("hit")).alias("distance"), F.min("best").alias("best"))
    return single.unionByName(near.groupBy(*group).agg(F.min(F.struct("distance", "best"))["best"]["no"].alias("no")))


def field_winners(df: DataFrame) -> DataFrame:
    """``id, n_rows`` and, of each id on several rows, the ``item_no`` whose co2, registered_count and source_records survive.

    * ``co2_no``: the most trusted (lowest ``source_rank``, null last) row with co2 above 0, else null.
    * ``count_no``: the latest (``updated_at``, null last) row with a registered_count, else null.
    * ``records_no``: the row whose source_records lack fewest ids of the group's, then the latest.

    All three come from :func:`elect`. Ties go to the smallest item_no. Rows with a null id are no group.
    """
    late = F.coalesce(-F.unix_micros("updated_at"), F.lit(2**62))
    trust = F.coalesce(F.col("source_rank").cast("long"), F.lit(2**62))
    # ids are compared as hashes of fixed length; every list holds the token "list" as well
    hashed = F.transform(F.array_distinct(F.array_compact(F.col("source_records")["id"])), lambda i: F.hex(F.xxhash64(i)))
    ids = F.concat(F.array(F.lit("list")), F.coalesce(hashed, F.array().cast("array<string>")))
    groups = df.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")

    def vote(field: str, tokens: Column, weight: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), tokens.alias("tokens"), weight.alias("trust"))

    def single(field: str, value: Column) -> Column:
        return F.array(F.concat(F.lit(f"{field}="), value.cast("string")))

    votes = F.array(
        F.when(F.col("co2") > 0, vote("co2", single("co2", F.col("co2")), trust)),
        F.when(F.col("registered_count").isNotNull(), vote("count", single("count", F.col("registered_count")), late)),
        vote("records", ids, late),
    )
    repeated = df.select(F.col("id").alias("key"), F.col("item_no").alias("no"), votes.alias("votes")).join(groups.select(F.col("id").alias("key")), "key", "left_semi")
    values = repeated.select("key", "no", F.explode(F.array_compact("votes")).alias("v")).select("key", "no", "v.*")
    fields = F.map_from_entries(F.collect_list(F.struct("field", "no")))
    chosen = elect(values).groupBy(F.col("key").alias("id")).agg(fields.alias("f"))
    return groups.join(chosen, "id").select(
        "id", "n_rows", *[F.try_element_at("f", F.lit(f)).alias(f"{f}_no") for f in ("co2", "count", "records")]
    )


def survivors(df: DataFrame) -> DataFrame:
    """One record for each id on more than one row: its winning numbers and records, and consensus texts."""
    winners = materialize(field_winners(df))
    repeated = df.join(winners.select("id"), "id", "left_semi")
    weight = F.lit(1.0) / F.greatest(F.coalesce("source_rank", F.lit(99)), F.lit(1))
    out = winners
    for column in ("brand", "model", "variant"):
        text = text_consensus(repeated, "id", column, weight).withColumnsRenamed({"key": "id", "value": column})
        out = out.join(text, "id", "left")
    for column, no in (("co2", "co2_no"), ("registered_count", "count_no"), ("source_records", "records_no")):
        out = out.join(repeated.select(F.col("item_no").alias(no), column), no, "left")
    return out
