"""Problem 4: records of two sources without a shared key, matched by several noisy attributes.

Sorted neighbourhood over several composite keys: both codes as written and reversed, approval serial
with mass, and maker with power and mass. Rows of all keys are range-partitioned and sorted together;
records at most ``WINDOW`` rows apart that share the key's block become candidate pairs. Pairs at
partition edges are added from the edge rows. Equal records are collapsed before, so a hot record
can't fill a window. Equal keys are sorted by mass or co2; where more rows than a window reaches share
a code, or an approval or a maker and power within a band of mass, exact joins on that and each
further attribute add the pairs the window misses. A pair's score is the sum of weights of evidence over the attributes that both
have, its confidence the logistic of that.

Assignment: a record of the left source may take several of the right one, a right record at most one
left. Under these bounds each right record's best item maximises the total confidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaunu.session import materialize

WINDOW = 12
#: Width of a band of mass in a hot run: masses of one version differ by at most this.
BAND = 20
#: Least score of a match; the evidence of one exact code and one agreeing figure is above it.
LEAST = 6.0
FEATURES = ["va", "ve", "serial", "ext", "maker", "name", "fuel", "co2", "mass", "power"]
#: Legal forms that don't tell makers apart.
LEGAL = r"\b(oyj?|ab|ag|gmbh|ltd|inc|llc|kft|a/s|s\.?p\.?a|s\.?r\.?l|d\.?o\.?o|motor\s+co(mpany)?|co|corp)\b\.?"
ACCENTED, PLAIN = "äåáàâãéèêëöóòôõøüúùûíìîïçñß", "aaaaaaeeeeoooooouuuuiiiicns"


def code(column: Column) -> Column:
    """A code in capital letters and figures, letters that are mistaken for figures as those; blank is null."""
    plain = F.translate(F.regexp_replace(F.upper(column), "[^A-Z0-9]", ""), "OQILSZB", "0011528")
    return F.when(plain != "", plain)


def words(column: Column) -> Column:
    """A name without accents, legal forms, spaces and signs; ``ae``, ``oe``, ``ue`` count as the vowel."""
    plain = F.translate(F.regexp_replace(F.lower(column), LEGAL, " "), ACCENTED, PLAIN)
    plain = F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]", ""), "(?<=[aou])e", "")
    return F.when(plain != "", plain)


def serial(column: Column) -> Column:
    found = F.regexp_extract(column, r"(?:^|\D)(\d{5,6})(?:\D|$)", 1)
    return F.when(found != "", found)


def extension(column: Column) -> Column:
    found = F.regexp_extract(column, r"\d{5,6}\D+(\d{2})\s*$", 1)
    return F.when(found != "", found)


def item_features(items: DataFrame) -> DataFrame:
    """``id`` and FEATURES of catalogue items; unknown figures are null."""
    power = F.regexp_extract("variant", r"(?i)(\d{1,4}(?:[.,]\d+)?)\s*kw", 1)
    return items.select(
        F.col("item_no").cast("long").alias("id"),
        code(F.col("variant_code")).alias("va"),
        code(F.col("version_code")).alias("ve"),
        serial(F.col("type_approval")).alias("serial"),
        extension(F.col("type_approval")).alias("ext"),
        words(F.col("brand")).alias("maker"),
        words(F.col("model")).alias("name"),
        F.lower("powertrain").alias("fuel"),
        F.when((F.col("co2") > 0) | (F.col("powertrain") == "electric"), F.col("co2").cast("double")).alias("co2"),
        F.when(F.col("mass") > 0, F.col("mass").cast("double")).alias("mass"),
        F.replace(power, F.lit(","), F.lit(".")).try_cast("double").alias("power"),
    )


def candidate_features(candidates: DataFrame) -> DataFrame:
    """``id`` and FEATURES of official records."""
    return candidates.select(
        F.col("cand_id").cast("long").alias("id"),
        code(F.col("va")).alias("va"),
        code(F.col("ve")).alias("ve"),
        serial(F.col("tan")).alias("serial"),
        extension(F.col("tan")).alias("ext"),
        words(F.col("mk")).alias("maker"),
        words(F.col("cn")).alias("name"),
        F.when(F.lower("ft") == "petrol/electric", "phev").otherwise(F.lower("ft")).alias("fuel"),
        F.col("ewltp_g_km").alias("co2"),
        F.when(F.col("m_kg") > 0, F.col("m_kg")).alias("mass"),
        F.when(F.col("ep_kw") > 0, F.col("ep_kw")).alias("power"),
    )


def _keys() -> Column:
    """The sort keys of a record, each with its block: only records of one block are paired."""
    mass = F.lpad(F.col("mass").cast("int").cast("string"), 6, "0")

    def entry(kind: int, block: Column, key: Column) -> Column:
        tie = F.col("mass" if kind < 5 else "co2").cast("int")
        return F.struct(F.lit(kind).alias("kind"), block.alias("block"), key.alias("key"), tie.alias("tie"))

    def coded(kind: int, text: Column) -> Column:
        return entry(kind, F.substring(text, 1, 4), text)

    levels = F.array(F.floor("power"), F.ceil("power"))
    by_power = F.transform(
        F.array_distinct(levels),
        lambda p: entry(6, F.concat_ws("|", F.substring("maker", 1, 4), p.cast("string")), F.concat_ws("|", F.substring("maker", 1, 4), p.cast("string"), mass)),
    )
    several = F.array(
        coded(1, F.col("va")),
        coded(2, F.reverse("va")),
        coded(3, F.col("ve")),
        coded(4, F.reverse("ve")),
        entry(5, F.col("serial"), F.concat_ws("|", "serial", mass)),
    )
    known = F.filter(several, lambda e: e["block"].isNotNull())
    return F.when(F.col("maker").isNotNull() & F.col("power").isNotNull(), F.concat(known, by_power)).otherwise(known)


def _window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (block, id, right) rows in; pairs within the window, and the rows at both partition edges."""
    schema = ["left_id", "right_id", "part", "place", "block"]
    part, total = TaskContext.get().partitionId(), 0
    head: list[tuple[int, int]] = []
    block, ids = np.empty(0, np.int64), np.empty(0, np.int64)
    right = np.empty(0, bool)
    for batch in batches:
        fresh = batch.num_rows
        if not fresh:
            continue
        old = len(ids)
        block = np.concatenate([block, batch.column(0).to_numpy(zero_copy_only=False)])
        ids = np.concatenate([ids, batch.column(1).to_numpy(zero_copy_only=False)])
        right = np.concatenate([right, batch.column(2).to_numpy(zero_copy_only=False)])
        lefts, rights = [], []
        for gap in range(1, min(WINDOW, len(ids) - 1) + 1):
            first = max(0, old - gap)
            a, b = slice(first, len(ids) - gap), slice(first + gap, len(ids))
            hit = (block[a] == block[b]) & (right[a] != right[b])
            x, y, swapped = ids[a][hit], ids[b][hit], right[a][hit]
            lefts.append(np.where(swapped, y, x))
            rights.append(np.where(swapped, x, y))
        if lefts:
            pairs = np.unique(np.stack([np.concatenate(lefts), np.concatenate(rights)], axis=1), axis=0)
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, none], names=schema)
        if total < WINDOW:
            head += [(total + i + 1, old + i) for i in range(min(fresh, WINDOW - total))]
            yield _edge(head[-min(fresh, WINDOW - total) :], ids, right, block, part, schema)
        total += fresh
        block, ids, right = block[-WINDOW:], ids[-WINDOW:], right[-WINDOW:]
    if total:
        yield _edge([(-i, len(ids) - i) for i in range(1, len(ids) + 1)], ids, right, block, part, schema)


def _edge(rows: list[tuple[int, int]], ids: np.ndarray, right: np.ndarray, block: np.ndarray, part: int, names: list[str]) -> pa.RecordBatch:
    at = np.array([i for _, i in rows], dtype=np.int64)
    own, other = ids[at], right[at]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own, mask=other), pa.array(own, mask=~other), pa.array(np.full(len(at), part, np.int64)),
            pa.array(np.array([p for p, _ in rows], dtype=np.int64)), pa.array(block[at]),
        ],
        names=names,
    )


def neighbours(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct ``left_id, right_id`` of records near each other under any key, or in a hot run (:func:`hot_pairs`)."""
    both = left.withColumn("right", F.lit(False)).unionByName(right.withColumn("right", F.lit(True)))
    entries = both.select("id", "right", F.explode(_keys()).alias("e")).select("id", "right", "e.*")
    ordered = (
        entries.repartitionByRange("kind", "key", "tie", "id")
        .sortWithinPartitions("kind", "key", "tie", "id")
        .select(F.xxhash64("kind", "block").alias("block"), "id", "right")
    )
    scanned = materialize(ordered.mapInArrow(_window, "left_id long, right_id long, part long, place long, block long"))
    inner = scanned.where("part is null").select("left_id", "right_id")
    edges = scanned.where("part is not null")  # 2 * WINDOW rows a partition at most
    parts = edges.select("part").distinct()
    # one row a partition: the next partition that has rows
    following = parts.select(F.col("part").alias("tail_part"), F.lead("part").over(Window.orderBy("part")).alias("head_part"))
    tails = edges.where("place < 0").select(F.col("part").alias("tail_part"), F.col("place").alias("t"), "block", F.col("left_id").alias("l1"), F.col("right_id").alias("r1"))
    heads = edges.where("place > 0").select(F.col("part").alias("head_part"), F.col("place").alias("h"), "block", F.col("left_id").alias("l2"), F.col("right_id").alias("r2"))
    across = (
        tails.join(following, "tail_part")
        .join(heads, ["head_part", "block"])
        .where((F.col("h") - F.col("t") - 1 <= WINDOW) & (F.col("l1").isNull() != F.col("l2").isNull()))
        .select(F.coalesce("l1", "l2").alias("left_id"), F.coalesce("r1", "r2").alias("right_id"))
    )
    return inner.unionByName(across).unionByName(hot_pairs(left, right)).distinct()


def _cells() -> Column:
    """``kind, run, band`` of each run a record is in: a code, or a block of keys 5 and 6 with a band of mass."""

    def cell(kind: int, run: Column, band: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.when(run.isNotNull(), F.xxhash64(F.lit(kind), run)).alias("run"), band.cast("int").alias("band"))

    band = F.floor(F.col("mass") / BAND)
    by_power = F.transform(F.array_distinct(F.array(F.floor("power"), F.ceil("power"))), lambda p: cell(6, F.concat(F.substring("maker", 1, 4), F.lit("|"), p.cast("string")), band))
    cells = F.concat(F.array(cell(1, F.col("va"), F.lit(0)), cell(3, F.col("ve"), F.lit(0)), cell(5, F.col("serial"), band)), by_power)
    return F.filter(cells, lambda c: c["run"].isNotNull() & c["band"].isNotNull())


def _composites(right: bool) -> Column:
    """Hashes of a hot run with each further attribute. Figures are cut into bands; a right record takes the bands next to its own too."""

    def bands(name: str, width: int, reach: int) -> Column:
        own = F.floor(F.col(name) / width).cast("int")
        return F.when(own.isNull(), F.array().cast("array<int>")).otherwise(F.array(*[own + d for d in (range(-reach, reach + 1) if right else (0,))]))

    def text(name: str) -> Column:
        return F.when(F.col(name).isNull(), F.array().cast("array<string>")).otherwise(F.array(F.col(name)))

    def crossed(kind: int, a: Column, b: Column, unless: int = 0) -> Column:
        keys = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.xxhash64(F.lit(kind), F.col("run"), x, y))))
        return F.when(F.col("kind") == unless, F.array().cast("array<bigint>")).otherwise(keys)

    mass, co2, power = bands("mass", BAND, 1), bands("co2", 4, 1), bands("power", 1, 2)
    return F.concat(
        crossed(1, mass, text("va"), 1), crossed(2, mass, text("ve"), 3), crossed(3, mass, text("serial"), 5), crossed(4, mass, co2),
        crossed(5, mass, power, 6), crossed(6, mass, text("name")),
        # without mass, where both codes agree
        F.when(F.col("kind") == 1, F.concat(*[F.flatten(F.transform(text("ve"), lambda v: crossed(k, F.array(v), fig))) for k, fig in ((7, co2), (8, power))])).otherwise(F.array().cast("array<bigint>")),
    )


def hot_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left_id, right_id`` (repeated) of records in one run longer than the window reaches that agree in a further attribute.

    A run of equal codes is hot beyond ``WINDOW`` rows, a band of mass and those next to it beyond half
    of that, as rows between two records may fill two bands.
    """
    both = left.select("id", _cells().alias("cells")).withColumn("right", F.lit(False)).unionByName(right.select("id", _cells().alias("cells")).withColumn("right", F.lit(True)))
    cells = both.select("id", "right", F.explode("cells").alias("c")).select("id", "right", "c.*")
    long = F.col("n") > F.when(F.col("kind") < 5, WINDOW + 1).otherwise(WINDOW // 2)
    counts = cells.groupBy("kind", "run", "band").agg(F.count(F.lit(1)).alias("n"))
    around = F.when(F.col("kind") < 5, F.array("band")).otherwise(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    hot = materialize(counts.where(long).select("run", F.explode(around).alias("band")).distinct())
    members = cells.join(hot, ["run", "band"], "left_semi").select("id", "right", "kind", "run").distinct()

    def keyed(side: DataFrame, is_right: bool) -> DataFrame:
        mine = members.where(F.col("right") == is_right).select("id", "kind", "run")
        return mine.join(side, "id").select(F.col("id").alias("right_id" if is_right else "left_id"), F.explode(_composites(is_right)).alias("composite"))

    return keyed(left, False).join(keyed(right, True), "composite").select("left_id", "right_id")


def _codes(a: Column, b: Column) -> Column:
    edits = F.levenshtein(a, b)
    return (
        F.when(a.isNull() | b.isNull(), 0.0)
        .when((a == b) | (F.concat(a, F.lit("00")) == b) | (F.concat(b, F.lit("00")) == a), 6.0)
        .when((edits == 1) & (F.greatest(F.length(a), F.length(b)) >= 5), 4.0)
        .when((edits == 2) & (F.greatest(F.length(a), F.length(b)) >= 8), 1.0)
        .otherwise(-6.0)
    )


def _near(a: Column, b: Column, close: float, far: float) -> Column:
    gap = F.abs(a - b)
    return F.when(gap.isNull(), 0.0).when(gap <= close, 2.0).when(gap <= far, -0.5).otherwise(-4.0)


def score() -> Column:
    """Sum of weights of evidence between ``l_*`` and ``r_*``; an attribute that either lacks gives 0."""

    def of(name: str) -> tuple[Column, Column]:
        return F.col(f"l_{name}"), F.col(f"r_{name}")

    s1, s2 = of("serial")
    approval = F.when(s1.isNull() | s2.isNull(), 0.0).when(s1 == s2, 3.0).when(F.levenshtein(s1, s2) == 1, 1.5).otherwise(-4.0)
    e1, e2 = of("ext")
    extensions = F.when(e1.isNull() | e2.isNull(), 0.0).when(e1 == e2, 0.5).otherwise(-0.5)
    f1, f2 = of("fuel")
    hybrid = (f1 == "hybrid") & f2.isin("petrol", "diesel")
    fuels = F.when(f1.isNull() | f2.isNull(), 0.0).when((f1 == f2) | hybrid, 0.5).otherwise(-3.0)

    def named(name: str) -> Column:
        a, b = of(name)
        longest = F.greatest(F.length(a), F.length(b))
        alike = (F.levenshtein(a, b) <= F.greatest(F.lit(1), F.floor(longest / 4))) | a.startswith(b) | b.startswith(a)
        return F.when(a.isNull() | b.isNull(), 0.0).when(alike, 1.0).otherwise(-1.0)

    return (
        _codes(*of("va")) + _codes(*of("ve")) + approval + extensions + fuels + named("maker") + named("name")
        + _near(*of("co2"), 4, 10) + _near(*of("mass"), 20, 60) + _near(*of("power"), 1.01, 3)
    )


def _collapse(features: DataFrame) -> DataFrame:
    return features.groupBy(*FEATURES).agg(F.min("id").alias("id"))


def match(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """``item_no, cand_id, confidence``: each right record that has a left one, with the best of these.

    ``items`` and ``candidates`` are :func:`item_features` and :func:`candidate_features`. Any feature
    may be null; records without any code, serial, or maker with power are never matched. Ties go to
    the smaller item. Equal items count as the one with the smallest id. Empty tables give no rows.
    """
    left = materialize(_collapse(items))
    whole = materialize(candidates)
    right = _collapse(whole)
    pairs = neighbours(left, right)
    l_side = left.select(F.col("id").alias("left_id"), *[F.col(f).alias(f"l_{f}") for f in FEATURES])
    r_side = right.select(F.col("id").alias("right_id"), *[F.col(f).alias(f"r_{f}") for f in FEATURES])
    best = (
        pairs.join(r_side, "right_id")
        .join(l_side, "left_id")
        .select("left_id", "right_id", score().alias("score"))
        .where(F.col("score") >= LEAST)
        .groupBy("right_id")
        .agg(F.min(F.struct(-F.col("score"), "left_id")).alias("b"))
        .select("right_id", F.col("b.left_id").alias("item_no"), F.round(1 / (1 + F.exp(F.col("b.col1") / 3)), 6).alias("confidence"))
    )
    # back from each collapsed record to all that are equal to it
    same = [F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in FEATURES]
    matched = right.join(best, F.col("id") == F.col("right_id")).drop("id", "right_id")
    on = same[0]
    for s in same[1:]:
        on = on & s
    return whole.alias("a").join(matched.alias("b"), on).select("item_no", F.col("a.id").alias("cand_id"), "confidence")
