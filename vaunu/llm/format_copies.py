"""Problem 5: records that are equal but for formatting, collapsed with an exact copy count.

Canonical records are range-partitioned and externally sorted; each partition is then scanned once,
comparing the full keys of adjacent records. A group of any size may span partitions: only the runs
at partition edges (two a partition at most) are compared again, so no group ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaunu.session import materialize

#: A figure with its decimal marks, or a run of anything but figures, white space and punctuation.
PART = r"[0-9]+(?:[.,][0-9]+)*|[^0-9\s\x85\p{Z}\p{P}$+<=>^`|~]+"


def parts(column: Column) -> Column:
    """The parts of a text as written, in small letters, with a point as decimal mark.

    Figures and letters are parts of their own, so that ``3 ov`` and ``3ov`` agree. Null stays null.
    """
    found = F.regexp_extract_all(F.lower(F.upper(column)), F.lit(PART), F.lit(0))
    return F.transform(found, lambda p: F.replace(p, F.lit(","), F.lit(".")))


def canonical_parts(column: Column) -> Column:
    """The parts in one order: white space, case, punctuation and order no longer count."""
    return F.array_join(F.array_sort(parts(column)), " ")


def _joined(found: Column) -> Column:
    """The parts in written order without white space, but for that between two figures, which counts."""
    return F.regexp_replace(F.array_join(found, " "), "(?<![0-9]) | (?![0-9])", "")


def _splits(records: DataFrame, n: int) -> DataFrame:
    """``i, joined, finest``: for texts that differ by white space between letters, the finest split that any record has.

    Hashes find the joined spellings that have several splits; only those are then looked at as text.
    Both results are written, so that the planner knows their size and broadcasts them only if small.
    """
    cells = records.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"j{i}").alias("joined"), F.col(f"c{i}").alias("split")) for i in range(n)])).alias("x"))
    cells = cells.select("x.*").where(F.col("joined").isNotNull())
    hashed = cells.select("i", F.xxhash64("joined").alias("h"), F.xxhash64("split").alias("s"))
    several = materialize(hashed.groupBy("i", "h").agg(F.min("s").alias("a"), F.max("s").alias("b")).where("a != b").select("i", "h"))
    return materialize(
        cells.withColumn("h", F.xxhash64("joined"))
        .join(several, ["i", "h"], "left_semi")
        .groupBy("i", "joined")
        .agg(F.max(F.struct(F.length("split"), "split"))["split"].alias("finest"))
    )


def _resolve_joined(records: DataFrame, splits: DataFrame, i: int) -> DataFrame:
    """Give texts with one joined spelling (``GasBrix``, ``Gas Brix``) the same ``c{i}``."""
    own = splits.where(F.col("i") == i).select("joined", "finest")
    matched = records.join(own, F.col(f"j{i}") == F.col("joined"), "left")
    return matched.withColumn(f"c{i}", F.coalesce("finest", f"c{i}")).drop("joined", "finest", f"j{i}")


def _framed(column: Column, kind: T.DataType) -> Column:
    """A value as text with its length before it, so that joined values stay apart; null is ``-``."""
    text = F.to_json(column) if isinstance(kind, T.ArrayType | T.StructType | T.MapType) else column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _exact(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    return column + F.lit(0.0) if isinstance(kind, T.DoubleType | T.FloatType) else column


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, row) batches in; a row for each copy, and the first and last run of the partition."""
    last_key, last_first, first_run_open, edges = None, None, True, []
    seen = False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, rows = batch.column(0), batch.column(1)
        n = len(keys)
        same = pc.equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False) if n > 1 else []
        numbers = rows.to_numpy(zero_copy_only=False)
        firsts = numbers.copy()
        head = keys[0].as_py()
        current = last_first if seen and head == last_key else None
        if not seen:
            edges.append((head, int(numbers[0])))
        starts = [i + 1 for i, s in enumerate(same) if not s]
        bounds = [0, *starts, n]
        for i in range(len(bounds) - 1):
            firsts[bounds[i] : bounds[i + 1]] = current if i == 0 and current is not None else numbers[bounds[i]]
        seen, last_key, last_first = True, keys[n - 1].as_py(), int(firsts[-1])
        copies = firsts != numbers
        if copies.any():
            k = int(copies.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.string()), pa.array(firsts[copies], pa.int64()), pa.array(numbers[copies], pa.int64())],
                names=["edge_key", "run_first", "copy_row"],
            )
    if seen:
        edges.append((last_key, last_first))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in edges], pa.string()), pa.array([r for _, r in edges], pa.int64()), pa.nulls(2, pa.int64())],
            names=["edge_key", "run_first", "copy_row"],
        )


def format_copies(df: DataFrame, row: str, loose: list[str], ignore: list[str]) -> DataFrame:
    """``first_no, copy_no`` of each copy: ``first_no`` is the smallest ``row`` of its group.

    ``row`` is a unique long. Columns in ``loose`` agree up to formatting (:func:`canonical_parts`),
    those in ``ignore`` don't count, all others must be equal; null equals null, and NaN equals NaN.
    Rows with equal texts are copies too; rows with null ``loose`` columns are, if those are null in
    both. An empty table gives no rows. Whole texts count, of whatever length.
    """
    exact = [f for f in df.schema if f.name not in {row, *loose, *ignore}]
    rest = F.concat(F.lit(""), *[_framed(_exact(f.name, f.dataType), f.dataType) for f in exact])
    records = df.select(
        F.col(row).cast("long").alias("row"), rest.alias("rest"), *[parts(F.col(f"`{c}`")).alias(f"p{i}") for i, c in enumerate(loose)]
    )
    for i in range(len(loose)):
        records = records.withColumns({f"c{i}": F.array_join(F.array_sort(f"p{i}"), " "), f"j{i}": _joined(F.col(f"p{i}"))}).drop(f"p{i}")
    splits = _splits(records, len(loose))
    for i in range(len(loose)):
        records = _resolve_joined(records, splits, i)
    key = F.concat(*[_framed(F.col(f"c{i}"), T.StringType()) for i in range(len(loose))], "rest")
    records = records.select(key.alias("key"), "row")
    ordered = (
        records.withColumn("hash", F.xxhash64("key"))
        .repartitionByRange("hash", "key", "row")
        .sortWithinPartitions("hash", "key", "row")
        .select("key", "row")
    )
    scanned = materialize(ordered.mapInArrow(_scan, "edge_key string, run_first long, copy_row long"))
    edges = scanned.where(F.col("edge_key").isNotNull()).select("edge_key", "run_first").distinct()
    whole = edges.groupBy("edge_key").agg(F.min("run_first").alias("group_first"))
    # At most two rows a partition, however many records there are.
    moved = (
        edges.join(whole, "edge_key").where(F.col("run_first") != F.col("group_first")).select("run_first", "group_first")
    )
    copies = scanned.where(F.col("copy_row").isNotNull()).join(F.broadcast(moved), "run_first", "left")
    return copies.select(
        F.coalesce("group_first", "run_first").alias("first_no"), F.col("copy_row").alias("copy_no")
    ).unionByName(moved.select(F.col("group_first").alias("first_no"), F.col("run_first").alias("copy_no")))


def collapse(df: DataFrame, row: str, loose: list[str], ignore: list[str]) -> DataFrame:
    """One representative of each group (the smallest ``row``) with all its columns and ``n_copies``, itself included."""
    copies = materialize(format_copies(df, row, loose, ignore))
    counts = copies.groupBy("first_no").agg(F.count(F.lit(1)).alias("_more"))
    return (
        df.join(copies.select(F.col("copy_no").alias(row)), row, "left_anti")
        .join(counts.withColumnRenamed("first_no", row), row, "left")
        .withColumn("n_copies", F.coalesce("_more", F.lit(0)) + 1)
        .drop("_more")
    )
