"""Guards of a finished catalogue and its index, unique labels, and the lock of a build."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions import text as T
from vaunu.operators.index import availability, index_rows
from vaunu.operators.merge import LABEL

KEYS = ["brand", "model", "vehicle_type"]


def repeated_labels(items: DataFrame) -> DataFrame:
    """``LABEL, n_rows`` of labels that a user would see several times."""
    return items.groupBy(*LABEL).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique_labels(items: DataFrame, pos: str = "item_no") -> DataFrame:
    """``items`` with `` #2``, `` #3`` after the variant of rows whose label another row has already, in the order of ``pos``.

    Only rows of repeated labels are numbered, so the window sees few rows.
    """
    on = F.lit(True)
    for name in LABEL:
        on = on & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    doubled = items.alias("a").join(repeated_labels(items).alias("b"), on, "left_semi")
    nth = doubled.select(F.col(pos).alias("_pos"), F.row_number().over(Window.partitionBy(*LABEL).orderBy(pos)).alias("_nth")).where("_nth > 1")
    plain = F.split_part("variant", F.lit(" #"), F.lit(1))
    numbered = F.concat(plain, F.lit(" #"), F.col("_nth").cast("string"))
    return items.join(nth, F.col(pos) == F.col("_pos"), "left").withColumn("variant", F.when(F.col("_nth").isNotNull(), numbered).otherwise(F.col("variant"))).drop("_pos", "_nth")


def index_violations(index: DataFrame, offered: DataFrame, makes: DataFrame | None = None, kinds: DataFrame | None = None) -> DataFrame:
    """``rule, n_rows`` of an index that breaks its rules; all are 0 for a sound one.

    ``index`` has ``brand, model, vehicle_type, powertrains``, ``offered`` is what the picker offers.
    ``makes`` (``brand``) and ``kinds`` (:func:`availability`) are compared where given.
    """
    c = F.col
    expected = index_rows(offered)
    twice = index.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    both = index.select(*KEYS, F.array_join("powertrains", ",").alias("_codes")).join(
        expected.select(*KEYS, F.array_join("powertrains", ",").alias("_wanted")), KEYS, "full"
    )
    worded = index.select("model").distinct().where(T.matches(c("model"), rules.ENGINE_WORDS))
    bodies = index.select("model").distinct().where(T.strip_body_words(c("model")) != c("model"))
    unknown = F.size(F.array_except("powertrains", F.array(*map(F.lit, rules.POWERTRAINS)))) > 0

    def rule(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n_rows"))

    def gaps(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
        return rule(name, a.exceptAll(b).unionByName(b.exceptAll(a)))

    out = [
        rule("listed twice", twice), rule("missing", both.where("_codes is null")), rule("unexpected", both.where("_wanted is null")),
        rule("other codes", both.where("_codes != _wanted")), rule("no code", index.where(F.size("powertrains") == 0)), rule("unknown code", index.where(unknown)),
        rule("engine word", worded), rule("body word", bodies), rule("unknown type", index.where(~c("vehicle_type").isin(rules.VEHICLE_TYPES))),
    ]
    if makes is not None:
        out.append(gaps("makes differ", makes.select("brand"), expected.select("brand").distinct()))
    if kinds is not None:
        flat = [d.select("brand", "vehicle_type", F.array_join("powertrains", ",").alias("codes")) for d in (kinds, availability(offered))]
        out.append(gaps("availability differs", *flat))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def check_index(index: DataFrame, offered: DataFrame, makes: DataFrame | None = None, kinds: DataFrame | None = None) -> None:
    """Raise on any violation, or on an index that offers nothing."""
    bad = {r.rule: r.n_rows for r in index_violations(index, offered, makes, kinds).where("n_rows > 0").collect()}
    if bad or offered.isEmpty():
        raise ValueError(f"index violates {bad or 'nothing is offered'}")


@contextlib.contextmanager
def build_lock(path: str) -> Iterator[str]:
    """One build at a time: a lock file on the driver, made if there is none, or an error."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    try:
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    except FileExistsError as error:
        raise RuntimeError(f"a build is running already: {path}") from error
    try:
        os.write(handle, str(os.getpid()).encode())
        os.close(handle)
        yield path
    finally:
        os.unlink(path)
