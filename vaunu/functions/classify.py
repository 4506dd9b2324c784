"""Row classification: vehicle type, powertrain, emission pick, estimates, masses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaunu.functions import rules
from vaunu.functions.text import clean, literal_map, numeric


def vehicle_type(vehicle_class: Column, body: Column, group: Column) -> Column:
    """The first rule that fits: motorhome, minibus, bus, special, then by class and body."""
    kind, shape = F.upper(clean(vehicle_class)), F.upper(clean(body))
    codes = F.split(clean(group), r"[,\s]+")

    def in_groups(groups: list[str]) -> Column:
        return F.arrays_overlap(codes, F.array(*map(F.lit, groups)))

    return (
        F.when(in_groups(rules.MOTORHOME_GROUPS) | (shape == "SA"), "motorhome")
        .when(kind.isin("M2", "M2G") | in_groups(rules.MINIBUS_GROUPS), "minibus")
        .when(kind.isin("M3", "M3G") | in_groups(rules.BUS_GROUPS) | shape.isin(rules.BUS_BODIES), "bus")
        .when(in_groups(rules.SPECIAL_GROUPS) | shape.isin(rules.SPECIAL_BODIES), "special")
        .when(shape == "BB", "van")
        .when(kind.isin("N1", "N1G"), F.when(shape == "BE", "pickup").otherwise("light_truck"))
        .when(shape.isin("BA", "BE"), "pickup")
        .otherwise("passenger")
    )


def powertrain(fuel: Column, hybrid: Column, hybrid_class: Column) -> Column:
    """Electric first, then the hybrids, then the fuel; null for others."""
    is_hybrid = F.lower(clean(hybrid)) == "true"
    return (
        F.when(clean(fuel) == "04", "electric")
        .when(is_hybrid & (clean(hybrid_class) == "01"), "phev")
        .when(is_hybrid, "hybrid")
        .when(clean(fuel) == "02", "diesel")
        .when(clean(fuel) == "01", "petrol")
    )


def power_source(fuel: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map({"01": "petrol", "02": "diesel", "04": "electricity"}), clean(fuel)), F.lit("petrol"))


def emission(*fields: tuple[Column, str]) -> Column:
    """Value and method of the first field above 0, else 0 and wltp."""
    found = [F.when(numeric(c) > 0, F.struct(F.bround(numeric(c)).cast("int").alias("co2"), F.lit(m).alias("method"))) for c, m in fields]
    return F.coalesce(*found, F.struct(F.lit(0).alias("co2"), F.lit("wltp").alias("method")))


def fuel_estimate(kind: Column, co2: Column) -> Column:
    return (
        F.when(kind == "diesel", F.when(co2 != 0, F.bround(co2 / 26.4, 1)).otherwise(6.2))
        .when(kind == "petrol", F.when(co2 != 0, F.bround(co2 / 23.92, 1)).otherwise(6.8))
        .when(kind == "hybrid", F.when(co2 != 0, F.bround(co2 / 23.92, 1)).otherwise(5.0))
        .when(kind == "phev", F.bround(F.greatest(F.lit(2.2), co2 / 23.92), 1))
        .otherwise(0.0)
    )


def _ties(base: float, step: int, low: float, high: float) -> list[int]:
    """Masses whose estimate lies in the middle of two tenths, but whose binary value rounds to the odd one."""
    most = int((high - base) * step) + 1
    return [m for m in range(most) if m * 100 % step == 0 and (base * 100 + m * 100 // step) % 10 == 5 and low < base + m / step < high and round(base + m / step, 1) * 10 % 2 > 0.5 and round(base + m / step, 1) * 10 % 2 < 1.5]


def electricity_estimate(kind: Column, mass: Column) -> Column:
    """Tenths of kWh from the mass, rounded as its binary value is: ties, which masses in whole kilograms can hit, are listed."""

    def tenths(base: float, step: int, low: float, high: float) -> Column:
        value = F.greatest(F.lit(low), F.least(F.lit(high), base + mass / step))
        even = F.bround(value, 1)
        return F.when(mass.isin(_ties(base, step, low, high)), F.bround(F.when(even > value, even - 0.1).otherwise(even + 0.1), 1)).otherwise(even)

    return F.when(kind == "electric", tenths(11.0, 180, 15.0, 26.0)).when(kind == "phev", tenths(10.5, 200, 16.0, 24.0)).otherwise(0.0)


def mass_fallback(road: Column, technical: Column, curb: Column) -> tuple[Column, Column]:
    """The first known mass (0 and null are unknown), and where it is from."""
    known = F.coalesce(F.nullif(road, F.lit(0)), F.nullif(technical, F.lit(0)), F.nullif(curb, F.lit(0)), F.lit(0))
    source = F.when(road > 0, "road_traffic").when(technical > 0, "technical_fallback").when(curb > 0, "curb_mass_fallback").otherwise("unknown")
    return known, source


def body_label(body: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(rules.BODY_LABELS), F.upper(clean(body))), F.lit(""))
