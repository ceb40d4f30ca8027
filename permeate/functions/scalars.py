"""Scalar formulas of the process."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from permeate.functions.missing import ratio


def temperature_factor(temp_c: Column, reference_c: float = 20.0) -> Column:
    """Viscosity correction, 2.5 % per degree away from the reference temperature."""
    return F.pow(F.lit(1.025), temp_c - F.lit(reference_c))


def at_reference_temperature(reading: Column, temp_c: Column, reference_c: float = 20.0) -> Column:
    return reading / temperature_factor(temp_c, reference_c)


def hydraulic_efficiency(perm: Column, tmp: Column) -> Column:
    return ratio(perm, tmp + F.lit(0.1))


def crossflow_efficiency(velocity: Column, tmp: Column) -> Column:
    return ratio(velocity, tmp + F.lit(0.1))


def recovery_per_energy(recovery: Column, specific_power: Column) -> Column:
    return ratio(recovery, specific_power + F.lit(0.001))


def severity(rate: Column, limits: tuple[float, float, float]) -> Column:
    """low / medium / high / critical by the size of ``rate``."""
    low, medium, high = limits
    size = F.abs(rate)
    return (
        F.when(size.isNull(), F.lit(None).cast("string"))
        .when(size < low, "low")
        .when(size < medium, "medium")
        .when(size < high, "high")
        .otherwise("critical")
    )


def to_log(reading: Column) -> Column:
    """Logarithm with a small offset, so that a reading of zero stays finite."""
    return F.ln(F.when(reading + F.lit(0.1) > 0, reading + F.lit(0.1)))


def from_log(value: Column) -> Column:
    return F.exp(value) - F.lit(0.1)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)
