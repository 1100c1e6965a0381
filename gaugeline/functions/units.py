"""Unit conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column

# Fixed values.
MPS_PER_MPH = 0.44704
KMH_PER_MPS = 3.6
PASCAL_PER_MILLIBAR = 100.0
FREEZING_F = 32.0
CELSIUS_PER_FAHRENHEIT = 5.0 / 9.0


def fahrenheit_to_celsius(value: Column) -> Column:
    return (value - FREEZING_F) * CELSIUS_PER_FAHRENHEIT


def celsius_to_fahrenheit(value: Column) -> Column:
    return value * 9.0 / 5.0 + FREEZING_F


def mph_to_mps(value: Column) -> Column:
    return value * MPS_PER_MPH


def mps_to_mph(value: Column) -> Column:
    return value / MPS_PER_MPH


def kmh_to_mps(value: Column) -> Column:
    return value / KMH_PER_MPS


def mps_to_kmh(value: Column) -> Column:
    return value * KMH_PER_MPS


def pascal_to_millibar(value: Column) -> Column:
    return value / PASCAL_PER_MILLIBAR
