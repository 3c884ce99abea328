"""Checking SQL per report key."""

from sqlchecks import operational, warehouse


def statements(full_year: int, sample_order: int) -> dict[str, str]:
    return {**operational.statements(full_year), **warehouse.statements(full_year, sample_order)}
