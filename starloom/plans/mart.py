"""Dimensions and the order fact of an e-commerce star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.operators import (
    add_date_key,
    add_row_number,
    coerce_numbers,
    drop_columns,
    keep_first,
    merge,
)

# Fixed value: the name of the fact's key.
FACT_KEY = "fact_purchase_order_key"


def dimension(
    rows: DataFrame,
    key: str,
    order_by: str | Sequence[str],
    drop: Sequence[str] = (),
    numbers: dict[str, str] | None = None,
    unique_order: bool = False,
) -> DataFrame:
    """Rows with unwanted columns dropped, numbers parsed, and a surrogate key in front."""
    shaped = coerce_numbers(drop_columns(rows, drop), numbers or {})
    return add_row_number(shaped, key, order_by, unique_order=unique_order)


def joined_orders(
    orders: DataFrame,
    users: DataFrame,
    on: str,
    order_by: str | Sequence[str],
    date_key_mode: str = "sequential",
    day: str | None = None,
    unique_order: bool = False,
) -> DataFrame:
    """Every order with its user, numbered in order, with a date key.

    ``unique_order`` holds if ``order_by`` identifies an order and ``on`` a user.
    """
    joined = merge(orders, users, on)
    numbered = add_row_number(joined, FACT_KEY, order_by, unique_order=unique_order)
    keyed = add_date_key(numbered, mode=date_key_mode, row_number=FACT_KEY, day=day)
    columns = [FACT_KEY, "date_key"]
    return keyed.select(*columns, *[c for c in keyed.columns if c not in columns])


def order_fact(joined: DataFrame, on: str) -> DataFrame:
    """The first order of every user; numbers of the other orders stay unused."""
    return keep_first(joined, on, FACT_KEY)
