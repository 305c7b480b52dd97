"""Column -> Column helpers for cleansing and money arithmetic.

All expressions are built-in Spark functions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values that must equal the source system's rules.
# E-mail shape accepted by the silver customer table (tested on the raw,
# untrimmed value; a leading blank therefore fails the test).
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Money columns are DECIMAL(19,4) in every published table.
MONEY = DecimalType(19, 4)
_QTY = DecimalType(10, 0)  # any INT quantity
_RATE = DecimalType(5, 4)
_ONE_TYPE = DecimalType(1, 0)


def clean_email(c: Column) -> Column:
    """Lower-cased, trimmed address when the raw value has a valid shape, else NULL."""
    return F.when(c.rlike(EMAIL_PATTERN), F.lower(F.trim(c)))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def money(c: Column) -> Column:
    return c.cast(MONEY)


# Factors are narrowed first so the product stays an exact decimal (10+19+5
# digits and a carry, within 38) before it is rounded once to DECIMAL(19,4).
def line_total(qty: Column, price: Column, discount: Column) -> Column:
    return money(qty.cast(_QTY) * price * (F.lit(1).cast(_ONE_TYPE) - discount.cast(_RATE)))


def discount_amount(qty: Column, price: Column, discount: Column) -> Column:
    return money(qty.cast(_QTY) * price * discount.cast(_RATE))


def line_profit(total: Column, qty: Column, unit_cost: Column) -> Column:
    return money(total - qty.cast(_QTY) * unit_cost)


def order_total(sub_total: Column, tax: Column, freight: Column) -> Column:
    """NULL when any part is NULL."""
    return money(sub_total + tax + freight)


def safe_pct(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100 as DOUBLE; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * F.lit(100.0)


def mask_email(c: Column, salt: str) -> Column:
    """Keep the domain, replace the local part by the salted digest of the whole
    address. The salt is a secret of the run's configuration: without it, known
    addresses could be hashed and compared. The full digest keeps people apart."""
    if not salt:
        raise ValueError("mask_email needs a salt (RunConfig.mask_salt)")
    return F.when(c.isNotNull(),
                  F.concat(F.sha2(F.concat(F.lit(salt), c), 256), F.lit("@"), F.substring_index(c, "@", -1)))
