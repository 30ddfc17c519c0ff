"""Column functions: contract terms, dates, keys and load factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the data model.
AGGREGATE, PER_RISK, NON_CAT_QUOTA_SHARE = 1, 4, 7
LOD, RAD = 1, 2
ASSUMED, CEDED = 1, 2
BOUND = 10
LOSS_VIEWS = (1, 10, 3, 30, 4)
REMAPPED_VIEWS = {10: 1, 30: 3, 11: 1, 33: 3, 44: 4}
PERILS = {"cs": 1, "eq": 3, "fl": 4, "wf": 14, "wt": 15, "ws": 16}


#: Shares and factors, and amounts of money, as exact decimals: a product of both is rounded back to money.
SHARE, MONEY = "decimal(16,10)", "decimal(20,8)"


def times(value: Column, *factors: Column, kind: str = MONEY) -> Column:
    """The product, rounded half up to ``kind`` after each factor."""
    for factor in factors:
        value = (value * factor.cast(SHARE)).cast(kind)
    return value


#: Money and shares as whole numbers of their last digit: a decimal of more than 18 digits is an object for every row, a long isn't.
MONEY_UNIT, SHARE_UNIT = 10**8, 10**10
#: Units of money up to which sums fit a long and doubles of 6 digits are exact, and units of a factor up to which products do.
MOST_UNITS, MOST_FACTOR = 9 * 10**17, 9 * 10**13


def units(amount: Column, unit: int = MONEY_UNIT) -> Column:
    """A decimal as a whole number of units."""
    return (amount * F.lit(unit).cast("decimal(11,0)")).cast("long")


def from_units(amount: Column) -> Column:
    return (amount.cast("decimal(20,0)") / F.lit(MONEY_UNIT).cast("decimal(9,0)")).cast(MONEY)


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a, F.lit(n))


def times_units(value: Column, *factors: Column) -> Column:
    """As ``times``, in units: rounded half up after each factor. Exact for what isn't negative, with factors up to ``MOST_FACTOR`` and
    products up to ``MOST_UNITS``: no part of a product is more than a long."""
    half = 10**5  # both halves of a factor's digits
    for factor in factors:
        high, low = _div(value, SHARE_UNIT), value % SHARE_UNIT
        upper = low * _div(factor, half)
        value = high * factor + _div(upper, half) + _div((upper % half) * half + low * (factor % half) + SHARE_UNIT // 2, SHARE_UNIT)
    return value


def units_to_double(amount: Column, digits: int) -> Column:
    """Units rounded half up to so many digits, as a double; not for negative ones."""
    rest = MONEY_UNIT // 10**digits
    return _div(amount + rest // 2, rest) / F.lit(10**digits).cast("double")


def by_basis(basis: Column, aggregate: Column, risk: Column, occurrence: Column) -> Column:
    """Aggregate terms for an aggregate basis, risk terms for per-risk and non-cat quota share, else occurrence terms."""
    return F.when(basis == AGGREGATE, aggregate).when(basis.isin(PER_RISK, NON_CAT_QUOTA_SHARE), risk).otherwise(occurrence)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, 0.0).otherwise(a / F.when(b != 0, b))


def share(signed: Column, estimated: Column) -> Column:
    return F.when(signed > 0, signed).otherwise(estimated)


def sign(tran_type: Column) -> Column:
    return F.when(tran_type == CEDED, -1.0).when(tran_type == ASSUMED, 1.0).otherwise(0.0)


def days(start: Column, end: Column) -> Column:
    """Days of a closed period."""
    return F.datediff(end, start) + 1


def quarter_end(date: Column) -> Column:
    """Last day of the quarter completed before the date's own quarter."""
    return F.date_sub(F.trunc(date, "quarter"), 1)


def accounting_period(date: Column) -> Column:
    """YYYYMM of the last completed quarter: 12 of the year before in the first quarter."""
    month = F.month(date)
    return F.when(month <= 3, (F.year(date) - 1) * 100 + 12).otherwise(F.year(date) * 100 + F.floor((month - 1) / 3) * 3).cast("int")


def remapped_view(view: Column) -> Column:
    out = view
    for old, new in REMAPPED_VIEWS.items():
        out = F.when(view == old, new).otherwise(out)
    return out.cast("int")


def view_priority(view: Column) -> Column:
    return F.when(view.isin(*REMAPPED_VIEWS), 0).when(view.isin(1, 3, 4), 1).otherwise(2).cast("int")


def day_key(day: Column, year: Column, peril: Column, event: Column) -> Column:
    """Day-major key: day << 54 | year << 39 | peril << 33 | event (33 bits)."""
    parts = F.shiftleft(day.cast("long"), 54).bitwiseOR(F.shiftleft(year.cast("long"), 39))
    return parts.bitwiseOR(F.shiftleft(peril.cast("long"), 33)).bitwiseOR(event.bitwiseAND(F.lit((1 << 33) - 1)))


def day_key_parts(key: Column) -> dict[str, Column]:
    mask = lambda shift, bits: F.shiftright(key, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return {"day": mask(54, 9).cast("int"), "year": mask(39, 15).cast("int"), "peril_id": mask(33, 6).cast("int"), "event_id": key.bitwiseAND(F.lit((1 << 33) - 1))}
