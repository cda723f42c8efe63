"""Column expressions used by the marts. All are built-in Spark functions, so
they stay inside whole-stage codegen; no UDF anywhere."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from metrolake import constants as K


def weekday(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def hour_start(ts) -> Column:
    """Start of the wall-clock hour of an NTZ timestamp (no session time zone involved)."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


# Fixed text layouts parsed field by field (no session time zone involved):
# layout -> (validating pattern, 1-based (start, length) of year, month, day, hour, minute[, second]).
_WALL_CLOCK_LAYOUTS = {
    "yyyy-MM-dd HH:mm:ss": (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
                            [(1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)]),
    "yyyy-MM-dd'T'HH:mm": (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$",
                           [(1, 4), (6, 2), (9, 2), (12, 2), (15, 2)]),
}


def parse_wall_clock(text, fmt: str) -> Column:
    """Parse local wall-clock text into TIMESTAMP_NTZ; NULL when unparsable.

    Parsing to a session-zone timestamp and casting to NTZ would move times
    that fall in a daylight-saving gap of the session zone; the known layouts
    are therefore validated once and cut at fixed offsets, then rebuilt with
    ``try_make_timestamp_ntz`` (impossible dates such as month 13 give NULL)."""
    t = _c(text).cast("string")
    if fmt not in _WALL_CLOCK_LAYOUTS:
        return F.try_to_timestamp(t, F.lit(fmt)).cast("timestamp_ntz")
    rx, spans = _WALL_CLOCK_LAYOUTS[fmt]
    p = [F.substring(t, a, n).cast("int") for a, n in spans]
    secs = p[5] if len(p) == 6 else F.lit(0)
    by_fields = F.when(t.rlike(rx), F.try_make_timestamp_ntz(p[0], p[1], p[2], p[3], p[4], secs))
    # Text whose length, separators and last digit are the layout's is cast as a whole, at a third of the cost;
    # what the cast refuses (garbage, a second of 60) or the shape excludes (a line end) goes the long way.
    size, marks = spans[-1][0] + 1, fmt.replace("'", "")
    shaped = reduce(lambda a, b: a & b, [F.substring(t, a - 1, 1) == marks[a - 2] for a, _ in spans[1:]], F.length(t) == size)
    return F.coalesce(F.when(shaped & F.substring(t, size, 1).between("0", "9"), t.try_cast("timestamp_ntz")), by_fields)


def weather_condition(code, bounds=K.CONDITION_BOUNDS, unknown=K.UNKNOWN_CONDITION,
                      clear=K.CLEAR_CONDITION, storm=K.STORM_CONDITION) -> Column:
    """WMO code -> condition label (NULL -> unknown, 0 -> clear, ranges, else storm)."""
    c = _c(code)
    expr = F.when(c.isNull(), F.lit(unknown)).when(c == 0, F.lit(clear))
    for upper, label in bounds:
        expr = expr.when(c < upper, F.lit(label))
    return expr.otherwise(F.lit(storm))


def banded(value, bounds, top) -> Column:
    """First band whose exclusive upper bound exceeds the value; NULL and larger -> top."""
    v = _c(value)
    expr = None
    for upper, label in bounds:
        expr = F.when(v < upper, F.lit(label)) if expr is None else expr.when(v < upper, F.lit(label))
    return expr.otherwise(F.lit(top))


def temperature_band(temp) -> Column:
    return banded(temp, K.TEMPERATURE_BOUNDS, K.TEMPERATURE_TOP)


def distance_band(distance) -> Column:
    return banded(distance, K.DISTANCE_BOUNDS, K.DISTANCE_TOP)


def price_per_distance(total="total_amount", distance="trip_distance") -> Column:
    """total / distance in double precision; NULL instead of an error on a zero distance."""
    return F.try_divide(_c(total).cast("double"), _c(distance).cast("double"))


def price_bin(price, width=K.BIN_WIDTH, nbins=K.NBINS) -> Column:
    """floor(price / width) clamped to [0, nbins - 1]."""
    return F.greatest(F.least(F.floor(_c(price) / F.lit(float(width))), F.lit(nbins - 1)),
                      F.lit(0)).cast("int")


def bin_labels(width=K.BIN_WIDTH, nbins=K.NBINS) -> Column:
    """Array of labels 'lo-hi$' for bins 0..nbins-1."""
    w = float(width)
    return F.transform(
        F.sequence(F.lit(0), F.lit(nbins - 1)),
        lambda i: F.concat((i * F.lit(w)).cast("int").cast("string"), F.lit("-"),
                           ((i + 1) * F.lit(w)).cast("int").cast("string"), F.lit("$")))


def round_to_double(x, digits=2) -> Column:
    """Spark round (HALF_UP) of a double or decimal, returned as double."""
    return F.round(_c(x), digits).cast("double")


def ratio(num, den, digits=2, scale=1.0) -> Column:
    """round(num / den * scale) in double precision; NULL when den is 0 or NULL."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    if scale != 1.0:
        q = q * F.lit(float(scale))
    return F.round(q, digits)


def weighted_mean(value, weight, digits=4, over=None) -> Column:
    """Aggregate: sum(value * weight) / sum(weight) over rows where value is set,
    rounded HALF_UP to ``digits`` and returned as double.

    Mart values are already rounded to cents, so the weighted sum is taken in
    DECIMAL(.., 2) and is exact; the quotient keeps 20 digits before the final
    rounding, so the result equals the exactly rounded weighted mean."""
    v, w = _c(value), _c(weight)
    num = F.sum(F.when(v.isNotNull(), v.cast("decimal(18,2)") * w))
    den = F.sum(F.when(v.isNotNull(), w))
    if over is not None:           # same arithmetic as a window aggregate
        num, den = num.over(over), den.over(over)
    return F.round(F.try_divide(num.cast("decimal(20,2)"), den), digits).cast("double")


def zone_name(location_id, zone) -> Column:
    """Zone name, or 'Zone <id>' when the id is not in the dimension."""
    return F.coalesce(_c(zone), F.concat(F.lit("Zone "), _c(location_id).cast("string")))


def all_of(*conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
