"""Column expressions shared by all operators.

Everything here maps columns to columns with built-in functions, so it stays
inside whole-stage code generation.  None of it raises on dirty input: casts and
parses that may fail use the `try_` variants, because ANSI mode is on.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.functions import fixed

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- choosing and mapping -----------------------------------------------------


def first_match(branches: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first branch whose condition holds; null conditions do not hold."""
    result = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if result is None else result.otherwise(default)


def lookup(c: ColumnLike, table: Mapping) -> Column:
    """Table value of the column, null where the table has no such key."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literal, as_col(c))


def value_map(c: ColumnLike, table: Mapping, missing: object = None) -> Column:
    """Replace known spellings, pass other values through, nulls become `missing`."""
    mapped = F.coalesce(lookup(c, table), as_col(c))
    return mapped if missing is None else F.coalesce(mapped, F.lit(missing))


def blank_to(c: ColumnLike, label: str) -> Column:
    """`label` for null and blank text, otherwise the text without outer blanks."""
    return F.coalesce(F.nullif(F.trim(as_col(c)), F.lit("")), F.lit(label))


def bucketize(
    c: ColumnLike,
    edges: Sequence,
    labels: Sequence[str],
    right: bool = False,
    null_label: str | None = None,
) -> Column:
    """Label of the interval the value falls in.

    `right=False` puts an edge value into the upper interval, `right=True` into
    the lower one.  Null goes to the last label unless `null_label` is given.
    """
    value = as_col(c)
    below = (lambda e: value <= e) if right else (lambda e: value < e)
    branches = [(below(edge), label) for edge, label in zip(edges, labels)]
    if null_label is not None:
        branches.insert(0, (value.isNull(), null_label))
    return first_match(branches, labels[-1])


def steps_above(c: ColumnLike, steps: Sequence[tuple[float, object]], floor: object) -> Column:
    """Value of the first step whose limit the column exceeds, else `floor`."""
    return first_match([(as_col(c) > limit, value) for limit, value in steps], floor)


# ---- numbers --------------------------------------------------------------------


def clamp(c: ColumnLike, low, high) -> Column:
    """Limit to [low, high]; null stays null (least/greatest would drop it)."""
    value = as_col(c)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def repair_range(c: ColumnLike, low, below, high, above, missing) -> Column:
    """Constants for values under `low`, over `high` and null."""
    value = as_col(c)
    return first_match(
        [(value < low, below), (value > high, above), (value.isNull(), missing)], value
    )


def coerce_number(c: ColumnLike, default: float = 0.0) -> Column:
    """Double value of anything, `default` where it is not a number."""
    return F.coalesce(as_col(c).try_cast("double"), F.lit(default))


def parse_number(c: ColumnLike, strip: str = "", suffix: str = "") -> Column:
    """Number from text such as `$1.50` or `45s`; null when it is none."""
    text = F.trim(as_col(c).cast("string"))
    if strip:
        text = F.trim(F.replace(text, F.lit(strip), F.lit("")))
    if suffix:
        text = F.regexp_replace(text, f"{suffix}$", "")
    return text.try_cast("double")


def guarded_ratio(num: ColumnLike, den: ColumnLike, default: float = 0.0) -> Column:
    """num / den where den > 0, otherwise `default`."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def clip(c: ColumnLike, low, high) -> Column:
    """Limit a column known not to be null."""
    return F.least(F.greatest(as_col(c), F.lit(low)), F.lit(high))


def key_draw(key: ColumnLike, draw: tuple[int, int]) -> Column:
    """Repeatable pseudo-random integer in [0, modulus) from an integer key."""
    multiplier, modulus = draw
    reduced = F.pmod(as_col(key).cast("long"), F.lit(modulus))  # keeps the product small
    return F.pmod(reduced * F.lit(multiplier), F.lit(modulus))


# ---- text -----------------------------------------------------------------------


def capitalise(c: ColumnLike) -> Column:
    """First letter upper case, the rest lower case."""
    c = as_col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def first_token(c: ColumnLike) -> Column:
    return F.regexp_extract(as_col(c), r"^(\S+)", 1)


def strip_leading_age(c: ColumnLike) -> Column:
    """`47 DESKTOP` -> `DESKTOP`; other text unchanged."""
    c = as_col(c)
    return F.when(
        c.rlike(fixed.LEADING_AGE),
        F.trim(F.regexp_extract(c, fixed.LEADING_AGE_THEN_DEVICE, 1)),
    ).otherwise(c)


def matches(c: ColumnLike, pattern: str) -> Column:
    return as_col(c).rlike(pattern)


def any_word(columns: Sequence[str], words: Sequence[str]) -> Column:
    """True when one of the words occurs in the row's text, ignoring case."""
    text = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]))
    return reduce(lambda a, b: a | b, [text.contains(w.lower()) for w in words], F.lit(False))


# ---- time -----------------------------------------------------------------------


def parse_timestamp(c: ColumnLike, formats: Mapping[str, str] | None = None) -> Column:
    """Timestamp by the first format whose pattern the text has; else null."""
    text = as_col(c)
    formats = fixed.TIMESTAMP_FORMATS if formats is None else formats
    parsed = [
        F.when(text.rlike(pattern), F.try_to_timestamp(text, F.lit(fmt)))
        for pattern, fmt in formats.items()
    ]
    return F.coalesce(*parsed)


def nearest_hour(c: ColumnLike) -> Column:
    return F.bround(as_col(c)).cast("int")


def nearest_quarter_hour(c: ColumnLike) -> Column:
    return F.bround(as_col(c) * 4) / 4


def clock_label(hour: ColumnLike) -> Column:
    """`9:15 AM` from a (fractional) hour of day."""
    minutes = F.bround(as_col(hour) * 4).cast("int") * 15
    h24 = F.pmod(F.floor(minutes / 60), F.lit(24))
    h12 = F.when(h24 % 12 == 0, F.lit(12)).otherwise(h24 % 12)
    minute = F.lpad(F.pmod(minutes, F.lit(60)).cast("string"), 2, "0")
    half = F.when(h24 < 12, "AM").otherwise("PM")
    return F.concat(h12.cast("string"), F.lit(":"), minute, F.lit(" "), half)


# ---- arrays ---------------------------------------------------------------------


def primary_element(c: ColumnLike) -> Column:
    """Smallest element of an array, null when it is empty."""
    return F.try_element_at(F.sort_array(as_col(c)), F.lit(1))


# ---- display --------------------------------------------------------------------


def shown(c: ColumnLike, places: int) -> Column:
    """Rounded for display.

    The value is lifted by 1e-9 first: averages that differ in their last digits,
    as sums of doubles do from run to run, are then shown alike.
    """
    return F.round(as_col(c) + F.lit(1e-9), places)


def money(c: ColumnLike, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(as_col(c), digits))


def percent(c: ColumnLike, digits: int = 2) -> Column:
    """Fraction shown as a percentage."""
    return F.concat(F.format_number(as_col(c) * 100, digits), F.lit("%"))


def multiple(c: ColumnLike, digits: int = 2) -> Column:
    return F.concat(F.format_number(as_col(c), digits), F.lit("x"))


def signed_money(c: ColumnLike, digits: int = 0) -> Column:
    """Amount with the sign in front of the currency symbol."""
    c = as_col(c)
    sign = F.when(c < 0, "-").otherwise("+")
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(c), digits))


# ---- frames ---------------------------------------------------------------------


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]
