"""Column helpers that pin the semantics on which engines differ."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; blank text is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def empty_to_null(c: Column) -> Column:
    """Empty text is NULL, blanks are kept."""
    return F.nullif(c, F.lit(""))


def at_least(c: Column, floor) -> Column:
    """greatest(c, floor), but NULL when `c` is NULL."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def money(c: Column, dtype=MONEY) -> Column:
    return F.round(c, 2).cast(dtype)


def total(c: Column) -> Column:
    """Rounded sum; NULL over no rows, as SUM is."""
    return F.round(F.sum(c), 2).cast(TOTAL)


def total0(c: Column) -> Column:
    """Rounded sum; zero over no rows."""
    return F.coalesce(F.round(F.sum(c), 2), F.lit(0)).cast(TOTAL)


def top_with(rows, order, n: int, other, key: str):
    """The first `n` rows of `rows`, of those that `other` has, joined to `other`, in order.

    Only key columns are met before the cut, the other columns for `n` rows.
    """
    first = rows.join(other.select(key), key, "left_semi").orderBy(*order).limit(n)
    return first.join(other, key).orderBy(*order).limit(n)


def steps(c: Column, bounds, default) -> Column:
    """Value of the first (lower bound, value) pair whose bound `c` reaches."""
    out = None
    for low, value in bounds:
        hit, value = c >= F.lit(low), F.lit(value)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(default))


def first_match(pairs, default=None) -> Column:
    """Value of the first (condition, value) pair that holds."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def position_in(c: Column, words, missing=None) -> Column:
    """1-based place of `c` in a fixed list of words."""
    missing = len(words) if missing is None else missing
    return first_match([(c == w, F.lit(i)) for i, w in enumerate(words, 1)], F.lit(missing))


def fill(template: str, *args) -> Column:
    """`template` with each %s replaced by a column as text.

    The text is NULL when an argument is NULL.
    """
    pieces = template.replace("%%", "%").split("%s")
    out = [F.lit(pieces[0])]
    for arg, piece in zip(args, pieces[1:], strict=True):
        out += [arg.cast("string"), F.lit(piece)]
    return F.concat(*out)


def money_text(c: Column) -> Column:
    return F.format_number(F.coalesce(c, F.lit(0)).cast(TOTAL), 2)
