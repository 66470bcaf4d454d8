"""Text cleaning."""

from pyspark.sql import Column, functions as F

from saleslake.functions import fixed_values as fixed


def unquote(c: Column) -> Column:
    """Remove every double quote."""
    return F.replace(c, F.lit('"'), F.lit(""))


def drop_commas(c: Column) -> Column:
    """Remove every ``,,``, left to right; a single comma stays."""
    return F.replace(c, F.lit(",,"), F.lit(""))


def drop_segment_prefix(c: Column) -> Column:
    return F.replace(c, F.lit(fixed.SEGMENT_PREFIX), F.lit(""))


def strip(c: Column) -> Column:
    """Trim all Unicode white space (Spark's plain trim only knows the blank)."""
    return F.btrim(c, F.lit(fixed.WHITE_SPACE))


def tidy_label(c: Column) -> Column:
    return F.upper(strip(unquote(c)))


def null_if_alias(c: Column) -> Column:
    """Null for a text that stands for "no value", otherwise the text unchanged."""
    return F.when(F.lower(strip(c)).isin(fixed.NULL_ALIASES), F.lit(None)).otherwise(c)


def readable_opstudy(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in fixed.OPSTUDY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, c), c)
