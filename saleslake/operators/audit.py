"""Audit of the gold tables.

The flat view joins each fact to its dimensions. Its dimension columns depend only on
the keys, so every figure below counts facts per key first and joins the counts; the
wide view itself is never shuffled.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from saleslake.functions import dates, flags
from saleslake.functions.fixed_values import OTHER
from saleslake.operators.cleaning import clean, valid_rows
from saleslake.operators.growth import sales, share_of_all, top_n
from saleslake.operators.silver import drop_copies, golden_records, healed_rows
from saleslake.sources.layers import Gold
from saleslake.sources.scratch import written

FLAT_NAMES = {
    "full_date": "date",
    "pln_id": "pln",
    "actual_sales": "actual",
    "segment_id": "seg",
    "business_unit": "bu",
    "broad_category": "product_category",
}
QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}


def rows() -> Column:
    return F.count(F.lit(1))


def join_flat(gold: Gold) -> DataFrame:
    """One wide row per fact."""
    joined = (
        gold.fact.join(gold.dates, "date_key", "left")
        .join(gold.products, "pln_id", "left")
        .join(gold.segments, "segment_id", "left")
    )
    return joined.withColumnsRenamed(FLAT_NAMES).withColumn("promo", flags.promo_label(F.col("is_promo")))


def fact_counts(fact: DataFrame) -> DataFrame:
    """Each distinct fact with its number ``n``: what most figures can be taken from."""
    return fact.groupBy(*fact.columns).agg(rows().alias("n"))


def weight(fact: DataFrame) -> Column:
    """How many facts a row stands for."""
    return F.col("n") if "n" in fact.columns else F.lit(1).cast("bigint")


def _total(fact: DataFrame, condition: Column | None = None) -> Column:
    """Facts, or those that meet a condition; 0 where there are none."""
    n = weight(fact)
    return F.coalesce(F.sum(n if condition is None else F.when(condition, n)), F.lit(0)).cast("bigint")


def shape(gold: Gold) -> DataFrame:
    """Rows and columns of the flat view; its left joins on unique keys keep the facts."""
    columns = [c for c in join_flat(gold).columns if c != "n"]
    return gold.fact.agg(_total(gold.fact).alias("row_count")).withColumn(
        "column_count", F.lit(len(columns)).cast("bigint")
    )


def null_counts(gold: Gold) -> DataFrame:
    """``(column_name, null_count)`` over the flat view, in one pass over the facts."""
    flat = join_flat(gold)
    columns = [c for c in flat.columns if c != "n"]
    nulls = flat.agg(*[_total(flat, F.col(c).isNull()).alias(c) for c in columns])
    return nulls.unpivot([], columns, "column_name", "null_count")


FACT_NUMBERS = {"date_key": "date_key", "pln_id": "pln", "actual_sales": "actual"}


def value_counts(fact: DataFrame) -> DataFrame:
    """``(column_name, value, n)`` of the numbers in the facts, in one pass over them."""
    numbers = [F.col(c).cast("double").alias(name) for c, name in FACT_NUMBERS.items()]
    cells = fact.select(weight(fact).alias("n"), *numbers).unpivot("n", [*FACT_NUMBERS.values()], "column_name", "value")
    return cells.groupBy("column_name", "value").agg(F.sum("n").alias("n"))


def number_counts(counted: DataFrame, days: DataFrame) -> DataFrame:
    """The same for all numbers of the flat view: those of the date table follow from the
    counts of its key."""
    numeric = [c for c, kind in days.dtypes if kind in ("tinyint", "smallint", "int", "bigint") and c != "date_key"]
    keys = counted.filter("column_name = 'date_key'").select(F.col("value").cast("int").alias("date_key"), "n")
    dated = keys.join(days, "date_key", "left").select("n", *[F.col(c).cast("double").alias(c) for c in numeric])
    cells = dated.unpivot("n", numeric, "column_name", "value")
    return counted.unionByName(cells.groupBy("column_name", "value").agg(F.sum("n").alias("n")))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for other in frames[1:]:
        result = result.unionByName(other)
    return result


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``(duplicate_rows)``: all members of groups of equal rows, not the surplus."""
    groups = df.groupBy(*df.columns).agg(rows().alias("n")).filter(F.col("n") > 1)
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"))


def nonpositive(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("actual_sales") <= 0)


def count_values(column: str) -> Column:
    """Distinct values, nulls together counting as one more."""
    has_null = F.max(F.col(column).isNull().cast("int"))
    return (F.count_distinct(F.col(column)) + F.coalesce(has_null, F.lit(0))).cast("bigint")


def cardinality(gold: Gold) -> DataFrame:
    """Distinct products, categories, studies, segments and business units."""
    pairs = gold.fact.select("pln_id", "segment_id").distinct()
    products = gold.products.select("pln_id", "broad_category", "opstudy_label", "business_unit")
    return pairs.join(products, "pln_id", "left").agg(
        count_values("pln_id").alias("unique_plns"),
        count_values("broad_category").alias("unique_categories"),
        count_values("opstudy_label").alias("unique_opstudies"),
        count_values("segment_id").alias("unique_segments"),
        count_values("business_unit").alias("unique_bus"),
    )


def placed(counted: DataFrame, path: str) -> DataFrame:
    """The counts, written in ranges of value, each row with the number of its range.
    A range holds whole values of neighbouring size, so ranks can be summed over ranges
    and ordered inside them; no column is ever sorted in one task."""
    ranges = counted.repartitionByRange("column_name", "value")
    return written(ranges.withColumn("bracket", F.spark_partition_id()), path)


def describe(gold: Gold, work: str) -> DataFrame:
    """Per numeric column: count, nulls, mean, standard deviation, least, quartiles and
    greatest, all exact. The quartiles are values that occur, at the nearest rank.

    The facts are read once. The counts of their values are tables in the folder
    ``work``, which the caller removes when the result has been read."""
    counted = written(value_counts(gold.fact), f"{work}/values")
    return describe_counts(placed(number_counts(counted, gold.dates), f"{work}/ranges"))


def describe_counts(counted: DataFrame) -> DataFrame:
    """Statistics of ``(column_name, value, n, bracket)``. What is known of a whole column
    (a few rows) meets the sums of its ranges first, then the ranges their values, so no
    join is dealt by the few column names."""
    n, value = F.col("n"), F.col("value")
    summary = (
        counted.groupBy("column_name")
        .agg(
            F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("null_count"),
            (F.sum(value * n) / F.sum(F.when(value.isNotNull(), n))).alias("mean"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .filter(F.col("min").isNotNull())
    )
    present = counted.filter(value.isNotNull())
    sums = present.groupBy("column_name", "bracket").agg(F.sum("n").alias("rows"))
    earlier = Window.partitionBy("column_name").orderBy("bracket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    targets = summary.select("column_name", "row_count", "mean")
    starts = sums.select("column_name", "bracket", before).join(targets, "column_name")
    within = F.sum("n").over(Window.partitionBy("column_name", "bracket").orderBy("value"))
    ranked = (
        present.withColumn("within", within)
        .join(starts, ["column_name", "bracket"])
        .withColumn("last_rank", F.col("before") + F.col("within"))
    )

    def at(q: float) -> Column:
        rank = F.round((F.col("row_count") - 1) * F.lit(q)) + 1
        return F.min(F.when(F.col("last_rank") >= rank, value))

    apart = value - F.col("mean")
    details = ranked.groupBy("column_name").agg(
        F.sum(n * apart * apart).alias("squares"),
        *[at(q).alias(name) for name, q in QUANTILES.items()],
    )
    std = F.sqrt(F.col("squares") / F.nullif(F.col("row_count") - 1, F.lit(0))).alias("std")
    return summary.join(details, "column_name").select(
        "column_name", "row_count", "null_count", "mean", std, "min", *QUANTILES, "max"
    )


#: Size of a quantile sketch. The rank of a quartile is off by at most 0.3 percent of the rows (with a
#: confidence of 99 percent: 2.296 / k ** 0.9723).
SKETCH_SIZE = 1024
#: Groups that the sketches of all tasks are merged in, before the last merge takes theirs.
SPREAD = 256


def describe_sketched(gold: Gold, k: int = SKETCH_SIZE) -> DataFrame:
    """The same as ``describe`` with quartiles from mergeable sketches: counts, mean, deviation,
    least and greatest are exact, the rank of a quartile within the error of a sketch of size k.

    The facts are read once and no value is shuffled or written: each task sends a sketch per column."""
    numbers = [c for c, kind in gold.dates.dtypes if kind in ("tinyint", "smallint", "int", "bigint") and c != "date_key"]
    dated = gold.fact.join(gold.dates.select("date_key", *numbers), "date_key", "left")
    columns = {**FACT_NUMBERS, **{c: c for c in numbers}}
    cells = dated.select(
        F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("task"), *[F.col(c).cast("double").alias(name) for c, name in columns.items()]
    )
    parts = cells.groupBy("task").agg(
        *[
            F.struct(
                rows().alias("rows"),
                F.count(name).alias("n"),
                F.avg(name).alias("mean"),
                (F.var_pop(name) * F.count(name)).alias("squares"),
                F.min(name).alias("min"),
                F.max(name).alias("max"),
                F.kll_sketch_agg_double(name, F.lit(k)).alias("sketch"),
            ).alias(name)
            for name in columns.values()
        ]
    )
    tall = parts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("p")) for n in columns.values()])).alias("c"))
    merged = tall.select("c.column_name", "c.p.*").groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        (F.sum("rows") - F.sum("n")).alias("null_count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        # As many as there are groups of tasks, at most.
        F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "squares"))).alias("moments"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def together(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n).alias("squares"),
        )

    whole = merged.filter("row_count > 0").withColumn("m", F.aggregate("moments", start, together))
    quartiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in QUANTILES.items()]
    std = F.sqrt(F.col("m.squares") / F.nullif(F.col("row_count") - 1, F.lit(0))).alias("std")
    return whole.select("column_name", "row_count", "null_count", F.col("m.mean").alias("mean"), std, "min", *quartiles, "max")


def sales_by_product(gold: Gold, attributes: list[str]) -> DataFrame:
    """Rows and sales by product attributes, summed per product before the join."""
    sums = gold.fact.groupBy("pln_id").agg(rows().alias("row_count"), sales().alias("total_sales"))
    joined = sums.join(gold.products, "pln_id", "left").withColumnsRenamed(FLAT_NAMES)
    return joined.groupBy(*attributes).agg(
        F.sum("row_count").alias("row_count"), F.sum("total_sales").alias("total_sales")
    )


def category_distribution(gold: Gold) -> DataFrame:
    """Rows, sales and share of sales by category, most sales first."""
    shares = share_of_all(sales_by_product(gold, ["product_category"]), "total_sales")
    return shares.withColumnRenamed("pct", "sales_pct").orderBy(F.desc("total_sales"), "product_category")


def other_share(gold: Gold) -> DataFrame:
    """Share of Other; no row when nothing is in it."""
    return category_distribution(gold).filter(F.col("product_category") == OTHER).select("product_category", "sales_pct")


def _top_in_other(gold: Gold, label: str, n: int) -> DataFrame:
    sums = sales_by_product(gold, ["product_category", label]).filter(F.col("product_category") == OTHER)
    return top_n(sums.select(label, "total_sales"), n, "total_sales", label)


def top_unmapped(gold: Gold, n: int = 30) -> DataFrame:
    """Source labels with most sales in Other."""
    return _top_in_other(gold, "legacy_category_label", n)


def top_other_products(gold: Gold, n: int = 20) -> DataFrame:
    """Product labels with most sales in Other."""
    return _top_in_other(gold, "pln_label", n)


#: Bits of a bitmap word, and words that a combination holds beside its keys. Weekly dates of 19 years fit.
WORD_BITS = 64
WORDS = 16


def numbered_dates(gold: Gold) -> DataFrame:
    """``(date_key, date, i)``: the dates numbered from 0 in their order; a window over one row per date."""
    place = F.row_number().over(Window.orderBy("full_date")) - 1
    return gold.dates.select("date_key", F.col("full_date").alias("date"), place.alias("i"))


def date_bitmaps(gold: Gold, dates_there: int) -> tuple[DataFrame, list[str], list[str]]:
    """Per product, segment and promotion flag a bitmap of the dates that have facts, as words of 64
    bits; also whether there are undated facts, and the first and last date.

    The bits are set before the shuffle, so that it moves combinations and not facts. Dates beyond
    the words a row holds go to further rows of the combination (``part``). Returns the frame, its
    keys and its words."""
    words = min(max(-(-dates_there // WORD_BITS), 1), WORDS)
    keys = ["pln_id", "segment_id", "promo"] + (["part"] if dates_there > WORDS * WORD_BITS else [])
    i = F.col("i")
    word, bit = F.floor(i / WORD_BITS) % WORDS, F.call_function("shiftleft", F.lit(1).cast("bigint"), i % WORD_BITS)
    dated = gold.fact.join(numbered_dates(gold), "date_key", "left").select(
        "pln_id",
        "segment_id",
        flags.promo_label(F.col("is_promo")).alias("promo"),
        F.coalesce(F.floor(i / (WORDS * WORD_BITS)), F.lit(0)).alias("part"),
        "date",
        *[F.when(word == w, bit).alias(f"bits_{w}") for w in range(words)],
    )
    names = [f"bits_{w}" for w in range(words)]
    bitmaps = dated.groupBy(*keys).agg(
        *[F.coalesce(F.bit_or(name), F.lit(0)).alias(name) for name in names],
        F.max(F.col("date").isNull().cast("int")).alias("undated"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
    )
    return bitmaps, keys, names


def _set_bits(names: list[str]) -> Column:
    return sum((F.bit_count(name).cast("bigint") for name in names), F.lit(0).cast("bigint"))


def date_presence(gold: Gold, keep_bitmaps: bool = False) -> DataFrame:
    """Per product, segment and promotion flag: weeks present (a missing date counts as
    one), first and last date, weeks expected in between and weeks missing.

    The dates are counted first (one small job), as they size the bitmaps. ``keep_bitmaps`` leaves
    these in the result, where a combination has them in one row."""
    bitmaps, keys, names = date_bitmaps(gold, gold.dates.count())
    spans = bitmaps.withColumn("weeks", _set_bits(names))
    if "part" in keys:
        spans = spans.groupBy("pln_id", "segment_id", "promo").agg(
            F.sum("weeks").alias("weeks"),
            F.max("undated").alias("undated"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    kept = ["undated", *names] if keep_bitmaps and "part" not in keys else []
    expected = dates.weeks_between(F.col("first_seen"), F.col("last_seen"))
    spans = spans.select(
        "pln_id", "segment_id", "promo", (F.col("weeks") + F.col("undated")).alias("weeks_present"), "first_seen", "last_seen", *kept
    )
    return spans.withColumnsRenamed(FLAT_NAMES).withColumns(
        {"expected_weeks": expected, "missing_weeks": expected - F.col("weeks_present")}
    )


def gaps(gold: Gold) -> DataFrame:
    """Combinations with missing weeks."""
    return date_presence(gold).filter(F.col("missing_weeks") > 0)


def top_gaps(gold: Gold, n: int = 5) -> DataFrame:
    return gaps(gold).orderBy(F.desc("missing_weeks"), "pln", "seg", "promo").limit(n)


def gap_summary(gold: Gold) -> DataFrame:
    """Dates in the facts (a missing one counts as one more), and combinations with missing weeks:
    both from the bitmaps, which read the facts once."""
    presence = date_presence(gold, keep_bitmaps=True)
    names = [c for c in presence.columns if c.startswith("bits_")]
    with_gaps = F.count_if(F.col("missing_weeks") > 0).alias("combinations_with_gaps")
    if names:
        found = presence.agg(*[F.coalesce(F.bit_or(n), F.lit(0)).alias(n) for n in names], F.max("undated").alias("undated"), with_gaps)
        dates_there = (_set_bits(names) + F.coalesce("undated", F.lit(0))).alias("unique_dates")
        found = found.select(dates_there, "combinations_with_gaps")
    else:
        keys = gold.fact.select("date_key").distinct().join(gold.dates, "date_key", "left")
        found = keys.agg(count_values("full_date").alias("unique_dates")).withColumn(
            "combinations_with_gaps", presence.agg(with_gaps).scalar()
        )
    return found.unpivot([], ["unique_dates", "combinations_with_gaps"], "item", "value")


def profile(gold: Gold, work: str, sketched: bool = False) -> DataFrame:
    """Shape, nulls, duplicates, amounts of zero or less, statistics and cardinality as
    one long table ``(section, item, value)``.

    The facts are read once: each distinct fact with its number is a table in the folder
    ``work`` (which the caller removes when the result has been read), and all figures
    come from that. ``sketched`` takes the quartiles from sketches (see ``describe_sketched``), for
    which the facts are read once more and no values are dealt out; all other figures stay exact."""

    def long(df: DataFrame, section: str) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
        return wide.unpivot([], wide.columns, "item", "value").select(F.lit(section).alias("section"), "item", "value")

    facts = written(fact_counts(gold.fact), f"{work}/facts")
    counted = Gold(facts, gold.dates, gold.products, gold.segments)
    nulls = null_counts(counted).select(
        F.lit("nulls").alias("section"),
        F.col("column_name").alias("item"),
        F.col("null_count").cast("double").alias("value"),
    )
    stats = describe_sketched(gold) if sketched else describe(counted, work)
    figures = [c for c in stats.columns if c != "column_name"]
    described = (
        stats.select("column_name", *[F.col(c).cast("double").alias(c) for c in figures])
        .unpivot("column_name", figures, "figure", "value")
        .select(F.lit("describe").alias("section"), F.concat_ws(".", "column_name", "figure").alias("item"), "value")
    )
    # Flat rows are equal exactly when their facts are.
    sums = facts.agg(
        _total(facts, F.col("n") > 1).alias("duplicate_rows"),
        _total(facts, F.col("actual_sales") <= 0).alias("nonpositive_rows"),
    )
    return _union(
        [
            long(shape(counted), "shape"),
            nulls,
            long(sums.select("duplicate_rows"), "duplicates"),
            long(sums.select("nonpositive_rows"), "anomalies"),
            described,
            long(cardinality(counted), "cardinality"),
        ]
    )


def showcase(raw: DataFrame) -> DataFrame:
    """Each distinct valid raw row next to what the load makes of it: ``raw_*`` texts
    and silver columns. Copies go first, on the raw columns alone (and the texts of those that are
    none), as the cleaned ones follow from them; then the raw texts ride along in a struct, which
    no step touches."""
    names = {c: f"raw_{c.strip(',').lower()}" for c in raw.columns}
    kinds = dict(raw.dtypes)
    texts = [F.col(f"`{c}`").cast("string").alias(n) for c, n in names.items() if kinds[c] != "string"]
    shown = raw.withColumn("before", F.struct(F.lit(None).cast("string").alias("none"), *texts))
    distinct = drop_copies(shown)
    before = [(F.col(f"`{c}`") if kinds[c] == "string" else F.col(f"before.{n}")).alias(n) for c, n in names.items()]
    tagged = clean(distinct.withColumn("before", F.struct(*before)))
    after = healed_rows(valid_rows(tagged), golden_records(valid_rows(clean(shown))))
    return after.select("before.*", *[c for c in after.columns if c != "before"])
