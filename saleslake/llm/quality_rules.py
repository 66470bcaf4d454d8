"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text gets a few counts. Per language and source, mergeable quantile sketches of four ratios
(counts of values rounded down to five significant bits) give a level, the median, and a spread, from
there to the outermost tenth; a text whose ratio lies REACH spreads beyond the level is rejected.

- The spread of a language, and of all texts, is the median of those of its sources, each counted
  as its texts, so that sources where over a tenth is junk do not widen it, as long as they hold
  less than half of the texts. A source's own spread holds where it is smaller, and counts as its
  texts against SHRINK of the language.
- The level of a source lies beyond that of its language as far as its texts prove it: the end of
  the interval of two standard errors around its median. Five texts are needed for that, and for
  a language to have a level of its own.
- A handful of events (ALLOWED) is no evidence in a short text and is taken off before a text's
  ratio meets its bound. Nothing else is added to a bound but the width of a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from saleslake.llm.tables import quoted, small_side, written

SPACE = "[\\x20\\x09-\\x0D]"
NO_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
#: Spreads between the level of a group and its bound.
REACH = 5
#: Texts as which the spread of the language counts in that of a source, and that of all in that of a language.
SHRINK = 50
#: Up to so many texts prove no level of their own.
FEW = 4
#: Three events: symbols, lines, or pairs of equal three-word windows. They are taken off a text's counts.
ALLOWED = {"symbols": 3, "dup_lines": 3, "repeats": 18, "length": 0}
METRICS = list(ALLOWED)
#: The bounds of a group: one for each ratio, and the lower one of the word length.
BOUNDS = [*METRICS, "short"]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that the text holds twice or more: sorted windows, their
    equal neighbours, then the union of the places of those."""
    n = F.size(words)
    windows = F.slice(
        F.arrays_zip(words, F.slice(words, 2, n), F.slice(words, 3, n), F.sequence(F.lit(0), n - 1)),
        1,
        F.greatest(n - 2, F.lit(0)),
    )

    def places(s: Column) -> Column:
        m = F.greatest(F.size(s) - 1, F.lit(0))
        pairs = F.arrays_zip(F.slice(s, F.lit(1), m), F.slice(s, F.lit(2), m))
        equal = F.filter(
            pairs, lambda p: (p["0"]["0"] == p["1"]["0"]) & (p["0"]["1"] == p["1"]["1"]) & (p["0"]["2"] == p["1"]["2"])
        )
        return F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda p: F.array(p["0"]["3"], p["1"]["3"])))))

    def covered(at: Column) -> Column:
        m = F.greatest(F.size(at) - 1, F.lit(0))
        steps = F.arrays_zip(F.slice(at, F.lit(1), m), F.slice(at, F.lit(2), m))
        return F.when(F.size(at) == 0, 0).otherwise(
            F.aggregate(steps, F.lit(3), lambda total, s: total + F.least(F.lit(3), s["1"] - s["0"]))
        )

    # The zipped fields are named by place; sequence(0, -1) would count down, so no words, no windows.
    named = F.when(n < 3, F.lit(0)).otherwise(
        _let(F.sort_array(windows.cast("array<struct<`0`:string,`1`:string,`2`:string,`3`:int>>")), lambda s: _let(places(s), covered))
    )
    return named.cast("long")


def text_stats(text: Column) -> Column:
    """A struct of the counts in STATS; all 0 for a null or empty text."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE))
    dup_lines = _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))
    counts = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    return _let(
        counts,
        lambda c: F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            dup_lines.cast("long").alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def _base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _ratios(s: Column, allowed: dict[str, int]) -> Column:
    """Events per 1,000 words, characters per 100 words, without the events allowed."""
    words = F.greatest(s["n_words"], F.lit(1).cast("long"))

    def per(count: str, unit: int, metric: str) -> Column:
        events = F.greatest(s[count] - allowed[metric], F.lit(0).cast("long"))
        return F.floor(events * unit / words).cast("long").alias(metric)

    return F.struct(
        per("n_symbols", 1000, "symbols"),
        per("n_dup_lines", 1000, "dup_lines"),
        per("n_repeat_words", 1000, "repeats"),
        per("word_chars", 100, "length"),
    )


def _low_bits(value: Column) -> Column:
    """Bits below the five significant ones."""
    return F.greatest(F.length(F.bin(value)) - 5, F.lit(0)).cast("int")


def _bucket(value: Column) -> Column:
    """The value rounded down to five significant bits."""
    drop = _low_bits(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _top(bucket: Column) -> Column:
    """The greatest value of a bucket."""
    return bucket + F.call_function("shiftleft", F.lit(1).cast("long"), _low_bits(bucket)) - 1


def sketches(judged: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, n``: one sketch per group and ratio, of the texts that pass the
    base rules. Sketches of parts of the rows are merged by adding their ``n``."""
    metrics = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col("ratios")[m].alias("value")) for m in METRICS)))
    # Counted by condition: a filter on the texts' counts would be moved below them and count twice.
    rows = judged.select("lang", "source", "base_failed", metrics.alias("m"))
    counted = rows.groupBy("lang", "source", F.col("m.metric").alias("metric"), _bucket(F.col("m.value")).alias("bucket"))
    return counted.agg(F.count_if(~F.col("base_failed")).alias("n")).filter("n > 0")


def _marks(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``bound, n, level, proven, spread`` per group and bound of BOUNDS, from quantiles of the
    merged sketches. A bucket stands for its end that makes a bound wider."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    upto = F.sum("n").over(group.orderBy("bucket"))
    ranked = merged.withColumns({"upto": upto, "total": F.sum("n").over(group)})
    past, two_errors = 2 * F.col("upto") - F.col("total"), 2 * F.sqrt("total")

    def first(reached: Column, value: Column) -> Column:
        return F.min(F.when(reached, value))

    bucket, top = F.col("bucket"), _top(F.col("bucket"))
    marks = ranked.groupBy(*keys, "metric", F.col("total").alias("n")).agg(
        first(10 * F.col("upto") >= F.col("total"), bucket).alias("low"),
        first(past >= -two_errors, bucket).alias("least"),
        first(past >= 0, bucket).alias("mid"),
        first(past >= 0, top).alias("mid_top"),
        first(past >= two_errors, top).alias("most"),
        first(10 * F.col("upto") >= 9 * F.col("total"), top).alias("high"),
    )
    c = F.col

    def mark(bound: Column, level: str, proven: str, spread: Column) -> Column:
        return F.struct(bound.alias("bound"), c(level).alias("level"), c(proven).alias("proven"), spread.alias("spread"))

    above = mark(c("metric"), "mid", "least", c("high") - c("mid"))
    below = mark(F.lit("short"), "mid_top", "most", c("mid_top") - c("low"))
    ends = F.when(c("metric") == "length", F.array(above, below)).otherwise(F.array(above))
    return marks.select(*keys, "n", F.explode(ends).alias("m")).select(*keys, "n", "m.*")


def _usual_spread(by_source: DataFrame, keys: list[str]) -> DataFrame:
    """The median of the sources' spreads, each counted as its texts. Equal spreads are added up
    first, so however many sources there are, few rows are ranked."""
    merged = by_source.groupBy(*keys, "bound", "spread").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "bound")
    ranked = merged.withColumns({"upto": F.sum("n").over(group.orderBy("spread")), "total": F.sum("n").over(group)})
    return ranked.filter("2 * upto >= total").groupBy(*keys, "bound").agg(F.min("spread").alias("spread"))


def _as_struct(levels: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One struct of all bounds per group."""
    c = F.col
    value = F.when(c("bound") == "short", c("level") - REACH * c("spread")).otherwise(c("level") + REACH * c("spread"))
    one = [F.max(F.when(c("bound") == b, value)).alias(b) for b in BOUNDS]
    return (levels.groupBy(*keys) if keys else levels.groupBy()).agg(F.struct(*one).alias(name))


def thresholds(sketch: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bounds per language and source, per language, and of all; groups without a text that passes
    the base rules have none."""
    by_source = written(_marks(sketch, ["lang", "source"]), "marks")
    of_all = _marks(sketch, []).select("bound", "level").join(_usual_spread(by_source, []), "bound")
    of_all = written(of_all, "of_all")
    wider = of_all.select("bound", F.col("level").alias("wide_level"), F.col("spread").alias("wide_spread"))
    by_lang = _marks(sketch, ["lang"]).drop("spread").join(_usual_spread(by_source, ["lang"]), ["lang", "bound"]).join(wider, "bound")
    by_lang = written(
        by_lang.select(
            "lang",
            "bound",
            F.when(F.col("n") > FEW, F.col("level")).otherwise(F.col("wide_level")).alias("level"),
            F.expr(f"(n * spread + {SHRINK} * wide_spread) div (n + {SHRINK})").alias("spread"),
        ),
        "by_lang",
    )
    wider = by_lang.select("lang", "bound", F.col("level").alias("wide_level"), F.col("spread").alias("wide_spread"))
    own = F.when(F.col("n") > FEW, F.col("proven"))
    outer = F.when(F.col("bound") == "short", F.least("wide_level", own)).otherwise(F.greatest("wide_level", own))
    by_source = by_source.join(wider, ["lang", "bound"]).select(
        "lang",
        "source",
        "bound",
        outer.alias("level"),
        F.expr(f"(n * least(spread, wide_spread) + {SHRINK} * wide_spread) div (n + {SHRINK})").alias("spread"),
    )
    return (
        _as_struct(by_source, ["lang", "source"], "bounds_source"),
        _as_struct(by_lang, ["lang"], "bounds_lang"),
        _as_struct(of_all, [], "bounds_all"),
    )


def judge(docs: DataFrame, carry: list[str], store: bool) -> DataFrame:
    """Structs ``kept_columns`` (those carried) and ``verdict`` (STATS, base_failed, kept).

    A null or empty text has no words and fails. A null language or source is a group of its own
    (as the empty name). Repeated rows count as often as they occur; an empty table stays empty.
    Carried columns are packed away meanwhile, so their names may be any. Sketches and verdicts
    both need the counts: with ``store`` they are written with the carried columns (best when
    those are short), else the texts are counted twice, which needs no second copy of them.
    """
    s = F.col("s")
    counted = docs.select(
        F.struct(*quoted(carry)).alias("kept_columns"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        text_stats(F.col("text")).alias("s"),
    )
    judged = (written(counted, "quality") if store else counted).withColumns(
        {"base_failed": _base_failed(s), "ratios": _ratios(s, dict.fromkeys(METRICS, 0)), "excess": _ratios(s, ALLOWED)}
    )
    by_source, by_lang, of_all = thresholds(written(sketches(judged), "sketches"))
    widest = of_all.first()["bounds_all"]  # five numbers; null where no text passed the base rules
    last = F.struct(*(F.lit(None if widest is None else widest[m]).cast("long").alias(m) for m in BOUNDS))
    bounds = F.coalesce("bounds_source", "bounds_lang", last)
    joined = judged.join(small_side(by_source, "by_source"), ["lang", "source"], "left").join(small_side(by_lang, "by_lang"), ["lang"], "left")
    joined = joined.withColumn("b", bounds)
    b, r = F.col("b"), F.col("excess")
    inside = (r["length"] <= b["length"]) & (r["length"] >= b["short"])
    for metric in ("symbols", "dup_lines", "repeats"):
        inside = inside & (r[metric] <= b[metric])
    # The least of two numbers, so that neither half is moved below the join and counted again.
    kept = F.least((~F.col("base_failed")).cast("int"), F.coalesce(inside, F.lit(True)).cast("int")) == 1
    verdict = F.struct(*(s[c].alias(c) for c in STATS), F.col("base_failed"), kept.alias("kept"))
    return joined.select("kept_columns", verdict.alias("verdict"))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row of documents."""
    return judge(docs, ["doc_id"], store=True).select("kept_columns.doc_id", "verdict.*")


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with their columns as they came."""
    return judge(docs, docs.columns, store=False).filter("verdict.kept").select("kept_columns.*")
