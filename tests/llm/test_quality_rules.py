import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from saleslake.llm.quality_rules import BOUNDS, FEW, METRICS, REACH, SHRINK, STATS, drop_low_quality, quality_verdicts, sketches, text_stats, thresholds
from tests.llm.odd import WORD, documents, odd_documents, odd_rows


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    bits = ["a", "b", "a b c", "é😀", " ", "\n", "\t", "#", "$$", "a b a b a b", "\x0b", "\x1c", "\x85", "line\n", "line\n"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [row[1] for row in odd_rows()]
    df = documents(spark, list(enumerate(texts))).withColumn("s", text_stats(F.col("text")))
    for r in df.collect():
        assert tuple(r.s[c] for c in STATS) == brute(r.text)


def prose(rng, n, words="abcdefghijklmnopqrstuvwxyz"):
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture
def mixed(spark):
    rng, rows = random.Random(3), []
    for i in range(300):
        text = prose(rng, 80)
        if i % 10 == 1:
            text = text.replace(" ", "### ")
        if i % 10 == 2:
            text = prose(rng, 20)
        rows.append((i, text, "en", f"s{i % 2}", 0))
    # A source whose texts all hold symbols: normal there.
    rows += [(1000 + i, prose(rng, 80).replace(" ", " | "), "en", "tables", 0) for i in range(150)]
    # A thin source takes the bounds of its language.
    rows += [(2000, prose(rng, 80), "en", "thin", 0), (2001, prose(rng, 80).replace(" ", "$$ "), "xx", None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_thresholds_follow_the_source(mixed):
    out = {r.doc_id: r for r in quality_verdicts(mixed).collect()}
    assert all(out[i].kept == (i % 10 not in (1, 2)) for i in range(300))
    assert all(out[i].base_failed == (i % 10 == 2) for i in range(300))
    assert all(out[1000 + i].kept for i in range(150))
    assert out[2000].kept


def judged(spark, rows):
    """(lang, source, four ratios) as texts that pass the base rules, and one that does not."""
    rows = [(lang, source, ratios, False) for lang, source, ratios in rows] + [("en", "a", (9999,) * 4, True)]
    ratios = ", ".join(f"{m}: bigint" for m in METRICS)
    return spark.createDataFrame(rows, f"lang string, source string, ratios struct<{ratios}>, base_failed boolean")


def ends(values):
    """{bound: (level, proven, spread)} of the values of a group, from their sorted buckets."""
    out = {}
    for m, found in zip(METRICS, zip(*values)):
        width = [1 << max(v.bit_length() - 5, 0) for v in found]
        low = sorted(v // w * w for v, w in zip(found, width))
        top = sorted(v // w * w + w - 1 for v, w in zip(found, width))
        n = len(low)
        at = [i for i in range(n) if i == n - 1 or low[i] != low[i + 1]]  # last of each bucket

        def first(reached):
            return next(i for i in at if reached(i + 1))

        mid, high, tenth = first(lambda u: 2 * u >= n), first(lambda u: 10 * u >= 9 * n), first(lambda u: 10 * u >= n)
        out[m] = low[mid], low[first(lambda u: 2 * u - n >= -2 * math.sqrt(n))], top[high] - low[mid]
        if m == "length" and n > FEW:
            out["short"] = top[mid], top[first(lambda u: 2 * u - n >= 2 * math.sqrt(n))], top[mid] - low[tenth]
        elif m == "length":
            out["short"] = top[mid], None, top[mid] - low[tenth]
    return out


def brute_bounds(rows):
    groups, langs = defaultdict(list), defaultdict(list)
    for lang, source, ratios in rows:
        groups[lang, source].append(ratios)
        langs[lang].append(ratios)
    own = {g: ends(v) for g, v in groups.items()}

    def usual(bound, chosen):
        spreads = sorted(s for g in chosen for s in [own[g][bound][2]] * len(groups[g]))
        return spreads[(len(spreads) + 1) // 2 - 1]

    def pull(n, spread, wide):
        return (n * spread + SHRINK * wide) // (n + SHRINK)

    out, everything = {}, ends([r for _, _, r in rows])
    for b in BOUNDS:
        sign = -1 if b == "short" else 1
        level, spread = everything[b][0], usual(b, groups)
        out[None, None, b] = level + sign * REACH * spread
        for lang, values in langs.items():
            n = len(values)
            at = ends(values)[b][0] if n > FEW else level
            wide = pull(n, usual(b, [g for g in groups if g[0] == lang]), spread)
            out[lang, None, b] = at + sign * REACH * wide
            for g in [g for g in groups if g[0] == lang]:
                m, (_, proven, mine) = len(groups[g]), own[g][b]
                beyond = at if m <= FEW else min(at, proven) if b == "short" else max(at, proven)
                out[*g, b] = beyond + sign * REACH * pull(m, min(mine, wide), wide)
    return out


def bounds_of(sketch):
    by_source, by_lang, of_all = thresholds(sketch)
    out = {(None, None, b): of_all.first()["bounds_all"][b] for b in BOUNDS}
    out |= {(r.lang, None, b): r.bounds_lang[b] for r in by_lang.collect() for b in BOUNDS}
    return out | {(r.lang, r.source, b): r.bounds_source[b] for r in by_source.collect() for b in BOUNDS}


def ratio_rows(seed=8):
    """Sources of every size, with levels of their own; a fifth of one is junk."""
    rng, rows = random.Random(seed), []
    sizes = {("en", "a"): 150, ("en", "b"): 120, ("en", "c"): 60, ("en", "tiny"): 3, ("de", "a"): 40, ("de", "d"): 1, ("xx", "e"): 2}
    for k, ((lang, source), n) in enumerate(sizes.items()):
        for i in range(n):
            junk = 2500 if (lang, source) == ("en", "a") and i % 5 == 0 else 0
            near = 20 * k, 8 * k, 40 * k, 420 + 25 * k
            far = [a + b for a, b in zip(near, (4 + 10 * k, 3 + 2 * k, 40 + 10 * k, 100 + 15 * k))]
            symbols, *others = (rng.randint(a, b) for a, b in zip(near, far))
            rows.append((lang, source, (junk + symbols, *others)))
    return rows


def test_bounds_equal_brute_force_and_differ_by_source(spark):
    rows = ratio_rows()
    got = bounds_of(sketches(judged(spark, rows)))
    assert got == brute_bounds(rows)
    assert all(got["en", "a", b] != got["en", "b", b] for b in BOUNDS)
    assert got["en", "a", "symbols"] < 2500  # a fifth of junk does not widen it


def test_sketches_of_parts_merge_to_that_of_the_whole(spark):
    rows = ratio_rows(6)
    parts = sketches(judged(spark, rows[::2])).unionByName(sketches(judged(spark, rows[1::2])))
    assert bounds_of(parts) == bounds_of(sketches(judged(spark, rows)))


def test_a_handful_of_events_is_no_evidence(spark):
    """Three symbols are allowed in a text of any length, where no other text holds one; sixteen are not."""
    rng = random.Random(7)
    texts = [prose(rng, 80) for _ in range(40)]
    texts += [prose(rng, 70) + " 5 % & $ off", prose(rng, 70) + " #" * 16]
    out = {r.doc_id: r.kept for r in quality_verdicts(documents(spark, list(enumerate(texts)))).collect()}
    assert all(out[i] for i in range(41)) and not out[41]


def test_rows_that_are_kept_come_as_they_were(spark, mixed):
    kept = drop_low_quality(mixed)
    assert kept.columns == mixed.columns and kept.exceptAll(mixed).count() == 0


def test_odd_documents(spark):
    out = quality_verdicts(odd_documents(spark)).collect()
    assert len(out) == 12
    assert all(r.base_failed and not r.kept for r in out if r.doc_id in (1, 2, 3))
    assert drop_low_quality(odd_documents(spark)).columns == odd_documents(spark).columns
    empty = documents(spark, [])
    assert quality_verdicts(empty).collect() == [] and drop_low_quality(empty).collect() == []


def test_no_python_on_the_main_path(mixed):
    plan = quality_verdicts(mixed)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas") if w in plan]
