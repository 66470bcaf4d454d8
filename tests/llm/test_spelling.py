import random
import re
import string
import zlib

import pytest
from pyspark.sql import functions as F

from saleslake.llm import spelling
from saleslake.llm.spelling import near_after, near_words, prefixes, spelling_groups
from tests.llm.odd import documents, odd_documents

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near(a, b):
    """Whether two words differ by one letter put in, taken out or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plainly(rows, min_length=7, min_count=2, times=10):
    n = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] = n.get(run, 0) + 1
    n = {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}
    by_rest = {}
    for w in n:
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    out = {}
    for w in n:
        close = {v for i in range(len(w)) for v in by_rest[w[:i] + w[i + 1 :]]} | by_rest.get(w, set())
        close |= {w[:i] + w[i + 1 :] for i in range(len(w))} & set(n)
        close = {v for v in close if near(w, v)}
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= times * n[w] else None
        out[w] = (form, n[w], len(close), n[form] if form else None)

    def root(w):
        return w if out[w][0] is None else root(out[w][0])

    return {w: (form, root(w), k, m, form_n) for w, (form, k, m, form_n) in out.items()}


def groups(df, **parameters):
    rows = spelling_groups(df, **parameters).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("letters", ["ab", "abé", string.ascii_lowercase[:6]])
def test_scan_of_a_sorted_list(letters):
    draw = random.Random(len(letters))
    for _ in range(40):
        words = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(0, 7))) for _ in range(120)})
        lcp = prefixes(words)
        for fixed in (0, 1, 3):
            for w in [*words, "ab", "b" * 9]:
                want = [v for v in words if v > w and len(w) >= fixed and len(v) >= fixed and v[:fixed] == w[:fixed] and near(w, v)]
                assert list(near_after(w, words, lcp, fixed)) == want
    assert list(near_after("a", [], [], 0)) == []


def test_a_scan_skips_whole_ranges():
    """Of a list whose words share one letter with the query, few are looked at."""

    class Counted(list):
        looked = 0

        def __getitem__(self, i):
            Counted.looked += 1
            return super().__getitem__(i)

    words = Counted(sorted("q" + a + b + c + "zzzz" for a in string.ascii_lowercase for b in string.ascii_lowercase for c in string.ascii_lowercase))
    lcp = prefixes(list(words))
    # A search by halves looks at about 15 words; 26 letters in each of three places are tried.
    assert len(list(near_after("qaaazzzz", words, lcp, 0))) == 75
    assert Counted.looked < len(words) / 4


@pytest.mark.parametrize("bits", [3, 13])
@pytest.mark.parametrize("min_length", [1, 4, 7])
def test_near_words_over_blocks(spark, monkeypatch, bits, min_length):
    """Small blocks, a third of the words under one prefix: every pair is found once each way."""
    monkeypatch.setattr(spelling, "BLOCK_BITS", bits)
    draw = random.Random(bits + min_length)
    words = {"".join(draw.choice("abc") for _ in range(draw.randint(min_length, 9))) for _ in range(250)}
    words |= {"prefix" + "".join(draw.choice("ab") for _ in range(draw.randint(1, 6))) for _ in range(100)}
    words |= {"ü" * 40 + x for x in ("", "a", "b", "ab", "ba")} | {x + "ü" * 40 for x in ("a", "b", "ab")}
    words = {w for w in words if len(w) >= min_length}
    df = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long").repartition(7)
    rows = [(r.word, r.near) for r in near_words(df, min_length).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(a, b) for a in words for b in words if near(a, b)}


def test_whole_table_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plainly([(r.doc_id, r.text) for r in docs.collect()])
    assert any(form for form, *_ in want.values()) and groups(docs) == want


def test_chains_and_ties(spark):
    """Forms of forms end in one root; equal counts go to the least in code-point order."""
    texts = {"aaaaaaa": 2000, "aaaaaab": 150, "aaaaabb": 12, "zzzzzzé": 30, "zzzzzzz": 30, "zzzzzz": 1, "zzzzzzy": 2, "aaaabbb": 2}
    # Under these ids no run loses a letter.
    whole = {w: next(i for i in range(100) if zlib.crc32(f"{i}:{w}".encode()) % 31) for w in texts}
    rows = [(whole[w], " ".join([w] * k)) for w, k in texts.items()]
    got = groups(documents(spark, rows), times=10)
    assert got == plainly(rows)
    some = {w: k for w, k in got.items() if w in ("aaaaabb", "zzzzzzy")}
    assert some["aaaaabb"][:2] == ("aaaaaab", "aaaaaaa") and some["zzzzzzy"][:2] == ("zzzzzzz", "zzzzzzz")


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert groups(docs) == plainly(rows)
    assert groups(documents(spark, [])) == {} and groups(documents(spark, [(1, None), (2, "")])) == {}
    long = [(1, "Å" * 3000 + " " + "Å" * 3000), (2, "Å" * 2999 + " " + "Å" * 2999), (3, "× ÷÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷÷")]
    assert groups(documents(spark, long)) == plainly(long)


def test_blocks_stay_few(spark):
    total = 10**9
    bits = max(spelling.BLOCK_BITS, (total // spelling.MAX_BLOCKS).bit_length())
    assert total >> bits < spelling.MAX_BLOCKS and bits < 33


def test_counts_run_in_the_jvm(spark):
    plan = spelling.vocabulary(odd_documents(spark).select("doc_id", F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas") if w in plan]
