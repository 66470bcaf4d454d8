import hashlib
import random
import re
import time

import pytest

from saleslake.llm.automaton import Rule, Scanner
from saleslake.llm.secrets import find_secrets, masked, span_digests, spans_of
from tests.llm.odd import documents, odd_documents, odd_rows

# By regular expressions: kind, expression, and what makes a match count.
PLAIN = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", "AKIA([A-Z0-9]+)", 16),
    ("hex", "([0-9a-f]+)", 24),
    ("github", "gh[pousr]_([A-Za-z0-9]+)", 36),
    ("slack", "xox[abprs]-([A-Za-z0-9-]+)", 10),
    ("google", "AIza([A-Za-z0-9_-]+)", 35),
    ("stripe", "(?:sk|rk)_live_([A-Za-z0-9]+)", 24),
    ("private_key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY(-+)", 5),
]
BITS = [
    "password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "abc", "0123456789abcdef",
    "deadbeef", "AKIA", "AKIAAKIA", "ABCDEFGH12345678", "é", "\n", "ghp_", "a" * 36, "xoxb-", "AIza", "sk_live_",
    "-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "x", "日", "==", ".", "-", "\x00",
]


def plain(text):
    spans = []
    for i, (kind, expression, least) in enumerate(PLAIN):
        spans += [(m.start(), i, m.end(), kind) for m in re.finditer(expression, text or "") if len(m[1]) >= least]
    return [(kind, start, end) for start, _, end, kind in sorted(spans)]


def digest(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@pytest.mark.parametrize("seed", range(3))
def test_spans_are_those_of_regular_expressions(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    assert spans_of(texts) == [plain(t) for t in texts]


def test_lanes_agree_with_one_long_text():
    text = "".join(random.Random(9).choice(BITS) for _ in range(60_000))
    assert spans_of([text]) == [plain(text)]


def test_a_rule_set_of_ones_own():
    scanner = Scanner([Rule("a", "(x|yz)?q{2}", "[0-9]", 2), Rule("b", "", "[z]", 1)])
    assert scanner.scan([b"qq12 xqq345 yzqq9zz", b"", b"z"]) == [[(0, 0, 4), (0, 5, 11), (1, 13, 14), (1, 17, 19)], [], [(1, 0, 1)]]


def test_digests(spark):
    rows = {}
    for r in span_digests(odd_documents(spark)).collect():
        rows.setdefault(r.doc_id, r)
    for doc_id, text, *_ in odd_rows():
        if doc_id is None:
            continue
        spans, r = plain(text), rows[doc_id]
        base = [x for x in spans if x[0] in ("assign", "access", "hex")]
        assert r.spans == digest(spans) and r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in base) for k in ("assign", "access", "hex"))
    assert span_digests(documents(spark, [])).collect() == []


def test_spans_keep_all_columns(spark):
    out = find_secrets(odd_documents(spark))
    assert out.count() == 12 and set(out.columns) == set(odd_documents(spark).columns)
    assert [tuple(s) for s in out.filter("doc_id = 7").first().secret_spans] == plain(odd_rows()[9][1])


def test_masks(spark):
    rows = [(1, "a token=abcdef0123456789abcdef0123 b"), (2, None), (3, ""), (4, "clean")]
    out = {r.doc_id: r for r in masked(documents(spark, rows)).collect()}
    assert out[1].text == "a [SECRET] b" and out[1].n_chars == 12
    assert (out[2].text, out[3].text, out[4].text) == (None, "", "clean")
    assert masked(odd_documents(spark)).count() == 12
    assert masked(documents(spark, [])).collect() == []


LINES = ["MIIEpAIBAAKCAQEA" + "x9+/" * 12, "Qz8w" * 16, "Zm9vYmFyCg=="]
KEYS = {
    "plain": "\n".join(["-----BEGIN PRIVATE KEY-----", *LINES, "-----END PRIVATE KEY-----"]),
    "windows": "\r\n".join(["-----BEGIN EC PRIVATE KEY-----", *LINES, "-----END EC PRIVATE KEY-----"]),
    "indented": "\n\t  ".join(["-----BEGIN OPENSSH PRIVATE KEY-----", *LINES, "-----END OPENSSH PRIVATE KEY-----"]),
    "json": r"\n".join(["-----BEGIN RSA PRIVATE KEY-----", *LINES, "-----END RSA PRIVATE KEY-----"]),
    "code": '\\n" +\n  "'.join(["-----BEGIN RSA PRIVATE KEY-----", *LINES, "-----END RSA PRIVATE KEY-----"]),
    "encrypted": "\n".join(
        ["-----BEGIN RSA PRIVATE KEY-----", "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,6E1F0A", "", *LINES, "-----END RSA PRIVATE KEY-----"]
    ),
}


@pytest.mark.parametrize("form", KEYS)
def test_masks_cover_whole_private_keys(spark, form):
    key = KEYS[form]
    texts = [f"é before {key} after it", f"two\n{key}\nand\n{key}\nend", "cut off " + key[: key.index("-----END")], key]
    out = {r.doc_id: r.text for r in masked(documents(spark, list(enumerate(texts, 1)))).collect()}
    assert out == {1: "é before [SECRET] after it", 2: "two\n[SECRET]\nand\n[SECRET]\nend", 3: "cut off [SECRET]", 4: "[SECRET]"}


def test_a_header_without_a_key_is_masked_alone():
    for after in ("; no key", " here: ...", " Many more", ""):
        assert spans_of([f"-----BEGIN PRIVATE KEY-----{after}"]) == [[("private_key", 0, 27)]]


def test_keys_without_line_ends():
    for after in ("".join(LINES), "".join(LINES) + "-----END PRIVATE KEY-----", "MIIE-----END PRIVATE KEY-----"):
        text = "-----BEGIN PRIVATE KEY-----" + after
        assert ("private_key_body", 0, len(text)) in spans_of([text])[0]


@pytest.mark.parametrize("line", ["-----BEGIN PRIVATE KEY-----\n", "-----END PRIVATE KEY-----\n", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----\nx "])
def test_headers_without_keys_take_linear_time(line):
    """Two megabytes of lines that each could begin a key, before and after text of other alphabets."""
    spans_of([line])  # the automaton is built once
    started = time.perf_counter()
    found = spans_of(["é" + line * (2_000_000 // len(line)) + "é"])[0]
    assert time.perf_counter() - started < 6
    assert {k for k, *_ in found} <= {"private_key", "private_key_body"}


def test_keys_against_plain_python():
    """Random runs of headers, ends, bodies and other text: from each header to its END line."""
    draw = random.Random(8)
    bits = ["-----BEGIN PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----", "-----END PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----",
            "MIIEvQ", "Proc-Type: 4,ENCRYPTED", "\n", " ", "é", "A" * 64, "short", "!", "------"]
    key = re.compile(
        r"""-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=:,"'\\\x20\t\r\n-]*?-----END (?:[A-Z]+ )*PRIVATE KEY-----|"""
        r"""[\s\\"'rn+]*(?:M[A-P]|b3Bl|Proc-Type|[A-Za-z0-9+/=]{64})[A-Za-z0-9+/=:,"'\\\x20\t\r\n-]*)"""
    )
    for _ in range(4000):
        # Every line of dashes stands alone, so that no two share theirs.
        text = "".join(x + "\n" * (x.startswith("-")) for x in (draw.choice(bits) for _ in range(draw.randint(0, 12))))
        got = [(s, e) for k, s, e in spans_of([text])[0] if k == "private_key_body"]
        assert got == [m.span() for m in key.finditer(text)], text
