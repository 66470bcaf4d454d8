"""Secret scans by one automaton for all rules."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from saleslake.llm.automaton import Rule, Scanner
from saleslake.llm.tables import slices, with_computed

BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6, True),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
]
MORE = [
    Rule("github", "gh(p|o|u|s|r)_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox(a|b|p|r|s)-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("stripe", "(sk|rk)_live_", "[A-Za-z0-9]", 24),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY", "-", 5),
    # The key itself: its lines, those of an encrypted one, and line ends, indents and quotes as in source code.
    Rule("private_key_body", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", r"""[A-Za-z0-9+/=:,"'\\\x20\t\r\n-]""", 1),
]
RULES = BASE + MORE
#: Ends of keys, found by the same automaton; no secrets by themselves.
ENDS = Rule("private_key_end", "-----END ([A-Z]+ )*PRIVATE KEY", "-", 5)
CHUNK = 4_000_000
HEADER, BODY, END = [r.kind for r in RULES].index("private_key"), [r.kind for r in RULES].index("private_key_body"), len(RULES)
#: What a key that is cut off begins with: a DER sequence, OpenSSH's magic, headers of encryption, or 64 characters.
BEGUN = re.compile(rb"""[\s\\"'rn+]*(?:M[A-P]|b3Bl|Proc-Type|[A-Za-z0-9+/=]{64})""")
LINE = b"PRIVATE KEY-----"


@cache
def scanner() -> Scanner:
    return Scanner([*RULES, ENDS])


def _keys(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Whole private keys: from each header to the first END line after it within the run of the
    body's characters. A key that is cut off goes on to the end of the run, if it begins as keys do.
    Headers, END lines and runs, each in order, are merged in one pass."""
    headers, ends, runs = (sorted((s, e) for r, s, e in spans if r == rule) for rule in (HEADER, END, BODY))
    found, at, next_end, next_run = [], 0, 0, 0
    for start, _ in headers:
        while next_run < len(runs) and runs[next_run][1] <= start:
            next_run += 1
        if start < at or next_run == len(runs) or runs[next_run][0] > start:
            continue
        after, limit = data.index(LINE, start) + len(LINE), runs[next_run][1]
        while next_end < len(ends) and ends[next_end][0] < after:
            next_end += 1
        end = data.index(LINE, ends[next_end][0]) + len(LINE) if next_end < len(ends) else limit + 1
        if end <= limit:
            at = end
        elif BEGUN.match(data, after, limit):
            at = limit
        else:
            continue
        found.append((BODY, start, at))
    return found


def spans_of(texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of each text by start, then kind as listed; code points."""
    out, todo, size = [], [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        todo.append(data)
        size += len(data)
        if size >= CHUNK:
            out += scanner().scan(todo)
            todo, size = [], 0
    out += scanner().scan(todo)
    result = []
    for text, spans in zip(texts, out):
        if any(r in (BODY, END) for r, *_ in spans):
            keys = _keys(text.encode("utf-8", "surrogatepass"), spans)
            spans = [x for x in spans if x[0] not in (BODY, END)] + keys
        if spans and not text.isascii():
            data = text.encode("utf-8", "surrogatepass")
            # Code points begin at bytes that do not continue one.
            points = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
            spans = [(r, *(int(points[at - 1]) if at else 0 for at in (s, e))) for r, s, e in spans]
        result.append([(RULES[r].kind, s, e) for s, r, e in sorted((s, r, e) for r, s, e in spans)])
    return result


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """The rows with the spans of all rules in ``into``, an array of (kind, start, end).

    Null and empty texts have none. Every row is looked at alone: repeated rows repeat their
    spans, an empty table stays empty. A column already named ``into`` is replaced.
    """
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(texts: pa.Array) -> pa.Array:
        spans = spans_of([t or "" for t in texts.to_pylist()])
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], arrow)

    return with_computed(docs, text, into, T.ArrayType(span), scan)


def span_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row of documents.

    A null or empty text has no spans, and the digest of the empty text. Rows that repeat an id or a
    whole row give a row each, a null id stays null, an empty table stays empty."""
    base = [r.kind for r in BASE]

    def joined(spans) -> str:
        return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = spans_of([t or "" for t in batch.column("text").to_pylist()])
            of_base = [[x for x in row if x[0] in base] for row in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([sum(x[0] == k for x in row) for row in of_base], pa.int64()) for k in base),
                    pa.array([hashlib.sha256(joined(row).encode()).hexdigest() for row in of_base], pa.string()),
                    pa.array([joined(row) for row in spans], pa.string()),
                ],
                ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digest, schema)


def masked(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every span of a secret replaced; overlapping spans become one mask.

    A null text stays null. ``n_chars``, where it is there, follows the new text.
    """

    def clean(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        for i, spans in enumerate(spans_of([t or "" for t in texts])):
            if spans:
                parts, at = [], 0
                for _, start, end in spans:
                    if start >= at:
                        parts += [texts[i][at:start], mask]
                    at = max(at, end)
                texts[i] = "".join([*parts, texts[i][at:]])
        return pa.array(texts, pa.string())

    out = with_computed(docs, text, text, T.StringType(), clean)
    if "n_chars" in docs.columns:
        counted = F.length(text).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(text).isNull(), F.col("n_chars")).otherwise(counted))
    return out
