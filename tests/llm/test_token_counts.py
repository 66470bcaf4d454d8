import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from saleslake.llm import token_counts
from saleslake.llm.token_counts import SEPARATOR, count_tokens, document_token_counts, flat_blocks, write_token_files
from tests.llm.odd import documents, odd_documents, odd_rows


def brute(file, ids):
    out, start, ordinal = [], 0, 0
    for i, x in enumerate(ids):
        if x == SEPARATOR:
            out.append((file, ordinal, start, i - start, True))
            start, ordinal = i + 1, ordinal + 1
    return out + ([(file, ordinal, start, len(ids) - start, False)] if start < len(ids) else [])


def files(seed):
    rng = random.Random(seed)
    out = {str(f): [rng.choice([SEPARATOR, 1, 2, 3]) for _ in range(rng.randint(0, 3000))] for f in range(3)}
    return out | {"none": [7] * 100, "all": [SEPARATOR] * 50, "empty": []}


def counted(blocks):
    return sorted(map(tuple, count_tokens(blocks).select("file", "ordinal", "start", "n_tokens", "ended").collect()))


def test_documents_run_across_blocks(spark, monkeypatch):
    monkeypatch.setattr("saleslake.llm.token_counts.SEGMENT", 7)
    rng, rows, want = random.Random(1), [], []
    for file, ids in files(1).items():
        want += brute(file, ids)
        at = block = 0
        while at < len(ids):
            n = rng.choice([0, 1, 3, 5])
            rows.append((file, block, np.array(ids[at : at + n], dtype="<u2").tobytes()))
            at, block = at + n, block + 1
        rows.append((file, block, None))
    assert counted(spark.createDataFrame(rows, "file string, block long, data binary")) == sorted(want)


def test_flat_files(spark, folder):
    want = []
    for file, ids in files(2).items():
        with open(f"{folder}/{file}.bin", "wb") as out:
            out.write(np.array(ids, dtype="<u2").tobytes())
        want += [(file, *row[1:]) for row in brute(file, ids)]
    got = [(f.rsplit("/", 1)[-1].removesuffix(".bin"), *rest) for f, *rest in counted(flat_blocks(spark, folder, block_ids=64))]
    assert sorted(got) == sorted(want)


def test_counts_are_those_of_the_tokenizer(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    out = document_token_counts(odd_documents(spark)).collect()
    assert len(out) == 12
    of = {r.doc_id: r.n_tokens for r in out}
    for doc_id, text, *_ in odd_rows():
        if doc_id is not None:
            assert of[doc_id] == (len(library.encode(text, add_special_tokens=False).ids) if text else 0)
    assert document_token_counts(documents(spark, [])).collect() == []


def test_no_blocks(spark):
    assert counted(spark.createDataFrame([], "file string, block long, data binary")) == []


def test_a_flat_file_longer_than_a_row_may_be(spark, folder):
    at, ids = [5, (1 << 30) + 7, (1 << 30) + 9], (1 << 30) + 12  # over 2 GB, most of it a hole
    with open(f"{folder}/long.bin", "wb") as out:
        out.truncate(2 * ids)
        for i in at:
            out.seek(2 * i)
            out.write(SEPARATOR.to_bytes(2, "little"))
    blocks = flat_blocks(spark, folder)
    assert blocks.rdd.getNumPartitions() == -(-2 * ids // token_counts.RANGE_BYTES)
    assert [row[1:] for row in counted(blocks)] == [(0, 0, 5, True), (1, 6, (1 << 30) + 1, True), (2, (1 << 30) + 8, 1, True), (3, (1 << 30) + 10, 2, False)]


def closed(path):
    raise OSError("no such store")


@pytest.mark.parametrize("spark_only", [False, True])
def test_ranges_of_flat_files(spark, folder, monkeypatch, spark_only):
    monkeypatch.setattr(token_counts, "RANGE_BYTES", 640)
    if spark_only:
        monkeypatch.setattr(token_counts, "_opened", closed)
    want = []
    for file, ids in files(3).items():
        with open(f"{folder}/a, b{{{file}}} *.bin", "wb") as out:
            out.write(np.array(ids, dtype="<u2").tobytes())
        want += [(f"a, b{{{file}}} *.bin", *row[1:]) for row in brute(file, ids)]
    got = [(f.rsplit("/", 1)[-1], *rest) for f, *rest in counted(flat_blocks(spark, folder, block_ids=64))]
    assert sorted(got) == sorted(want)


def test_the_query_counts_flat_files(spark, folder):
    write_token_files(odd_documents(spark).coalesce(2), f"{folder}/flat")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    lengths = [len(library.encode(text, add_special_tokens=False).ids) if text else 0 for _, text, *_ in odd_rows()]
    out = counted(flat_blocks(spark, f"{folder}/flat/kind=0", block_ids=16))
    assert sorted(n for *_, n, _ in out) == sorted(lengths) and all(ended for *_, ended in out)
