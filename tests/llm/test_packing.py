import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saleslake.llm.packing import first_fit_decreasing, pack, token_pieces
from saleslake.llm.tokens import _UNUSUAL, BYTE_BPE, _ranks, encode
from tests.llm.odd import documents, odd_documents, odd_rows

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def naive(lengths, capacity):
    space, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        for b, left in enumerate([*space, capacity]):
            if left >= lengths[i]:
                if b == len(space):
                    space.append(capacity)
                out[i] = (b, capacity - space[b])
                space[b] -= lengths[i]
                break
    return [out[i] for i in range(len(lengths))]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 500])
def test_tree_places_as_first_fit_does(n):
    rng = random.Random(n)
    lengths = [rng.randint(1, 100) for _ in range(n)]
    bins, offsets = first_fit_decreasing(np.array(lengths, dtype=np.int64), 100)
    assert list(zip(bins.tolist(), offsets.tolist())) == naive(lengths, 100)


def test_ids_are_those_of_the_library():
    rng = random.Random(5)
    usual = [chr(c) for c in range(0x2600) if not _UNUSUAL.search(chr(c))]
    texts = ["".join(rng.choice(usual if rng.random() < 0.5 else " \n\t\rab1's,.") for _ in range(40)) for _ in range(1500)]
    for text in texts:
        assert _ranks(BYTE_BPE).encode_to_numpy(text, disallowed_special=()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    for row in odd_rows():
        assert encode(row[1]).tolist() == (LIBRARY.encode(row[1], add_special_tokens=False).ids if row[1] else [])


def packed(df, capacity=2048):
    rows = pack(token_pieces(df, capacity=capacity), capacity, group=50).collect()
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return by_document, by_sequence


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(0, 300)))) for i in range(120)]
    by_document, by_sequence = packed(documents(spark, rows), 64)
    for doc_id, text in rows:
        ids = np.array([*(LIBRARY.encode(text, add_special_tokens=False).ids if text else []), 1], dtype="<u4")
        at = 0
        for start, length, crc, total in sorted(by_document[doc_id]):
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    used = sum(length for pieces in by_sequence.values() for _, length in pieces)
    assert used > 0.97 * 64 * len(by_sequence)


def test_odd_documents(spark):
    by_document, _ = packed(odd_documents(spark))
    assert by_document[1] == [(0, 1, zlib.crc32(b"\1\0\0\0"), 1)]
    assert len(by_document[None]) == 2 and len(by_document[5]) == 2
    assert sum(p[1] for p in by_document[4]) == by_document[4][0][3]


def test_empty_table_and_a_hot_id(spark):
    assert packed(documents(spark, [])) == ({}, {})
    hot = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit("a b c").alias("text"))
    by_document, by_sequence = packed(hot, 16)
    assert len(by_document[1]) == 500
