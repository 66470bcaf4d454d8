import random
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

from saleslake.llm.pieces import PIECES, decode_ids, encode_texts, piece_digests, pieces
from tests.llm.odd import documents, odd_documents, odd_rows

MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
SCORES = {
    MODEL.id_to_piece(i).encode(): (i, MODEL.get_score(i))
    for i in range(MODEL.get_piece_size())
    if not (MODEL.is_byte(i) or MODEL.is_control(i) or MODEL.is_unknown(i))
}
LONGEST = max(map(len, SCORES))


def brute(text):
    """Viterbi over the whole text, looking up every substring."""
    if not text:
        return []
    data = (" " + text).replace(" ", "▁").encode()
    n, unknown = len(data), pieces().unknown
    best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST), end):
            hit = SCORES.get(data[start:end])
            if hit and best[start] + hit[1] > best[end]:
                best[end], back[end] = best[start] + hit[1], (start, hit[0])
        if best[end - 1] + unknown > best[end]:
            best[end], back[end] = best[end - 1] + unknown, (end - 1, int(pieces().byte_ids[data[end - 1]]))
    ids = []
    while n:
        n, i = back[n]
        ids.append(i)
    return ids[::-1]


@pytest.mark.parametrize("seed", range(2))
def test_equals_plain_viterbi(seed):
    rng = random.Random(seed)
    letters = list("abcdefghi the   \n\té日本😀zq=_")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["   ", "", "a", "x" * 3000, "日本語" * 500 + " b"]
    got = pieces().encode(texts)
    assert [x.tolist() for x in got] == [brute(t) for t in texts]
    assert [pieces().decode(x) for x in got] == texts


def test_equals_the_library_over_known_characters():
    """Read as a unigram model the file gives the same ids, as long as no unknown character drowns
    the scores in the library's single precision."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    unigram = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("etaoinshr,.") for _ in range(rng.randint(1, 9))) for _ in range(8)) for _ in range(300)]
    assert [x.tolist() for x in pieces().encode(texts)] == unigram.encode(texts)


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr("saleslake.llm.pieces._CACHED_WORDS", 5)
    texts = [f"word{i} and word{i + 1}" for i in range(20)]
    assert [pieces().encode([t])[0].tolist() for t in texts] == [brute(t) for t in texts]


def test_round_trip_of_odd_documents(spark):
    odd = odd_documents(spark)
    encoded = encode_texts(odd)
    assert set(encoded.columns) == set(odd.columns)
    back = decode_ids(encoded, into="back").select("text", "back").collect()
    assert len(back) == 12
    assert all(r.back == (None if r.text is None else r.text.replace("▁", " ")) for r in back)
    rows = {r.doc_id: r for r in piece_digests(odd).collect()}
    for doc_id, text, *_ in odd_rows():
        if doc_id is not None:
            r = rows[doc_id]
            assert r.n_ids == len(pieces().encode([text])[0]) and r.round_trip == ("▁" not in (text or ""))
            assert r.text_crc32 == zlib.crc32((text or "").replace("▁", " ").encode())


def test_odd_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([([5, None, -3, 10**6, 0, 1],), (None,), ([],), ([131, 132],)], "piece_ids array<int>")
    assert [r.text for r in decode_ids(rows).collect()] == ["\x02", None, "", "��"]
    empty = documents(spark, [])
    assert encode_texts(empty).collect() == [] and piece_digests(empty).collect() == []
