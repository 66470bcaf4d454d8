"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

One pass over the bytes: at each position the automaton's state and its output links name every
piece that ends there, and each relaxes the best score of that position. Distinct words are
encoded side by side in numpy; a word is a run of spaces with what follows it, which no piece
crosses, so the best segmentation of a text is that of its words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from saleslake.llm.tables import slices, with_computed

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Below the least score of a piece, as in the library, a byte that no piece covers costs so much more.
UNKNOWN_PENALTY = 10.0
_WORDS = re.compile(" +[^ ]*")
_CACHED_WORDS = 500_000
_TOGETHER = 4_000_000  # positions of words that are encoded side by side


class Pieces:
    """The vocabulary of a model as an automaton over bytes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.full(256, model.unk_id(), dtype=np.int32)
        words: dict[bytes, tuple[int, float]] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                words[piece.encode()] = (i, float(model.get_score(i)))
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece crosses from a word into the next")
        self.unknown = min(score for _, score in words.values()) - UNKNOWN_PENALTY
        self._build(words)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _build(self, words: dict[bytes, tuple[int, float]]) -> None:
        children: list[dict[int, int]] = [{}]
        piece_at: dict[int, tuple[int, float, int]] = {}
        for word, (i, score) in words.items():
            state = 0
            for byte in word:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                state = children[state][byte]
            piece_at[state] = (i, score, len(word))
        n = len(children)
        self.piece = np.full(n, -1, dtype=np.int32)  # that ends in a state
        self.score = np.zeros(n)
        self.length = np.zeros(n, dtype=np.int64)
        for state, (i, score, length) in piece_at.items():
            self.piece[state], self.score[state], self.length[state] = i, score, length
        self.go = np.zeros((n, 256), dtype=np.int32)
        self.link = np.zeros(n, dtype=np.int32)  # next state on the way to shorter suffixes where a piece ends
        fail = np.zeros(n, dtype=np.int32)
        level = [0]
        while level:
            below = []
            for state in level:
                if state:
                    self.go[state] = self.go[fail[state]]
                for byte, child in children[state].items():
                    fail[child] = self.go[state, byte] if state else 0
                    shorter = fail[child]
                    self.link[child] = shorter if self.piece[shorter] >= 0 else self.link[shorter]
                    below.append(child)
                for byte, child in children[state].items():
                    self.go[state, byte] = child
            level = below

    def _segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has. Of equal scores the longer last piece
        stands, and a piece before a bare byte."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        n, longest = len(words), int(lengths.max())
        data = np.zeros((longest, n), dtype=np.uint8)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        data[np.arange(len(flat)) - np.repeat(starts, lengths), np.repeat(np.arange(n), lengths)] = flat
        order = np.argsort(-lengths, kind="stable")  # so that the words still running come first
        running = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
        data = data[:, order]
        best = np.full((longest + 1, n), -np.inf)
        best[0] = 0
        came = np.zeros((longest + 1, n), dtype=np.int32)  # the piece, or -1 - byte
        back = np.ones((longest + 1, n), dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        for t in range(longest):
            m = int(running[t])
            state = self.go[state[:m], data[t, :m]]
            column = np.arange(m)
            at = np.where(self.piece[state] >= 0, state, self.link[state])
            top, piece = best[t + 1], came[t + 1]
            while True:
                some = at > 0
                if not some.all():
                    at, column = at[some], column[some]
                if not len(at):
                    break
                length = self.length[at]
                score = best[t + 1 - length, column] + self.score[at]
                better = score > top[column]
                c = column[better]
                top[c], piece[c], back[t + 1, c] = score[better], self.piece[at[better]], length[better]
                at = self.link[at]
            score = best[t, :m] + self.unknown
            bare = np.flatnonzero(score > top[:m])
            top[bare], piece[bare], back[t + 1, bare] = score[bare], self.byte_ids[data[t, bare]], 1
        out = np.zeros((n, longest), dtype=np.int32)
        sizes, at, column = np.zeros(n, dtype=np.int64), lengths[order], np.arange(n)
        while len(column):
            out[column, longest - 1 - sizes[column]] = came[at, column]
            sizes[column] += 1
            at = at - back[at, column]
            column, at = column[at > 0], at[at > 0]
        inverse = np.argsort(order, kind="stable")
        out, sizes = out[inverse], sizes[inverse]
        return out[np.arange(longest) >= (longest - sizes)[:, None]], sizes

    def _segment_long(self, word: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for one word, byte by byte."""
        n = len(word)
        best, came, back, state = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1), 0
        go, link, piece, length, score_of = self.go, self.link, self.piece, self.length, self.score
        for t, byte in enumerate(word):
            state = int(go[state, byte])
            at = state if piece[state] >= 0 else int(link[state])
            top = -np.inf
            while at > 0:
                start = t + 1 - int(length[at])
                score = best[start] + float(score_of[at])
                if score > top:
                    top, came[t + 1], back[t + 1] = score, int(piece[at]), start
                at = int(link[at])
            score = best[t] + self.unknown
            if score > top:
                top, came[t + 1], back[t + 1] = score, int(self.byte_ids[byte]), t
            best[t + 1] = top
        ids = []
        while n:
            ids.append(came[n])
            n = back[n]
        return np.array(ids[::-1], dtype=np.int32), np.array([len(ids)])

    def _learn(self, words: list[str]) -> None:
        """Segment words that are not known yet, those of like length together."""
        coded = sorted(((w.replace(" ", SPACE).encode("utf-8", "surrogatepass"), w) for w in words), key=lambda x: len(x[0]))
        parts, sizes, at = [self.ids], [], 0
        while at < len(coded):
            # Doubling lengths at most, and a bounded matrix.
            length, end = max(8, 2 * len(coded[at][0])), at
            while end < len(coded) and len(coded[end][0]) <= length and (end + 1 - at) * length <= _TOGETHER:
                end += 1
            if end - at < 4 and length > 1000 or end == at:
                end = at + 1
                ids, size = self._segment_long(coded[at][0])
            else:
                ids, size = self._segment([w for w, _ in coded[at:end]])
            parts.append(ids)
            sizes.append(size)
            at = end
        for _, w in coded:
            self.known[w] = len(self.known)
        self.ids = np.concatenate(parts)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text with the space put in front; none for null or empty texts. The mark
        U+2581 in a text is read as a space."""
        split = [_WORDS.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        if len(self.known) > _CACHED_WORDS:
            self.clear()
        if new := list({w for words in split for w in words if w not in self.known}):
            self._learn(new)
        out = []
        for words in split:
            which = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            first, sizes = self.ends[which], self.ends[which + 1] - self.ends[which]
            shift = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(words) else first
            out.append(self.ids[shift + np.arange(len(shift))])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that was put in front; bytes that are no UTF-8 become
        the replacement character."""
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text.removeprefix(" ")


@cache
def pieces(path: str = PIECES) -> Pieces:
    return Pieces(path)


def encode_texts(docs: DataFrame, path: str = PIECES, text: str = "text", into: str = "piece_ids") -> DataFrame:
    """The rows with the ids of their texts in ``into``; null for a null text, none for an empty one."""

    def encode(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        found = [None if t is None else x for t, x in zip(texts, pieces(path).encode(texts))]
        return pa.array(found, pa.list_(pa.int32()))

    return with_computed(docs, text, into, T.ArrayType(T.IntegerType()), encode)


def decode_ids(rows: DataFrame, path: str = PIECES, ids: str = "piece_ids", into: str = "text") -> DataFrame:
    """The rows with the text of their ids in ``into``; null for null ids. Ids outside the
    vocabulary, null ones and control pieces have no text."""

    def decode(column: pa.Array) -> pa.Array:
        model, size = pieces(path), len(pieces(path).bytes_of)
        found = [
            None if row is None else model.decode(np.array([i for i in row if i is not None and 0 <= i < size], dtype=np.int64))
            for row in column.to_pylist()
        ]
        return pa.array(found, pa.string())

    return with_computed(rows, ids, into, T.StringType(), decode)


def piece_digests(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, text_crc32, round_trip`` of every row: ids as little-endian
    unsigned 32-bit numbers, the decoded text as UTF-8, and whether it equals the text. A null text
    counts as empty."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in slices(batches):
            rows = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for text, ids in zip(texts, model.encode(texts)):
                back = model.decode(ids)
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(back.encode("utf-8", "replace")), back == text))
            n, crc, text_crc, same = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, crc, text_crc)), pa.array(same, pa.bool_())],
                ["doc_id", "n_ids", "ids_crc32", "text_crc32", "round_trip"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, round_trip boolean"
    )
