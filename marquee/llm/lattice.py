"""SentencePiece encoding and decoding over word lattices.

A text is its words: blanks become marks ``▁`` at the front of the next word, and
a line break is a word of its own, so no piece crosses from one word to another.
A word's lattice has its characters as places and the pieces found in it as
edges.  It is folded into the word's pieces:

* ``unigram`` tables by Viterbi: the path of the greatest total score;
* ``bpe`` tables by merges: of the lattice's edges that join two neighbouring
  symbols the one of the best score, leftmost first, until none is left.  The
  scores of a BPE file are merge ranks, and Viterbi over ranks gives other
  pieces than the file's own library, which is why its type decides.

Characters without a piece become the pieces of their UTF-8 bytes.

Encoding and decoding are row-local: the piece table travels to the tasks, whose
words are folded once each and remembered, and no document is shuffled.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query

MARK = "▁"
BLOCK_ROWS = 512          # documents whose ids are held at once
REMEMBERED = 400_000      # words whose ids a task holds
LONG_WORD = 64            # characters from which a word is not remembered, and folded through a heap
#: Below every score, as the library sets it for characters without a piece.
UNKNOWN = 10.0

_WORD = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


class Vocabulary(NamedTuple):
    kind: str                        # "bpe" or "unigram"
    pieces: list                     # (piece, id, score) of the ordinary pieces
    byte_ids: list                   # id of each byte's piece
    unknown: float
    texts: list                      # bytes of each id, b"" for control pieces

    @property
    def longest(self) -> int:
        return max(len(p[0]) for p in self.pieces)


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte fallback, an added first blank and no other normalisation."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = {1: "unigram", 2: "bpe"}
    rules = model.normalizer_spec
    if model.trainer_spec.model_type not in kinds or not model.trainer_spec.byte_fallback:
        raise ValueError("a unigram or BPE model with byte fallback is wanted")
    if rules.name != "identity" or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError("only models that add a first blank and normalise nothing else are supported")
    pieces, byte_ids, texts = [], [0] * 256, []
    for number, piece in enumerate(model.pieces):
        if piece.type == 6:
            byte_ids[int(piece.piece[3:5], 16)] = number
            texts.append(bytes([int(piece.piece[3:5], 16)]))
        elif piece.type in (1, 4):
            texts.append(piece.piece.encode())
            if MARK in piece.piece.lstrip(MARK) or "\n" in piece.piece[1:]:
                raise ValueError(f"the piece {piece.piece!r} crosses from one word to the next")
            pieces.append((piece.piece, number, float(piece.score)))
        else:
            texts.append(b"")
    return Vocabulary(kinds[model.trainer_spec.model_type], pieces, byte_ids,
                      min(p[2] for p in pieces) - UNKNOWN, texts)


def words_of(text: str) -> list[str]:
    """The words of a text, which put together are its blanks marked; none for an empty text."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def _fold_bpe(word: str, ranks: dict) -> list[str]:
    """The symbols of a word after all merges: best rank first, then leftmost.

    ``ranks`` has every piece of two or more characters.
    """
    symbols = list(word)
    if len(symbols) >= LONG_WORD:
        return _fold_long_bpe(symbols, ranks)
    never, rank = math.inf, ranks.get
    edges = [rank(word[k:k + 2], never) for k in range(len(word) - 1)]
    while edges and (best := min(edges)) < never:
        at = edges.index(best)
        joined = symbols[at] = symbols[at] + symbols.pop(at + 1)
        del edges[at]
        if at:
            edges[at - 1] = rank(symbols[at - 1] + joined, never)
        if at < len(edges):
            edges[at] = rank(joined + symbols[at + 1], never)
    return symbols


def _fold_long_bpe(symbols: list[str], ranks: dict) -> list[str]:
    """The same for words of any length: a heap of edges instead of a look through all of them for every merge."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list = []

    def offer(left):
        right = after[left] if left >= 0 else n
        if right < n and (joined := symbols[left] + symbols[right]) in ranks:
            heapq.heappush(heap, (ranks[joined], left, joined))

    for k in range(n - 1):
        offer(k)
    while heap:
        _, left, joined = heapq.heappop(heap)
        right = after[left]
        # An edge is stale once one of its two symbols has grown or gone.
        if right >= n or not symbols[left] or symbols[left] + symbols[right] != joined:
            continue
        symbols[left], symbols[right] = joined, ""
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        offer(before[left])
        offer(left)
    return [x for x in symbols if x]


def _fold_viterbi(word: str, scores: dict, longest: int, unknown: float) -> list[str]:
    """The symbols of a word on the path of the best score; among equals the shortest last symbol."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        paths = []
        for start in range(max(0, end - longest), end):
            score = scores.get(word[start:end], unknown if start == end - 1 else None)
            if score is not None:
                paths.append((best[start][0] + score, start))
        best.append(max(paths))
    symbols, end = [], len(word)
    while end:
        start = best[end][1]
        symbols.append(word[start:end])
        end = start
    return symbols[::-1]


class Remembered(dict):
    """``make`` of a word, made once; forgets all when ``REMEMBERED`` words are held."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) < LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


def word_ids(vocabulary: Vocabulary) -> Remembered:
    """Word to its ids, four bytes each.

    A BPE word is cut first between neighbours that stand together in no piece:
    no merge crosses there, and the parts of unlike words are often alike.
    """
    numbers = {p: number for p, number, _ in vocabulary.pieces}
    scores = {p: score for p, _, score in vocabulary.pieces}
    ranks = {p: -score for p, _, score in vocabulary.pieces if len(p) > 1}
    neighbours = {p[k:k + 2] for p in ranks for k in range(len(p) - 1)}
    longest, bpe = vocabulary.longest, vocabulary.kind == "bpe"

    def fold(word: str) -> bytes:
        ids = array("i")
        for symbol in _fold_bpe(word, ranks) if bpe else _fold_viterbi(word, scores, longest, vocabulary.unknown):
            if symbol in numbers:
                ids.append(numbers[symbol])
            else:
                ids.extend([vocabulary.byte_ids[b] for b in symbol.encode()])
        return ids.tobytes()

    parts = Remembered(fold)

    def cut(word: str) -> bytes:
        places = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in neighbours]
        if not places:
            return parts[word]
        return b"".join([parts[word[a:b]] for a, b in zip([0, *places], [*places, len(word)])])

    return Remembered(cut) if bpe else parts


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, ids, one row per input row; NULL and empty texts have no ids; NULL and repeated ids keep their rows.

    Row-local.  ``block_rows`` documents are put together at once.
    """
    def run(batches):
        import pyarrow as pa

        known = word_ids(vocabulary).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                rows = [b"".join(map(known, words_of(text or ""))) for text in part.column("text").to_pylist()]
                ends = pa.array([0, *accumulate(len(row) // 4 for row in rows)], pa.int32())
                joined = b"".join(rows)
                ids = pa.ListArray.from_arrays(ends, pa.Array.from_buffers(
                    pa.int32(), len(joined) // 4, [None, pa.py_buffer(joined)]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>")


class PieceTexts(dict):
    """Id to its bytes; the replacement character for ids outside the vocabulary."""

    def __missing__(self, number):
        return b"\xef\xbf\xbd"


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, text of (doc_id, ids): the bytes of the pieces, marks as blanks, without the first blank.

    Ids outside the vocabulary and broken UTF-8 raise no error: they give the replacement character.
    """
    texts = vocabulary.texts

    def run(batches):
        import pyarrow as pa

        piece = PieceTexts(enumerate(texts)).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part, out = batch.slice(at, BLOCK_ROWS), []
                for ids in part.column("ids").to_pylist():
                    text = b"".join(map(piece, ids or [])).decode("utf-8", "replace").replace(MARK, " ")
                    out.append(text[1:] if text.startswith(" ") else text)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(out, pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_piece_lattice")
def op8(spark, sf):
    """Every document in pieces and back: the ids, their number and digest, and the text that they decode to."""
    vocabulary = read_vocabulary(vocabulary_path())
    decoded = decode_documents(encode_documents(documents(spark, sf), vocabulary), vocabulary)
    return decoded.select("doc_id", "ids", "text", F.size("ids").cast("long").alias("n_pieces"),
                          F.xxhash64("ids").alias("ids_hash"), F.array_min("ids").alias("least_id"),
                          F.array_max("ids").alias("greatest_id"))
