"""Sequences of at most 2048 tokens, packed in order by dynamic programming.

The tokens of the documents, one after another, are cut into windows.  A cut at
the end of a document costs nothing, at the end of a sentence ``SENTENCE_COST``
and inside a sentence (every ``STRIDE`` tokens of a long one) ``INSIDE_COST``;
a window costs its padding.  With P the tokens before a boundary,

    best[j] = cost of cutting at j + (2048 - P[j]) + min over i of (best[i] + P[i]),  P[j] - P[i] <= 2048,

and the admissible i slide forward with j, so a monotone queue holds the
minimum: every boundary enters and leaves it once.

Each input partition is packed on its own, in its rows' order, a block of
documents at a time; memory is bounded by a block and a document.  A partition
ends with at most one sequence that more documents could have filled.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.llm.registry import documents, query

LENGTH = 2048
END_ID = 1
SENTENCE_COST = 4
INSIDE_COST = 64
STRIDE = 64
BLOCK_TOKENS = 1 << 20

COLUMNS = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "ids binary")

# Chunks of Latin letters and then ASCII marks (no apostrophe) fall into two pre-tokens and are lower-cased letter by letter.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)").fullmatch
# A mark after a letter always begins a pre-token, so a blank may stand between them: words with and without are one chunk.
_MARK = re.compile(r"[.,;:!?](?<=[A-Za-z].)")


class _Remembered(dict):
    """What ``make`` gives for a key, remembered; forgets all when ``limit`` keys are held."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.encode`` without special tokens.

    The tokenizer drops white space and never joins across it, so a text is the
    concatenation of its chunks and each chunk is encoded once and remembered
    (up to ``limit`` chunks).  Only the library's model decides on ids.
    """

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.chunks = _Remembered(self._chunk, limit)
        # The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(256 + k) for k, b in enumerate(hidden)}

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        simple = _SIMPLE(chunk)
        if not simple:
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        letters, marks = simple.groups()
        small = letters.lower()
        if letters and marks:
            return self.chunks[small] + self.chunks[marks]
        return self._piece(chunk) if small == letters else self.chunks[small]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, _split(text)))


def _split(text: str) -> list[str]:
    # Not str.split(): white space beyond these is left to the tokenizer.
    return _MARK.sub(r" \g<0>", text.replace("\n", " ").replace("\t", " ").replace("\r", " ")).split(" ")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def sentence_ends(path: str):
    """Boolean by token id: marks that end a sentence."""
    import numpy as np

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    out = np.zeros(max([*vocabulary.values(), *(t["id"] for t in content["added_tokens"])]) + 1, bool)
    for token, number in vocabulary.items():
        mark = token.removesuffix("</w>")
        out[number] = token != mark and mark[-1:] in set(".!?") and not any(c.isalnum() for c in mark)
    return out


def boundaries(ids, ends, stride: int = STRIDE):
    """(positions after which a document may be cut, their costs); the last is its end, at cost 0."""
    import numpy as np

    n = len(ids)
    cuts = np.flatnonzero(ends[ids]) + 1
    cuts = np.append(cuts[cuts < n], n)
    costs = np.full(len(cuts), SENTENCE_COST)
    costs[-1] = 0
    gaps = np.diff(cuts, prepend=0)
    if gaps.max() > stride:
        starts = cuts - gaps
        inner = np.concatenate([np.arange(a + stride, b, stride) for a, b in zip(starts[gaps > stride], cuts[gaps > stride])])
        order = np.argsort(np.concatenate([cuts, inner]), kind="stable")
        costs = np.concatenate([costs, np.full(len(inner), INSIDE_COST)])[order]
        cuts = np.concatenate([cuts, inner])[order]
    return cuts, costs


def best_cuts(positions: list[int], costs: list[int], length: int = LENGTH) -> list[int]:
    """Chosen boundaries, ascending, the last included.  ``positions`` ascend from above 0 by steps of at most ``length``."""
    at = [0, *positions]
    best, back = [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (boundary, best + position), ascending in both
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0][0]] > length:
            queue.popleft()
        i, value = queue[0]
        cost = value + length - here + costs[j - 1]
        best.append(cost)
        back.append(i)
        value = cost + here
        while queue and queue[-1][1] >= value:
            queue.pop()
        queue.append((j, value))
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def pack_block(docs: list, ends, first_sequence: int, length: int = LENGTH):
    """Piece rows (index of the document, start, length, sequence, offset) of a block of id arrays."""
    import numpy as np

    positions, costs, starts, total = [], [], [], 0
    for ids in docs:
        cuts, price = boundaries(ids, ends)
        positions.append(cuts + total)
        costs.append(price)
        starts.append(total)
        total += len(ids)
    cuts = np.array(best_cuts(np.concatenate(positions).tolist(), np.concatenate(costs).tolist(), length))
    edges = np.unique(np.concatenate([[0], cuts, starts]))
    edges = edges[edges < total]
    sizes = np.diff(np.append(edges, total))
    of_doc = np.searchsorted(starts, edges, side="right") - 1
    sequence = np.searchsorted(cuts, edges, side="right")
    opened = np.concatenate([[0], cuts])[sequence]
    return of_doc, edges - np.array(starts)[of_doc], sizes, sequence + first_sequence, edges - opened, len(cuts)


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and the piece's ``ids``, one row per piece.

    NULL and empty texts are documents of the end id alone.  NULL and repeated
    ids are packed like any row.  An empty table gives no rows.  ``path`` is a
    tokenizer file that every executor has.  No shuffle: a sequence holds
    neighbouring rows of one input partition.
    """
    schema = StructType.fromDDL(COLUMNS)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, ends, arrow = encoder(path).encode, sentence_ends(path), to_arrow_schema(schema)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32

        def flush():
            nonlocal sequence
            arrays = [np.frombuffer(r, "<u4") for r in raw]
            doc, start, size, number, offset, used = pack_block(arrays, ends, sequence, length)
            sequence += used
            views = [memoryview(raw[d])[4 * a:4 * (a + n)] for d, a, n in zip(doc.tolist(), start.tolist(), size.tolist())]
            tokens = np.array([len(a) for a in arrays])
            return pa.RecordBatch.from_arrays([
                pa.array([ids[d] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(size),
                pa.array([zlib.crc32(v) for v in views], pa.int64()), pa.array(tokens[doc]), pa.array(number),
                pa.array(offset), pa.array([bytes(v) for v in views], pa.binary())], schema=arrow)

        raw, ids, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw.append(encode(text.as_py() or "") + end)
                ids.append(doc_id)
                held += len(raw[-1]) // 4
                if held >= BLOCK_TOKENS:
                    yield flush()
                    raw, ids, held = [], [], 0
        if raw:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op6_ordered_packing")
def op6(spark, sf):
    """All documents in sequences of at most 2048 tokens."""
    return pack(documents(spark, sf), tokenizer_path()).drop("ids")
