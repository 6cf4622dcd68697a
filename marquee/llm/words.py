"""Words of a text, the same for every operator here that compares wording."""

from __future__ import annotations

# One byte per byte: A-Z to lower case, other ASCII that is neither letter nor
# digit to a space; bytes of non-ASCII characters stay as they are.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def folded(text: str | None) -> bytes:
    """UTF-8 of the text with its words in lower case and everything between them blank; as long as its input."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


def words(text: str | None) -> list[bytes]:
    return folded(text).split()


class WordHashes(dict):
    """Word to the 8 bytes of its hash, remembered; forgets all when ``limit`` words are held."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value

    def of(self, tokens: list[bytes]):
        import numpy as np

        return np.frombuffer(b"".join(map(self.__getitem__, tokens)), np.uint64)


def mix(values):
    """A 64-bit finaliser (splitmix64), over arrays of uint64."""
    import numpy as np

    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes, size: int):
    """Hash of every run of ``size`` words; of the whole text where it is shorter; none for no words."""
    import numpy as np

    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    return mix(out)


def map_texts(docs, make, columns: str):
    """doc_id (long) and ``columns`` for every row: ``make()`` runs once a task, its result once a text.

    Row-local; ids pass as they are, NULL included.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("doc_id long, " + columns)

    def run(batches):
        import pyarrow as pa

        arrow, function = to_arrow_schema(schema), make()
        for batch in batches:
            rows = [function(text) for text in batch.column("text").to_pylist()]
            parts = list(zip(*rows)) if rows else [()] * (len(arrow) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 *(pa.array(p, f.type) for p, f in zip(parts, list(arrow)[1:]))], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


#: Keys up to which a key set is sent to every executor (about 50 MB); beyond, both sides are shuffled.
FEW_KEYS = 2_000_000


def few(keys, rows: int | None = None):
    """``keys`` (few narrow columns, written before) marked for broadcast where its counted rows allow it."""
    from pyspark.sql import functions as F

    return F.broadcast(keys) if (keys.count() if rows is None else rows) <= FEW_KEYS else keys
