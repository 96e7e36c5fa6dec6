"""MinHash near-dedup of documents: groups that share three quarters of their word shingles.

Signatures are circulant: one permutation scatters the shingles, a second one, shifted by k,
gives coordinate k. Bands of the signature find candidates; full sets decide (see ``linking``).

Defined results: a null text is as an empty one; a document without words has the empty set and is
near nothing; documents with equal sets, however few words, are near; rows that repeat a doc_id are
one document, in one group; a row without doc_id is near nothing, has no component and stays. Extra columns, whatever their names, are passed over. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import lean, one_of_each, texts_of
from gridledger.llm.linking import SKETCH, minima, near_rows, sketch_columns

WORDS, THRESHOLD = 5, 0.75
#: 32 bands of 4: sets at the threshold share a band with probability 1 - 5e-6.
COORDINATES, ROWS = 128, 4

_STEPS = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WORDS)]


class _Hashes(dict):
    """64-bit hashes of words, kept for those seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[bytes], known: _Hashes | None = None) -> list[np.ndarray]:
    """Hashes of the distinct five-word shingles of each text, sorted; of all words, if fewer."""
    known = _Hashes() if known is None else known
    out = []
    for text in texts:
        words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
        n = len(words)
        w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        width = min(n, WORDS)
        if not n:
            out.append(w)
            continue
        h = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            h += w[k : n - width + 1 + k] * np.uint64(_STEPS[k])
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h.sort()
        out.append(h[np.append(True, h[1:] != h[:-1])] if len(h) > 1 else h)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, at, size, digest of the set, sig, keys) for each row of (doc_id, at, text)."""

    def run(batches):
        known = _Hashes()
        for batch in batches:
            # A few texts at a time: a batch may hold very long ones.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = shingle_sets(texts_of(part), known)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                starts = np.cumsum([0, *(len(s) for s in full)])[:-1]
                high = (np.concatenate(full) >> np.uint64(32)).astype(np.uint32) if full else np.zeros(0, np.uint32)
                found = np.zeros((len(sets), COORDINATES), np.uint32)
                found[sizes > 0] = minima(high, starts, COORDINATES)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.get_field_index(c)) for c in ("doc_id", "at")),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        *sketch_columns(found, ROWS),
                    ],
                    ["doc_id", "at", "size", "digest", "sig", "keys"],
                )

    return docs.mapInArrow(lean(run), SKETCH)


def near_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id long, text string)."""
    return near_rows(docs, sketches, shingle_sets, COORDINATES, THRESHOLD).withColumnRenamed("size", "n_shingles")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are near one with a smaller doc_id, and with one row for each
    doc_id and text; all columns stay."""
    docs = one_of_each(docs)
    gone = near_documents(docs).filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
