"""Spot signatures of documents: chains of content words that follow common words.

Every frequent function word is an anchor; the anchor and the next two words that aren't function
words form a signature. In a stretch without function words each word is an anchor; in a text too
short for a chain, each word and the two after it are. A text's fingerprint is the set of its
signatures, written as text. Fingerprints are compared by Jaccard; sets whose sizes alone keep them
below the wanted likeness aren't compared.

``near_documents`` finds the groups: sets are dealt to parts by their length, meet in their own part
and the next one where they share one of the signatures that sets at the threshold must share, and
are compared in full.

``with_next`` sets each document beside the next one by falling doc_id. Documents are dealt out by
ranges of (doc_id, hash of the text), and the first one of a range also goes to the range before it,
so that texts are shuffled once and a frequent doc_id is split over ranges.

Defined results: a null text is as an empty one; an empty text has no signatures, and two without
signatures are alike (1); a text without words has one signature, of itself; ties of doc_id are in
falling order of a hash of the text, and rows without doc_id come last; repeated rows follow each
other; the last document's next one is the first, for a single one itself. Extra columns are passed
over. No rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.linking import SKETCH, minima, near_rows, sketch_columns

#: Words without an anchor after which each word is one; bytes of text in a range.
REACH, RANGE_BYTES = 8, 32 << 20
#: Keys that are sampled for each range.
SAMPLED = 5
#: Coordinates by which likely pairs are told before full sets are compared.
COORDINATES = 64

#: Frequent function words of four languages, which are the anchors.
ANCHORS = frozenset(
    "a an the and or of to in on is was are be by for as at from it that this with "
    "le la les de des du et un une est que qui en pour par sur dans avec au "
    "der die das den dem ein eine und zu ist von mit auf nicht für als im "
    "el los las del al y se por con para es su lo uno una no".split()
)

_BLANKS = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
_ANCHOR_WORDS = frozenset(w.encode() for w in ANCHORS)
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


class _Words(dict):
    """Hashes of words, odd for anchors; kept for those seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) & ~1 | (word in _ANCHOR_WORDS)
        return value


def _chains(first: np.ndarray, second: np.ndarray, third: np.ndarray, kind: int) -> np.ndarray:
    h = (first + np.uint64(kind)) * _MIX[0]
    h = (h ^ (h >> np.uint64(31)) ^ second) * _MIX[1]
    h = (h ^ (h >> np.uint64(29)) ^ third) * _MIX[2]
    return (h >> np.uint64(32)).astype(np.uint32)


def signatures(text: str, known: dict | None = None) -> np.ndarray:
    """The text's signatures: distinct 32-bit hashes, sorted."""
    data = text.encode()
    words = data.translate(_BLANKS).split()
    if not words:
        return np.array([xxhash.xxh32_intdigest(data)] if data else [], np.uint32)
    known = _Words() if known is None else known
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    common = (w & np.uint64(1)).astype(bool)
    place = np.arange(len(w))
    last = np.maximum.accumulate(np.where(common, place, -REACH))
    spots = common | (place - last >= REACH)
    content = w[~common]
    # The number of content words up to a spot is the place of the first one after it.
    after = np.cumsum(~common)[spots]
    whole = after + 1 < len(content)
    after = after[whole]
    found = _chains(w[spots][whole], content[after], content[after + 1], 0)
    if not len(found):
        padded = np.append(w, np.zeros(2, np.uint64))
        last = max(1, len(w) - 2)
        found = _chains(padded[:last], padded[1 : last + 1], padded[2 : last + 2], 1)
    return np.unique(found)


def fingerprint(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard of two sets, from 0 to 1; 0 if their sizes alone rule ``at_least`` out."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large or not small:
        return 0.0
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (small + large - common)


def _place(ids: np.ndarray, ties: np.ndarray, cut_ids: np.ndarray, cut_ties: np.ndarray) -> np.ndarray:
    """The range of each (id, tie): the number of cuts that are not above it."""
    low, high = np.searchsorted(cut_ids, ids, "left"), np.searchsorted(cut_ids, ids, "right")
    out = low.copy()
    for value in np.unique(ids[high > low]):
        at = np.flatnonzero(ids == value)
        out[at] += np.searchsorted(cut_ties[low[at[0]] : high[at[0]]], ties[at], "right")
    return out


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(part, extra, key, tie, doc_id, text): the rows of ``docs`` and, marked ``extra``, the first
    row after each part's last one. A part's rows, sorted by (extra, -key, -tie), are each
    followed by the next document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64("text").alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = rows.select("key", "tie")
    total = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    parts = 1 + (total["size"] or 0) // range_bytes
    # Bounds of ranges, as a range partitioning draws them: from a sample of a few keys for each.
    sample = keys.sample(min(1.0, SAMPLED * parts / max(1, total["n"])), seed=5) if parts > 1 else keys.limit(0)
    cuts = sample.toPandas().sort_values(["key", "tie"]).iloc[SAMPLED::SAMPLED]
    spark = docs.sparkSession
    bounds = spark.sparkContext.broadcast((cuts["key"].to_numpy(np.int64), cuts["tie"].to_numpy(np.int64)))

    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(_place(key.to_numpy(np.int64), tie.to_numpy(np.int64), *bounds.value))

    part_of = F.pandas_udf(place, "long")
    # The first document of each range by falling order: one row for each range.
    firsts = keys.withColumn("part", part_of("key", "tie")).groupBy("part").agg(F.max(F.struct("key", "tie")).alias("top"))
    tops = firsts.select("part", "top.key", "top.tie").toPandas().sort_values("part")
    # Each is the next one of the range above, the topmost that of the lowest.
    target = np.roll(tops["part"].to_numpy(np.int64), -1)
    sent = spark.sparkContext.broadcast((tops["key"].to_numpy(np.int64), tops["tie"].to_numpy(np.int64), target))

    def also(key: pd.Series, tie: pd.Series) -> pd.Series:
        top_keys, top_ties, target = sent.value
        ids, ties = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        low, high = np.searchsorted(top_keys, ids, "left"), np.searchsorted(top_keys, ids, "right")
        found: list[int | None] = [None] * len(ids)
        for n in np.flatnonzero(high > low):
            at = low[n] + np.searchsorted(top_ties[low[n] : high[n]], ties[n])
            if at < high[n] and top_ties[at] == ties[n]:
                found[n] = int(target[at])
        return pd.Series(found, dtype="Int64")

    also_in = F.pandas_udf(also, "long")
    rows = rows.withColumn("part", part_of("key", "tie")).withColumn("also", also_in("key", "tie"))
    places = F.array_compact(
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")),
            F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("part"), F.lit(True).alias("extra"))),
        )
    )
    placed = rows.withColumn("place", F.explode(places))
    return placed.select("place.part", "place.extra", "key", "tie", "doc_id", "text")


def fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last third replaced by the beginning of the next document.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["long", "long", "string", "string", "string", "double", "double"]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}

    def pairs(batches) -> Iterator[tuple]:
        """Each document, with its signatures, and the next one's text and signatures."""
        held, known = None, _Words()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("part", "extra", "doc_id", "text")]
            for at in range(batch.num_rows):
                part, extra, doc_id, text = (c[at].as_py() for c in columns)
                found = signatures(text, known)
                if held is not None and held[0] == part:
                    yield *held[1:], text, found, known
                held = None if extra else (part, doc_id, text, found)

    def run(batches):
        out: list[tuple] = []

        def ready():
            arrays = [pa.array(c, types[k]) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for doc_id, text, found, next_text, next_found, known in pairs(batches):
            n = len(text)
            edited = text[: n - n // 3] + next_text[: n // 3]
            edited_found = signatures(edited, known)
            out.append(
                (
                    doc_id,
                    n,
                    hashlib.sha256(edited.encode()).hexdigest(),
                    fingerprint(found),
                    fingerprint(edited_found),
                    likeness(found, edited_found),
                    likeness(found, next_found),
                )
            )
            if len(out) >= 512:
                yield ready()
        if out:
            yield ready()

    placed = with_next(docs, range_bytes).repartition("part")
    placed = placed.sortWithinPartitions("part", "extra", F.col("key").desc(), F.col("tie").desc())
    return placed.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def _length_part(size: int, threshold: float) -> int:
    """The part of all sets by length: sets whose lengths differ more than the threshold allows are two apart."""
    return math.floor(math.log(size) / -math.log(threshold) + 1e-9)


def sketches(threshold: float):
    """Rows for ``near_rows``: keys are the signatures that sets of a threshold must share one of.

    In any one order of all signatures, two sets at the threshold share one of the first of each, as
    many as the threshold lets them differ by, and one more. Sets meet in their own part of lengths
    and the next one.
    """

    def run(batches):
        known = _Words()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            sets = [signatures(t or "", known) for t in texts]
            full = [s for s in sets if len(s)]
            starts = np.cumsum([0, *(len(s) for s in full)])[:-1]
            found = np.zeros((len(sets), COORDINATES), np.uint32)
            if full:
                found[[len(s) > 0 for s in sets]] = minima(np.concatenate(full), starts, COORDINATES)
            keys = []
            for s in sets:
                first = s[: len(s) - math.ceil(threshold * len(s) - 1e-9) + 1].astype(np.int64)
                part = _length_part(len(s), threshold) if len(s) else 0
                keys.append(np.concatenate([(first << 20) + part, (first << 20) + part + 1]) if len(s) else first)
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            sig, _ = sketch_columns(found, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "at")),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    sig,
                    pa.ListArray.from_arrays(offsets, np.concatenate([*keys, np.zeros(0, np.int64)])),
                ],
                ["doc_id", "at", "size", "digest", "sig", "keys"],
            )

    return lambda docs: docs.mapInArrow(run, SKETCH)


def near_documents(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, size, component_id, kept): documents whose signatures' Jaccard reaches the threshold,
    directly or through others. Texts without signatures are near nothing."""

    def as_sets(texts: list[bytes]) -> list[np.ndarray]:
        return [signatures(t.decode()) for t in texts]

    return near_rows(docs, sketches(threshold), as_sets, COORDINATES, threshold, one_key=True)
