"""Language of documents by error-correcting output codes.

Each learned language has a codeword of bits. For each bit, a binary classifier on hashed byte
n-grams (its weights are the log-odds of the n-grams among the languages on either side) says which
side a text is on. Loss-weighted decoding adds up, for each codeword, the losses of the bits, weighed
by how surely the language's own n-grams tell this bit, and takes the nearest codeword. A text whose
second codeword is about as near is flagged as ambiguous.

The n-gram counts are of all rows that aren't held out; each task adds its own up, so that only
counts by language and n-gram bucket are shuffled.

Defined results: a null text, or one without a letter, is `und` with score 0, teaches nothing, and
isn't ambiguous; without learned languages all are; rows without language teach nothing; with one
language, all texts with a letter are of it, with score 1; a null doc_id is not held out; repeated
rows count each and are predicted alike. Extra columns are passed over. No rows give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import remainder

FOLDS, HELD_OUT = 4, 2
#: Buckets of hashed n-grams, their lengths in bytes, and the share of evidence that is ambiguous.
BUCKETS, LENGTHS, CLOSE = 1 << 14, (2, 3, 4), 0.1

_MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}
#: Lower case, and one blank for every ASCII sign that is no letter.
_LETTERS = bytes(ord(chr(b).lower()) if chr(b).isalpha() else b if b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def grams(text: bytes) -> np.ndarray:
    """The buckets of all byte n-grams of a text, with its words set apart by blanks."""
    a = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    out, code = [], a
    for length in range(2, max(LENGTHS) + 1):
        if len(a) < length:
            break
        code = (code[:-1] << np.uint32(8)) | a[length - 1 :]
        if length in LENGTHS:
            out.append((code * np.uint32(_MULTIPLIERS[length])) >> np.uint32(32 - 14))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode()))


def codewords(languages: int) -> np.ndarray:
    """A codeword of -1 and 1 for each language: all splits for few, a fixed draw of them for many."""
    if languages <= 5:
        splits = np.arange(1, 1 << max(0, languages - 1))
        bits = (splits[None, :] >> np.arange(languages)[:, None]) & 1
        return np.where(bits == 1, 1, -1)
    width = math.ceil(10 * math.log2(languages))
    best, apart = None, -1
    draw = np.random.default_rng(1)
    for _ in range(50):
        code = np.where(draw.random((languages, width)) < 0.5, -1, 1)
        code = code[:, np.abs(code.sum(1 - 1)) < languages]  # every bit has two sides
        products = code @ code.T
        np.fill_diagonal(products, -code.shape[1])
        near = int((code.shape[1] - products.max()) // 2)
        if near > apart:
            best, apart = code, near
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits, 32-bit
    trust: np.ndarray  # languages x bits, rows sum to 1

    def margins(self, found: np.ndarray) -> np.ndarray:
        """How far a text lies on either side of each bit: mean log-odds by the root of its length."""
        n = len(found)
        if n > 4096:
            total = np.bincount(found, minlength=BUCKETS).astype(np.float32) @ self.weights
        else:
            total = self.weights[found].sum(0)
        return total.astype(np.float64) / max(1, n) * math.sqrt(min(n, 400))

    def predict(self, text: bytes) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return "und", 0.0, False
        found = grams(text)
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(found))).sum(1)
        near = np.exp(-(loss - loss.min()) * self.code.shape[1])
        share = near / near.sum()
        order = np.argsort(-share, kind="stable")
        close = len(order) > 1 and share[order[0]] - share[order[1]] < CLOSE
        return self.languages[order[0]], float(share[order[0]]), bool(close)


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n): n-grams of all texts by language; each task adds up its own first."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, languages = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "lang"))
            for text, lang in zip(texts.to_pylist(), languages.to_pylist(), strict=True):
                if text is None or not has_letter(text):
                    continue
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                found = grams(text)
                if len(found) > 4096:
                    sums[lang] += np.bincount(found, minlength=BUCKETS)
                else:
                    np.add.at(sums[lang], found, 1)
        for lang, counts in sums.items():
            hit = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit)), pa.array(hit.astype(np.int32)), pa.array(counts[hit])],
                ["lang", "bucket", "n"],
            )

    found = rows.select(F.col("text").cast("binary").alias("text"), "lang").mapInArrow(run, "lang string, bucket int, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> LanguageModel:
    """Learned from the rows of ``docs`` (doc_id, text, lang) that aren't held out."""
    held_out = F.coalesce(remainder(F.col("doc_id"), FOLDS), F.lit(-1)) == HELD_OUT
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out)
    # Languages times buckets rows, whatever the size of the corpus.
    found = gram_counts(rows).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.zeros((len(languages), BUCKETS))
    at = found["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy(np.int64)
    counts[at, found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy()
    code = codewords(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, np.ones((len(languages), 1)), np.zeros((BUCKETS, 1), np.float32), np.ones((len(languages), 1)))
    profile = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)
    side = np.stack([profile[code[:, b] == 1].mean(0) for b in range(code.shape[1])], 1)
    other = np.stack([profile[code[:, b] == -1].mean(0) for b in range(code.shape[1])], 1)
    weights = np.log(side / other)
    expected = np.maximum(code * (profile @ weights), 1e-3)
    return LanguageModel(languages, code, weights.astype(np.float32), expected / expected.sum(1, keepdims=True))


def predicted(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches):
        for batch in batches:
            ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            found = [model.value.predict(x or b"") for x in texts.to_pylist()]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    held_out = F.coalesce(remainder(F.col("doc_id"), FOLDS), F.lit(-1)) == HELD_OUT
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
