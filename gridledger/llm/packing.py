"""Packing of documents into training sequences, in order, by dynamic programming.

Documents of a partition form one stream of tokens, in the order of its rows. The stream is cut into
windows of at most ``LENGTH`` tokens. Cuts lie at ends of documents or sentences; in stretches without
any, also at fixed steps inside. A window costs its padding, and a cut costs what it truncates:
nothing between documents, a little between sentences, more inside one. With positions p and least
costs f, f(j) = cut(j) + LENGTH - p(j) + min(f(i) + p(i)) over the i at most LENGTH before j: a
sliding minimum, kept in a queue whose values only rise.

The stream is solved in stretches of bounded size; the last windows of each are solved again with
what follows. What is left at the end of a partition is cut into windows whose lengths are powers of
two, which need no padding, if that is cheaper than to pad it.

Defined results: a null text is as an empty one, whose only token is the end mark; a very long text
is cut into as many pieces as it needs; repeated rows and doc_ids are documents of their own; a null
doc_id stays null. Extra columns are passed over. No rows give no rows. Sequence ids are distinct
over partitions, not gapless.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from gridledger.llm.common import texts_of

LENGTH, END = 2048, 1
#: What a cut costs, in tokens of padding: after a sentence, inside one.
AFTER_SENTENCE, INSIDE = 2, 16
#: Positions inside a stretch without ends, the windows solved at a time, and those solved again.
STEP, WINDOWS, AGAIN = 32, 256, 8
#: Words whose tokens a worker keeps before it starts anew.
KEPT = 300_000


def _byte_signs() -> dict[int, int]:
    """Byte-level BPE writes bytes as printable signs: those that are keep their code, others follow 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + n for n, b in enumerate(others)}


class _Numbers(dict):
    """Numbers of words, from 0 on, given as they are first asked for; new ones are listed."""

    def __init__(self, *given) -> None:
        super().__init__(*given)
        self.new: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def _gathered(values: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``values`` in a row (run k goes from starts[k] to starts[k + 1]), and their bounds."""
    sizes = starts[at + 1] - starts[at]
    upto = np.append(0, np.cumsum(sizes))
    return values[np.arange(upto[-1]) + np.repeat(starts[at] - upto[:-1], sizes)], upto


class WordTokens:
    """Token ids of texts, exactly as the tokenizer gives them, with the ids of known words kept.

    No token crosses white space, so that words are encoded each for itself. Words in printable
    Latin-1 are split by the tokenizer's own pattern and meet its model in one long line; all others
    go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(f"{split}|\\n")
        self.odd = regex.compile("[^!-~¡-¬®-ÿ\\n]|<\\|")
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.signs = _byte_signs() | {32: 32, 10: 10}
        end = parts["model"]["end_of_word_suffix"]
        size = self.whole.get_vocab_size()
        self.word_end, self.sentence_end = np.zeros(size, bool), np.zeros(size, bool)
        for token, number in self.whole.get_vocab().items():
            if token.endswith(end):
                self.word_end[number] = True
                self.sentence_end[number] = token[: -len(end)][-1:] in (".", "!", "?")
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.starts, self.known = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.pieces_seen = _Numbers({"\n": 0})
        self.piece_starts, self.piece_ids = np.zeros(2, np.int64), np.zeros(0, np.uint32)

    def _of_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        found = self.pieces.findall("\n".join(words).lower() + "\n")
        mark = self.pieces_seen["\n"]  # number 0, without tokens
        at = np.fromiter(map(self.pieces_seen.__getitem__, found), np.int64, len(found))
        if self.pieces_seen.new:
            line = " ".join(self.pieces_seen.new)
            if not line.isascii():
                line = line.encode().decode("latin-1").translate(self.signs)
            ids = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            self.piece_ids = np.concatenate([self.piece_ids, ids])
            self.piece_starts = np.append(self.piece_starts, self.piece_starts[-1] + ends)
            self.pieces_seen.new = []
        ids, upto = _gathered(self.piece_ids, self.piece_starts, at)
        return ids, np.diff(upto[np.append(0, np.flatnonzero(at == mark))])

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        ids, sizes = [], []
        for at in range(0, len(texts), 20_000):
            part = texts[at : at + 20_000]
            if not self.odd.search("\n".join(part)):
                found, count = self._of_plain(part)
                ids.append(found)
                sizes.append(count)
                continue
            # Some are not plain: those alone go through the whole tokenizer.
            odd = np.array([bool(self.odd.search(t)) for t in part])
            each = iter(self.whole.encode_batch_fast([t for t, o in zip(part, odd, strict=True) if o], add_special_tokens=False))
            found, count = self._of_plain([t for t, o in zip(part, odd, strict=True) if not o])
            rest = iter(np.split(found, np.cumsum(count)[:-1]) if len(count) else ())
            both = [np.array(next(each).ids, np.uint32) if o else next(rest) for o in odd]
            ids += both
            sizes.append(np.array([len(x) for x in both], np.int64))
        self.known = np.concatenate([self.known, *ids])
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes)))

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.numbers) > KEPT:
            self._forget()
        words = [t.split() for t in texts]  # of bytes: ASCII white space only
        counts = np.array([len(w) for w in words])
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, counts.sum())
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        found, upto = _gathered(self.known, self.starts, at)
        return np.split(found, upto[np.cumsum(counts)[:-1]]) if len(texts) else []


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One per worker process, kept from task to task."""
    return WordTokens(path)


def cuts(ends: np.ndarray, costs: np.ndarray, length: int) -> list[int]:
    """The cheapest cuts of a stream: positions among ``ends`` (rising, from 0 on), the last included.

    ``costs`` are those of a cut at each position. Neighbours must not be farther than ``length``.
    """
    p, c = ends.tolist(), costs.tolist()
    best, back = [0.0] * len(p), [0] * len(p)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(p)):
        at = p[j]
        while at - p[queue[0][1]] > length:
            queue.popleft()
        value, i = queue[0]
        cost = c[j] + length - at + value
        best[j], back[j] = cost, i
        value = cost + at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], len(p) - 1
    while j:
        out.append(p[j])
        j = back[j]
    return out[::-1]


def positions(ids: np.ndarray, documents: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, and at what cost. ``documents``: the ends of documents."""
    n = len(ids)
    cost = np.full(n + 1, np.inf)
    cost[1:][sentence_end[ids]] = AFTER_SENTENCE
    cost[documents] = 0
    cost[0] = cost[n] = 0
    ends = np.flatnonzero(np.isfinite(cost))
    gaps = np.flatnonzero(np.diff(ends) > STEP)
    if len(gaps):
        inside = np.concatenate([np.arange(ends[g] + STEP, ends[g + 1], STEP) for g in gaps])
        cost[inside] = INSIDE
        ends = np.flatnonzero(np.isfinite(cost))
    return ends, cost[ends]


def tail(size: int, length: int) -> list[int]:
    """Lengths of the windows for the last ``size`` (<= length) tokens."""
    powers = [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]
    return powers if (len(powers) - 1) * INSIDE < length - size else [size]


class Packer:
    """Takes documents one after another; gives rows of pieces as soon as windows are settled."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, length: int = LENGTH) -> None:
        self.sentence_end, self.sequence, self.length = sentence_end, first_sequence, length
        # Of each document not yet settled: id, number of tokens, tokens settled, tokens left.
        self.held: list[tuple[int | None, int, int, np.ndarray]] = []
        self.size = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append((doc_id, len(ids), 0, ids))
        self.size += len(ids)
        if self.size >= WINDOWS * self.length:
            self._settle(last=False)

    def _settle(self, last: bool) -> None:
        if not self.size:
            return
        ids = np.concatenate([d[3] for d in self.held])
        ends, costs = positions(ids, np.cumsum([len(d[3]) for d in self.held]), self.sentence_end)
        at = cuts(ends, costs, self.length)
        if last:
            start = at[-2] if len(at) > 1 else 0
            at = [*at[:-1], *(start + np.cumsum(tail(len(ids) - start, self.length))).tolist()]
        else:
            at = at[:-AGAIN]
        self._write(at)

    def _write(self, at: list[int]) -> None:
        document, begin, window = 0, 0, 0
        doc_id, total, settled, ids = self.held[0]
        done = 0  # of this document, in this call
        for end in at:
            offset = 0
            while begin < end:
                take = min(end - begin, len(ids) - done)
                crc = zlib.crc32(ids[done : done + take].astype("<u4").tobytes())
                self.rows.append((doc_id, settled + done, take, crc, total, self.sequence + window, offset))
                begin, done, offset = begin + take, done + take, offset + take
                if done == len(ids):
                    document += 1
                    done = 0
                    if document < len(self.held):
                        doc_id, total, settled, ids = self.held[document]
            window += 1
        self.sequence += window
        rest = self.held[document:]
        if done:
            rest[0] = (doc_id, total, settled + done, ids[done:])
        self.held, self.size = rest, self.size - begin

    def finish(self) -> None:
        self._settle(last=True)


def packed(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the pieces of ``docs``.

    ``tokenizer``: the path of a tokenizer file of words with ends, which all nodes have.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        tokens = word_tokens(path)
        packer = Packer(tokens.sentence_end, TaskContext.get().partitionId() << 36)

        def ready():
            columns = list(zip(*packer.rows, strict=True))
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                doc_ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                for doc_id, ids in zip(doc_ids, tokens.ids(texts_of(part)), strict=True):
                    packer.add(doc_id, np.append(ids, np.uint32(END)))
                if len(packer.rows) > 4096:
                    yield ready()
        packer.finish()
        if packer.rows:
            yield ready()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))
