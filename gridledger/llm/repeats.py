"""Repeated passages: every byte that lies in a string of 200 bytes which starts twice or more.

Suffixes are sorted in buckets, one block of them at a time, and neighbours in that order tell which
strings of 200 bytes occur twice. A difference cover bounds the work on long ties: positions of a
block whose remainder lies in the cover are ranked beforehand, by doubling, and any two suffixes that
agree on their first bytes are told apart by the ranks at the first place where both meet the cover.

To sort only what can be equal, suffixes are dealt to their buckets by an anchor: of the grams of 48
bytes in a string of 200, the one of the least hash. Equal strings have their anchor at the same place,
so that they share a bucket, and neighbouring strings share anchors, so that a run of suffixes travels
as one slice of text:

1. each document gives its runs (hash of the anchor, hash of the slice, place);
2. anchors that occur once are of strings that occur once, and go;
3. equal slices are one class; in classes of two places all strings are repeated;
4. the slices left, one of each class, are cut out of their texts, come together by anchor, and are
   sorted in blocks of about a megabyte. In buckets of too many different slices for that, each is cut
   in two by the place of the anchor in its strings: the parts share more bytes than the anchor, by
   which they are dealt to smaller buckets, and steps 3 and 4 go on with them.

Defined results: a null text is empty; texts under 200 bytes keep all; a text that occurs more than
once, in whichever rows, is one to all steps, and is removed whole in each of them if it has 200 bytes;
doc_id may be null or repeat; cuts may fall into a character. Extra columns are passed over. No rows
give no rows.
"""

from __future__ import annotations

from functools import cache, cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch, saved, texts_of

#: Bytes of a string, of an anchor, and anchors to choose from in one string.
WINDOW, GRAM = 200, 48
CHOICES = WINDOW - GRAM + 1
#: Starts of strings that are hashed together, and bytes of short texts that are joined for it.
CHUNK, JOINED = 1 << 16, 1 << 18
#: Bytes of a sorted block, and slices of a bucket up to which it is sorted in one.
BLOCK_BYTES, BUCKET_SLICES = 1 << 20, 2048
#: Period of the cover, which is also the number of bytes that are compared before ranks are.
PERIOD = 32

_PLACE = np.uint64((1 << 18) - 1)
RUN = "digest binary, h long, s long, a int, span int, off int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


@cache
def _base() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and powers of an odd random number and of its inverse."""
    draw = np.random.default_rng(1)
    table = draw.integers(0, 1 << 64, 256, np.uint64)
    factor = int(draw.integers(0, 1 << 62)) * 4 + 3
    size = CHUNK + 2 * WINDOW + 1
    powers = np.full(size, factor, np.uint64)
    inverse = np.full(size, pow(factor, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return table, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def _sums(data: np.ndarray) -> np.ndarray:
    """Sums of which differences, shifted back, are hashes of the strings between two places."""
    table, powers, _ = _base()
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers[: len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed((sums[end] - sums[start]) * _base()[2][start])


def runs(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, span, off, h, s) of the runs of strings with one anchor, in texts that stand in a row.

    A run has the strings that start at a, .., a + span; its anchor starts at a + off.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    long = lengths >= WINDOW
    # 1 where a string that starts there lies in one text.
    steps = np.zeros(len(data) + 1, np.int8)
    np.add.at(steps, starts[long], 1)
    np.add.at(steps, ends[long] - WINDOW + 1, -1)
    whole = np.cumsum(steps, dtype=np.int8)[:-1]
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    last = len(data) - WINDOW + 1
    while at < last:
        to = min(at + CHUNK, last)
        piece = data[at : to + WINDOW - 1]
        sums = _sums(piece)
        grams = len(piece) - GRAM + 1
        h = _mixed((sums[GRAM:] - sums[:-GRAM]) * _base()[2][:grams])
        # The place stands in the low bits: of equal hashes the first counts.
        least = (h & ~_PLACE) | np.arange(grams, dtype=np.uint64)
        width = 1
        while width * 2 <= CHOICES:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = CHOICES - width
        least = np.minimum(least[: to - at], least[rest : rest + to - at]) if rest else least
        anchor = np.where(whole[at:to] > 0, (least & _PLACE).astype(np.int64), -1)
        cut = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        upto = np.append(cut[1:], len(anchor)) - 1
        if to < last and len(cut) > 1:
            # The last run may go on: it is the next chunk's first.
            cut, upto, to = cut[:-1], upto[:-1], at + int(cut[-1])
        used = anchor[cut] >= 0
        a, b = cut[used], upto[used]
        off = anchor[a] - a
        s = _hashes(sums, a, b + WINDOW) ^ ((b - a) * 1024 + off).astype(np.uint64)
        out.append((a + at, b - a, off, h[a + off], _mixed(s)))
        at = to
    if not out:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def anchored(texts: DataFrame) -> DataFrame:
    """The runs (``RUN``) of (digest, text); in a task, a text that occurs again gives none."""

    def rows(digests: list[bytes], held: list[bytes]):
        lengths = np.array([len(x) for x in held], np.int64)
        a, span, off, h, s = runs(np.frombuffer(b"".join(held), np.uint8), lengths)
        ends = np.cumsum(lengths)
        own = np.searchsorted(ends, a, "right")
        a = a - (ends - lengths)[own]
        keys = pa.array(digests, pa.binary()).take(pa.array(own))
        columns = [keys, pa.array(h.view(np.int64)), pa.array(s.view(np.int64))]
        columns += [pa.array(x.astype(np.int32)) for x in (a, span, off)]
        return pa.RecordBatch.from_arrays(columns, ["digest", "h", "s", "a", "span", "off"])

    def run(batches):
        seen: set[bytes] = set()
        digests: list[bytes] = []
        held: list[bytes] = []
        size = 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("digest")).to_pylist()
            for key, text in zip(keys, texts_of(batch), strict=True):
                if len(text) < WINDOW or key in seen:
                    continue
                seen.add(key)
                digests.append(key)
                held.append(text)
                size += len(text)
                if size >= JOINED:
                    yield rows(digests, held)
                    digests, held, size = [], [], 0
        if held:
            yield rows(digests, held)

    return texts.mapInArrow(run, RUN)


@cache
def difference_cover(period: int) -> np.ndarray:
    """Remainders of which every number up to the period is a difference, found greedily."""
    cover, found = [0], {0}
    while len(found) < period:

        def gain(x: int) -> int:
            return len({d for y in cover for d in ((x - y) % period, (y - x) % period)} - found)

        best = max(range(period), key=lambda x: (gain(x), -x))
        found |= {d for y in cover for d in ((best - y) % period, (y - best) % period)}
        cover.append(best)
    return np.array(sorted(cover))


@cache
def _shifts(period: int) -> np.ndarray:
    """For two remainders, the least distance after which both are in the cover."""
    inside = np.zeros(period, bool)
    inside[difference_cover(period)] = True
    out = np.full((period, period), -1)
    r = np.arange(period)
    for d in range(period - 1, -1, -1):
        hit = inside[(r + d) % period]
        out[np.ix_(hit, hit)] = d
    return out


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number in the order of bytes; ``data`` is padded."""
    return np.ndarray((len(data) - 7,), ">u8", data.tobytes(), strides=(1,))


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """The rank of each row by the keys in turn; equal rows have one rank."""
    rank = None
    for key in keys:
        own = np.unique(key, return_inverse=True)[1].astype(np.uint64)
        if rank is not None:
            own = np.unique(rank << np.uint64(32) | own, return_inverse=True)[1].astype(np.uint64)
        rank = own
    return rank


class Block:
    """The suffixes of a text, in order by their first ``WINDOW`` bytes."""

    def __init__(self, data: bytes) -> None:
        self.size = len(data)
        self.words = _words(np.frombuffer(data + bytes(WINDOW + 2 * PERIOD + 8), np.uint8))
        self.ranks = self._cover_ranks()

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.words[at].astype(np.uint64)

    def _cover_ranks(self) -> np.ndarray:
        """The rank of every place of the cover by ``WINDOW`` bytes or more; other places have none.

        Places past the end count as one more of least rank.
        """
        cover, size = difference_cover(PERIOD), self.size + PERIOD
        at = (np.arange(0, size, PERIOD)[:, None] + cover[None, :]).ravel()
        at = at[at < size]
        index = np.zeros(size + 1, np.int64)
        index[at] = np.arange(1, len(at) + 1)
        rank = _ranked(*(self.word(at + k) for k in range(0, PERIOD, 8)))
        depth = PERIOD
        while depth < WINDOW:
            # A whole number of periods further on lies a place of the cover again.
            behind = np.append(np.uint64(0), rank + np.uint64(1))[index[np.minimum(at + depth, size)]]
            rank = _ranked(rank, behind)
            depth *= 2
        out = np.full(size + 1, -1, np.int64)
        out[at] = rank.astype(np.int64)
        return out

    def _after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts after suffix b, for suffixes that agree on the first bytes."""
        shift = _shifts(PERIOD)[a % PERIOD, b % PERIOD]
        return self.ranks[a + shift] > self.ranks[b + shift]

    def in_order(self, suffixes: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the suffixes in each bucket, and for each the number of its tie on the first bytes."""
        keys = [self.word(suffixes + k) for k in range(PERIOD - 8, -1, -8)]
        order = np.lexsort([*keys, bucket])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for key in (*keys, bucket):
            new[1:] |= key[order][1:] != key[order][:-1]
        tie = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(order)))
        sorted_at = suffixes[order]
        for start, n in zip(first[sizes > PERIOD].tolist(), sizes[sizes > PERIOD].tolist(), strict=True):
            self._sort_long(sorted_at, order, start, n)
        # Short ties all at once: neighbours change places as long as any are out of order.
        small = (sizes <= PERIOD)[tie]
        pairs = np.flatnonzero(~new & small)
        parity = 0
        for _ in range(int(sizes[sizes <= PERIOD].max(initial=1)) if len(pairs) else 0):
            right = pairs[(pairs - first[tie[pairs]]) % 2 != parity]
            parity ^= 1
            wrong = right[self._after(sorted_at[right - 1], sorted_at[right])]
            for x in (sorted_at, order):
                x[wrong - 1], x[wrong] = x[wrong], x[wrong - 1]
        return order, tie

    def _sort_long(self, sorted_at: np.ndarray, order: np.ndarray, start: int, n: int) -> None:
        ranks, shifts = self.ranks, _shifts(PERIOD)

        def compare(x: tuple[int, int], y: tuple[int, int]) -> int:
            shift = shifts[x[0] % PERIOD, y[0] % PERIOD]
            return int(ranks[x[0] + shift]) - int(ranks[y[0] + shift])

        part = slice(start, start + n)
        done = sorted(zip(sorted_at[part].tolist(), order[part].tolist(), strict=True), key=cmp_to_key(compare))
        sorted_at[part], order[part] = [x for x, _ in done], [x for _, x in done]

    def repeated(self, suffixes: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Whether the first ``WINDOW`` bytes of each suffix are those of another of its bucket."""
        out = np.zeros(len(suffixes), bool)
        if len(suffixes) < 2:
            return out
        order, tie = self.in_order(suffixes, bucket)
        right = np.flatnonzero(tie[1:] == tie[:-1]) + 1
        for k in (*range(PERIOD, WINDOW - 8, 8), WINDOW - 8):
            a, b = suffixes[order[right - 1]], suffixes[order[right]]
            right = right[self.word(a + k) == self.word(b + k)]
        out[order[right]] = out[order[right - 1]] = True
        return out


def _marks(slices: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    """(h, s, starts, ends) for the slices (h, s, span, off, content) of whole buckets: the runs of
    strings, counted from the slice's first, that another slice of the bucket has too."""
    block = Block(b"".join(x[4] for x in slices))
    sizes = np.array([len(x[4]) for x in slices])
    counts = np.array([x[2] + 1 for x in slices])
    begin, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
    own = np.repeat(np.arange(len(slices)), counts)
    at = np.arange(counts.sum()) - first[own]
    # Strings are equal only if their anchors are, at the same place.
    anchor = np.unique([x[0] for x in slices], return_inverse=True)[1]
    bucket = anchor[own] * WINDOW + (np.array([x[3] for x in slices])[own] - at)
    hit = block.repeated(begin[own] + at, bucket)
    # Runs of them, which end with their slice.
    other = np.append(True, own[1:] != own[:-1])
    starts = np.flatnonzero(hit & (other | ~np.append(False, hit[:-1])))
    ends = np.flatnonzero(hit & (np.append(other[1:], True) | ~np.append(hit[1:], False)))
    found, at_slice = np.unique(own[starts], return_index=True)
    bounds = np.append(at_slice, len(starts)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(bounds, at[x].astype(np.int32)) for x in (starts, ends)]
    keys = [pa.array([slices[k][c] for k in found], pa.int64()) for c in (0, 1)]
    return pa.RecordBatch.from_arrays([*keys, *lists], ["h", "s", "starts", "ends"])


MARK = "h long, s long, starts array<int>, ends array<int>"


def sorted_marks(slices: DataFrame) -> DataFrame:
    """``MARK`` for slices (h, s, span, off, content) of buckets that fit a block."""

    def run(batches):
        held: list[tuple] = []
        size, before = 0, None
        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("h", "s", "span", "off", "content"))
            for row in zip(*columns, strict=True):
                if row[:2] == before:  # cut out of another copy of its text
                    continue
                if size >= BLOCK_BYTES and row[0] != before[0]:
                    yield _marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                before = row[:2]
        if held:
            yield _marks(held)

    slices = slices.select("h", "s", "span", "off", "content")
    return slices.repartition("h").sortWithinPartitions("h", "s").mapInArrow(run, MARK)


def _split(slices: DataFrame, level: int) -> DataFrame:
    """The slices cut by the place of the anchor in their strings, in parts of 256 >> ``level`` places.

    All strings of a part hold the bytes around the anchor that the first and the last one share: these
    are the key of the part's bucket.
    """
    size = 256 >> level

    def run(batches):
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _WHOLE]
            out: list[tuple] = []
            for h0, s0, first, span, off, known, content in zip(*columns, strict=True):
                for j in range((off - span) // size, off // size + 1):
                    low, high = j * size, min(j * size + size, CHOICES) - 1
                    least, most = max(low, off - span), min(high, off)
                    part = content[off - most : off - least + WINDOW]
                    key = xxhash.xxh3_64_intdigest(content[off - low : off - high + WINDOW] + bytes([level, j]))
                    own = xxhash.xxh3_64_intdigest(part + bytes([least, most]))
                    row = key - (1 << 63), own - (1 << 63), h0, s0, first + off - most, most - least, most, known, part
                    out.append(row)
            if out:
                arrays = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "s", *_WHOLE])

    kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.bool_(), pa.binary()]
    return slices.select(*_WHOLE).mapInArrow(
        run, "h long, s long, h0 long, s0 long, first int, span int, off int, known boolean, content binary"
    )


#: A part of a slice (h0, s0), from its string ``first`` on.
_WHOLE = ("h0", "s0", "first", "span", "off", "known", "content")


def all_marks(slices: DataFrame, scratch: Scratch) -> DataFrame:
    """``MARK`` for all slices (h, s, span, off, known, many, content).

    The slices of a bucket of ``many`` are cut into parts, which have buckets of their own; equal parts
    of two slices are repeated, and of them one goes on. This is repeated until buckets fit, or parts
    are single strings, which are equal or not.
    """
    out = sorted_marks(slices.filter("not many"))
    rest = slices.filter("many").withColumns({"h0": F.col("h"), "s0": F.col("s"), "first": F.lit(0)})
    level = 0
    while rest.select(F.lit(1)).take(1):
        level += 1
        parts = scratch.saved(_split(rest, level), "parts")
        owner = F.xxhash64("h0", "s0")
        classes = parts.groupBy("h", "s").agg(
            (F.min(owner) < F.max(owner)).alias("again"),
            F.bool_and("known").alias("known"),
            F.first(F.struct("h0", "s0", "first", "span", "off", "content")).alias("part"),
        )
        classes = classes.select("h", "s", "again", (F.col("again") | F.col("known")).alias("known"), "part.*")
        classes = scratch.saved(classes, "parts")
        buckets = _buckets(classes, scratch)
        equal = parts.filter("not known").join(classes.filter("again").select("h", "s"), ["h", "s"])
        end = (F.col("first") + F.col("span")).alias("ends")
        out = out.union(equal.select("h0", "s0", F.array("first"), F.array(end)))
        left = scratch.saved(classes.join(buckets, "h"), "parts")
        own = classes.filter("not known").select("h", "s", "h0", "s0", "first")
        found = sorted_marks(left.filter("not many")).join(own, ["h", "s"])
        shifted = (F.transform(c, lambda x: x + F.col("first")) for c in ("starts", "ends"))
        out = out.union(found.select("h0", "s0", *shifted))
        rest = left.filter("many")
    return out


def _buckets(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(h, many) of the buckets with a slice that is not known to be repeated, and another slice."""
    sizes = classes.groupBy("h").agg(F.count("*").alias("n"), F.bool_and("known").alias("known"))
    sizes = sizes.filter("n > 1 and not known").select("h", (F.col("n") > BUCKET_SLICES).alias("many"))
    return scratch.saved(sizes, "buckets")


def _cut(texts: DataFrame) -> DataFrame:
    """The slices (h, s, span, off, known, many, content) that are wanted of each text."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("digest")).to_pylist()
            wanted = batch.column(batch.schema.get_field_index("wanted"))
            for k, (key, text) in enumerate(zip(keys, texts_of(batch), strict=True)):
                if key in seen:
                    continue
                seen.add(key)
                slices = wanted[k].as_py()
                content = [text[x["a"] : x["a"] + x["span"] + WINDOW] for x in slices]
                names = ["h", "s", "span", "off", "known", "many"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
                columns = [pa.array([x[c] for x in slices], kind) for c, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(content, pa.binary())], [*names, "content"])

    return texts.select("digest", "text", "wanted").mapInArrow(
        run, "h long, s long, span int, off int, known boolean, many boolean, content binary"
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(digest, copied, starts, ends) of each text of ``docs`` that has repeated strings: the places
    of their first bytes, in runs; all are repeated where the text itself is ``copied``."""
    texts = docs.select(_digest(F.col("text")).alias("digest"), "text")
    scratch = Scratch()
    found = scratch.saved(anchored(texts), "runs")
    place = F.xxhash64("digest", "a")
    twice = found.groupBy("h").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    twice = scratch.saved(twice.filter("low <> high").select("h"), "anchors")
    common = scratch.saved(found.join(twice, "h"), "common")
    classes = common.groupBy("h", "s").agg(
        (F.min(place) < F.max(place)).alias("known"),
        F.first("span").alias("span"),
        F.first("off").alias("off"),
        F.min(F.struct("digest", "a")).alias("home"),
    )
    classes = scratch.saved(classes, "classes")
    wanted = classes.join(_buckets(classes, scratch), "h")
    wanted = wanted.select("home.digest", F.struct("h", "s", "home.a", "span", "off", "known", "many").alias("x"))
    wanted = wanted.groupBy("digest").agg(F.collect_list("x").alias("wanted"))
    slices = scratch.saved(_cut(texts.join(wanted, "digest")), "slices")
    marks = all_marks(slices, scratch)
    marks = scratch.saved(marks, "marks")
    known = classes.filter("known").select("h", "s", F.array(F.lit(0)).alias("starts"), F.array("span").alias("ends"))
    marks = known.union(marks.join(classes.filter("not known").select("h", "s"), ["h", "s"]).select(known.columns))
    copied = docs.groupBy(_digest(F.col("text")).alias("digest")).agg(F.count("*").alias("n")).filter("n > 1")
    copied = scratch.saved(copied.select("digest"), "copied")
    own = common.join(copied, "digest", "left_anti").join(marks, ["h", "s"])
    shifted = {c: F.transform(c, lambda x: x + F.col("a")) for c in ("starts", "ends")}
    own = own.withColumns(shifted).groupBy("digest")
    own = own.agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")))
    nothing = F.lit(None).cast("array<int>")
    out = own.select("digest", F.lit(False).alias("copied"), "starts", "ends").union(
        copied.select("digest", F.lit(True), nothing, nothing)
    )
    out = saved(out, "repeats")
    scratch.clear()
    return out


def _removed(size: int, copied: bool | None, starts, ends) -> list[tuple[int, int]]:
    """The runs of bytes that go: strings start at ``starts`` to ``ends``, of equal length."""
    if size < WINDOW or copied is None:
        return []
    if copied:
        return [(0, size)]
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end + WINDOW)
        else:
            out.append((start, end + WINDOW))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed: array of (start, end), kept: binary) for each row of ``docs``."""
    rows = docs.select("doc_id", "text", _digest(F.col("text")).alias("digest"))
    rows = rows.join(repeated_spans(docs), "digest", "left").select("doc_id", "text", "copied", "starts", "ends")
    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, n_bytes long, removed array<struct<start: int, end: int>>, kept binary"
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                copied, starts, ends = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("copied", "starts", "ends"))
                removed, kept, sizes = [], [], []
                for text, *known in zip(texts_of(part), copied, starts, ends, strict=True):
                    gone = _removed(len(text), *known)
                    removed.append([{"start": a, "end": b} for a, b in gone])
                    sizes.append(len(text))
                    bounds = [0, *(x for pair in gone for x in pair), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
                columns = [pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())]
                doc_id = part.column(part.schema.get_field_index("doc_id"))
                yield pa.RecordBatch.from_arrays([doc_id, *columns], ["doc_id", "n_bytes", "removed", "kept"])

    return rows.mapInArrow(run, schema)


def removed_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``."""
    return without_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
