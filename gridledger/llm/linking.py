"""Groups of near-equal sets: MinHash buckets, blocks of exact comparison, connected components.

Both near-duplicate operators use it, on documents and on lines. The way from signatures to groups:

1. Each set gives one key per band of its signature; sets that share a key share a bucket. Buckets
   with the same members count once. Every member is compared with its bucket's smallest member by
   the signatures; those that look unlike it are compared among each other, in blocks, and, where
   sets need not share more than one key, with those that look like it too. This gives stars of
   likely links, with at most one row per member and bucket (and block), never all pairs.
2. The components of the stars are the likely groups. A group is dealt to blocks, each of which gets
   its first set too, and the full sets of a block give a forest of exact links. Chance links join groups to
   ever larger ones as a table grows; a group of more than GROUP_BLOCKS blocks is therefore not compared as
   a whole, but by its stars, to which those of each bucket's unlike members with the others are added.
3. In groups of several blocks, the largest part that is linked by now needs no comparing within
   itself; the sets outside of it are compared with all others of the group, block by block.
4. The components of the exact links are the result.

The signature bound of step 1 lies four standard deviations below the threshold, so that it passes all
but one in 30,000 links at the threshold; steps 2 and 3 alone decide. A group of near-equal sets costs its own size in rows, however
large; only sets apart from the largest part, and those of several stars, are copied more than once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch, block_pairs, by_group, forest, lean, saved, spread, whole_groups
from gridledger.llm.components import components

#: What near_rows needs of each row of documents: ``at`` is a hash of the text, ``digest`` one of the set.
SKETCH = "doc_id long, at long, size long, digest binary, sig binary, keys array<long>"

#: Members of a bucket that meet in one block by their signatures, sets by their full elements,
#: and elements in a block. Sets that are compared one by one with the others of a block, before all
#: are by products of matrices.
SIGNATURE_BLOCK, SET_BLOCK, ELEMENT_BLOCK, SEARCHES = 4096, 256, 1_000_000, 16
#: Blocks of a group that is compared as a whole, and searches of a block without a link before it is given up.
GROUP_BLOCKS, FRUITLESS = 32, 4
#: Elements of small blocks that are compared at once.
ELEMENTS_AT_ONCE = 200_000
#: Keys that a task sorts at once, items for each pack of keys, and keys in a row of those known to be shared.
KEYS_AT_ONCE, PACK_ITEMS, ROW_KEYS = 1 << 19, 1 << 14, 1 << 12
#: Standard deviations below the threshold at which signatures still look alike.
DEVIATIONS = 4


def looks_alike(coordinates: int, threshold: float) -> int:
    """The least number of equal coordinates (of one byte) that sets at the threshold may have."""
    return math.floor(coordinates * threshold - DEVIATIONS * math.sqrt(coordinates * threshold * (1 - threshold)))


def bands(minima: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates, for each row of ``minima`` (uint32)."""
    n, k = minima.shape
    keys = np.zeros((n, k // rows), np.uint64)
    keys += np.arange(1, k // rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        keys ^= minima[:, r : k // rows * rows : rows].astype(np.uint64) + np.uint64(r << 33)
        keys *= np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(32)
    return keys


def minima(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Circulant MinHash: ``count`` coordinates of each run of 32-bit hashes from ``starts`` on.

    One permutation (``scattered``) breaks up the order of the elements. A second one, shifted by k,
    gives coordinate k: the smallest value over the run. No run may be empty.
    """
    out = np.empty((len(starts), count), np.uint32)
    if not len(starts):
        return out
    first = scattered(hashes)
    ends = np.append(starts[1:], len(hashes))
    # Slices of whole runs that fit a core's cache.
    step, at = 1 << 15, 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + step, "right")))
        x = first[starts[at] : ends[to - 1]]
        low, y, z = starts[at:to] - starts[at], np.empty_like(x), np.empty_like(x)
        for k in range(count):
            np.subtract(x, np.uint32(k), out=y)
            np.multiply(y, np.uint32(0x9E3779B1), out=y)
            np.right_shift(y, np.uint32(15), out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, np.uint32(0x85EBCA77), out=y)
            out[at:to, k] = np.minimum.reduceat(y, low)
        at = to
    return out


def scattered(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    y = x.astype(np.uint32)
    y ^= y >> np.uint32(16)
    y *= np.uint32(0x7FEB352D)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x846CA68B)
    y ^= y >> np.uint32(16)
    return y


def _bytes(column) -> np.ndarray:
    """A column of binary values of one length, as rows of bytes."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _star_rows(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
    """Of the items that the links join, the first one with each of the others."""
    first, before = np.arange(len(ids)), None
    while before is None or (first != before).any():
        before = first.copy()
        low = np.minimum(first[left], first[right])
        np.minimum.at(first, left, low)
        np.minimum.at(first, right, low)
        first = first[first]
    others = np.flatnonzero(first != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[first[others]]), pa.array(ids[others])], ["a", "b"])


def _signatures_alike(least: int):
    def run(group: pa.Table):
        n = group.num_rows
        if n < 2:
            return None
        signs, block = _bytes(group["sig"]), group["block"].to_numpy()
        across = group["low"][0].as_py() != group["high"][0].as_py()
        left, right = [], []
        for i in range(n - 1):
            same = (signs[i + 1 :] == signs[i]).sum(1) >= least
            if across:
                same &= block[i + 1 :] != block[i]
            hit = np.flatnonzero(same)
            left.append(np.full(len(hit), i))
            right.append(hit + i + 1)
        return _star_rows(group["id"].to_numpy(), np.concatenate(left), np.concatenate(right))

    return run


def _unlike_with_alike(least: int):
    def run(group: pa.Table):
        alike = group["alike"].to_numpy(zero_copy_only=False)
        signs, like = _bytes(group["sig"]), np.flatnonzero(alike)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(~alike):
            hit = like[(signs[like] == signs[i]).sum(1) >= least]
            left.append(np.full(len(hit), i))
            right.append(hit)
        return _star_rows(group["id"].to_numpy(), np.concatenate(left), np.concatenate(right))

    return run


def _longs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values that hold the longs of ``values`` from each of ``starts`` to the next."""
    offsets = pa.py_buffer((np.append(starts, len(values)) * 8).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _packed(keys: np.ndarray, ids: np.ndarray, packs: int):
    """Rows of (pack, kind, keys, ids): the first item of each key in the pack of its key, with kind 1 if
    the key has more items here, else 0; the other items, whose keys are shared, in any pack, with kind 2."""
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(mixed)
    mixed, keys, ids = mixed[order], keys[order], ids[order]
    new = np.append(True, mixed[1:] != mixed[:-1])
    more = np.append(mixed[1:] == mixed[:-1], False)
    # Packs are ranges of the mixed keys.
    pack = ((mixed >> np.uint64(32)) * np.uint64(packs) >> np.uint64(32)).astype(np.int32)
    for kind, chosen in ((0, new & ~more), (1, new & more), (2, ~new)):
        k, i, to = keys[chosen], ids[chosen], pack[chosen]
        if not len(k):
            continue
        if kind < 2:
            starts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            to = to[starts]
        else:
            starts = np.arange(0, len(k), ROW_KEYS)
            to = ((np.arange(len(starts)) + i[0]) % packs).astype(np.int32)
        columns = [pa.array(to), pa.array(np.full(len(to), kind, np.int32)), _longs(k, starts), _longs(i, starts)]
        yield pa.RecordBatch.from_arrays(columns, ["pack", "kind", "keys", "ids"])


def _shared_of_pack(group: pa.Table):
    lengths = pc.binary_length(group["keys"]).to_numpy() // 8
    kind = np.repeat(group["kind"].to_numpy(), lengths)
    keys, ids = (np.frombuffer(b"".join(group[c].to_pylist()), np.int64) for c in ("keys", "ids"))
    known = kind == 2
    rest = np.flatnonzero(~known)
    rest = rest[np.argsort(keys[rest])]
    out = [np.flatnonzero(known)]
    if len(rest):
        k = keys[rest]
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        counts = np.diff(np.append(starts, len(k)))
        shared = (counts > 1) | np.logical_or.reduceat(kind[rest] == 1, starts)
        out.append(rest[np.repeat(shared, counts)])
    at = np.concatenate(out)
    return pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(ids[at])], ["key", "id"])


def shared_keys(items: DataFrame) -> DataFrame:
    """(key, id) for the keys that several items have. ``items``: id, keys; or as in ``Packed``.

    Most keys are of one item only, and rows of their own would cost more than all else. Tasks therefore
    send keys as packs of numbers, by ranges of a hash, with one item for each key that a task has sorted;
    a key of very many items so loads no pack.
    """
    packed = "lines" in items.columns
    number_of = items.agg(F.sum("lines")).first()[0] or 0 if packed else items.count()
    packs = max(1, math.ceil(number_of / PACK_ITEMS))

    def run(batches):
        held, number = [], 0
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("keys"))
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy()
            if packed:
                lines = batch.column(batch.schema.get_field_index("lines")).to_numpy()
                own = np.frombuffer(b"".join(keys.to_pylist()), np.int64)
                ids = np.repeat(ids, lines) + np.arange(lines.sum()) - np.repeat(np.cumsum(lines) - lines, lines)
                lengths = np.full(len(ids), len(own) // max(1, len(ids)))
            else:
                own = keys.flatten().to_numpy()
                lengths = pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False)
            held.append((own, np.repeat(ids, lengths)))
            number += len(held[-1][0])
            if number >= KEYS_AT_ONCE:
                yield from _packed(*map(np.concatenate, zip(*held, strict=True)), packs)
                held, number = [], 0
        if number:
            yield from _packed(*map(np.concatenate, zip(*held, strict=True)), packs)

    columns = ("id", "lines", "keys") if packed else ("id", "keys")
    sent = items.select(*columns).mapInArrow(lean(run), "pack int, kind int, keys binary, ids binary")
    return by_group(sent, ["pack"], _shared_of_pack, "key long, id long")


@dataclass
class Packed:
    """Items that are held as packs. ``keys``: a row for each pack, with the ids of its items (id, id + 1, ...;
    ``lines`` of them) and the bytes of their keys, as many for each. ``chosen(ids)`` gives the items."""

    keys: DataFrame
    chosen: Callable[[DataFrame], DataFrame]


def likely_links(
    items: DataFrame, least: int, scratch: Scratch, one_key: bool = False, packed: Packed | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b): stars of likely links in each bucket; those that take a bucket's unlike members to the others,
    which the first has only with ``one_key``; and the items that share a bucket, without their keys.
    ``items``: id, sig, keys, and any other columns.

    ``one_key``: linked sets may share one key only, so that their one bucket must find the link.
    """
    rows = scratch.saved(shared_keys(packed.keys if packed else items), "shared")
    buckets = (
        rows.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("id").alias("leader"), F.bit_xor(F.xxhash64("id")).alias("who"))
        .groupBy("n", "leader", "who")
        .agg(F.min("key").alias("key"))
        .select("key", "leader")
    )
    members = rows.join(buckets, "key").filter("id <> leader")
    # Those that share a bucket, which are few of all.
    ids = rows.select("id").distinct()
    some = packed.chosen(ids) if packed else items.drop("keys").join(ids, "id", "left_semi")
    some = scratch.saved(some, "some")
    signs = some.select("id", "sig")
    leaders = signs.select(F.col("id").alias("leader"), F.col("sig").alias("lead"))

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, member, leader, a, b = (
                batch.column(batch.schema.get_field_index(c)) for c in ("key", "id", "leader", "sig", "lead")
            )
            same = (_bytes(a) == _bytes(b)).sum(1) >= least
            yield pa.RecordBatch.from_arrays([key, member, leader, pa.array(same)], ["key", "id", "leader", "alike"])

    pairs = members.join(signs, "id").join(leaders, "leader")
    compared = scratch.saved(
        pairs.mapInArrow(lean(compare), "key long, id long, leader long, alike boolean"), "compared"
    )
    stars = compared.filter("alike").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    rest = compared.filter("not alike").select("key", "id")
    sizes = (
        rest.groupBy("key")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", F.ceil(F.col("n") / SIGNATURE_BLOCK).cast("int").alias("blocks"))
    )
    rest = rest.join(sizes, "key").withColumn("block", spread(F.col("id"), parts=F.col("blocks")))
    rest = block_pairs(rest, "block", "blocks").join(signs, "id").select("key", "low", "high", "block", "id", "sig")
    links = stars.union(by_group(rest, ["key", "low", "high"], _signatures_alike(least), "a long, b long"))
    # Each block of the unlike members meets each block of the others, of which all are linked.
    n, unlike = F.count_if("alike"), F.count_if(~F.col("alike"))
    sizes = (
        compared.groupBy("key")
        .agg(
            F.ceil(n / SIGNATURE_BLOCK).cast("int").alias("alike_blocks"),
            F.ceil(unlike / SIGNATURE_BLOCK).cast("int").alias("unlike_blocks"),
        )
        .filter("alike_blocks > 0 and unlike_blocks > 0")
    )
    own = F.when(F.col("alike"), F.col("alike_blocks")).otherwise(F.col("unlike_blocks"))
    others = F.when(F.col("alike"), F.col("unlike_blocks")).otherwise(F.col("alike_blocks"))
    both = compared.join(sizes, "key").withColumn("block", spread(F.col("id"), parts=own))
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    low = F.when(F.col("alike"), F.col("other")).otherwise(F.col("block"))
    high = F.when(F.col("alike"), F.col("block")).otherwise(F.col("other"))
    both = both.withColumns({"low": low, "high": high}).join(signs, "id")
    both = both.select("key", "low", "high", "id", "alike", "sig")
    mixed = by_group(both, ["key", "low", "high"], _unlike_with_alike(least), "a long, b long")
    return links.union(mixed) if one_key else links, mixed, some


def exact_pairs(sets: list[np.ndarray], block: np.ndarray, across: bool, percent: int):
    """Index pairs of sets (sorted, distinct elements) with intersection >= percent/100 of the union."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    # Rows and columns of the products: all sets, or those of two sides.
    sides = np.unique(block) if across else []
    if len(sides) == 2:
        rows, cols = (np.flatnonzero(block == side) for side in sides)
    else:
        rows = cols = np.arange(n)
    _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    if len(sides) == 2:
        own = (block == sides[0])[owner]
        shared = (np.bincount(inverse[own], minlength=len(inverse)) > 0) & (np.bincount(inverse[~own], minlength=len(inverse)) > 0)
    else:
        shared = np.bincount(inverse, minlength=len(inverse)) > 1
    shared = shared[inverse]
    column, owner = inverse[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    column = np.cumsum(np.append(0, np.diff(column) != 0)) if len(column) else column
    common = np.zeros((len(rows), len(cols)), np.float64)
    width = 8192
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at, to = np.searchsorted(column, (start, start + width))
        dense = np.zeros((n, min(width, int(column[-1]) + 1 - start)), np.float32)
        dense[owner[at:to], column[at:to] - start] = 1
        common += dense[rows] @ dense[cols].T if len(sides) == 2 else dense @ dense.T
    union = sizes[rows][:, None] + sizes[cols][None, :] - common
    linked = 100 * common >= percent * union
    linked &= (sizes > 0)[rows][:, None] & (sizes > 0)[cols][None, :]
    if across:
        linked &= block[rows][:, None] != block[cols][None, :]
    if len(sides) != 2:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    i, j = np.minimum(rows[i], cols[j]), np.maximum(rows[i], cols[j])
    order = np.lexsort((j, i))
    return i[order], j[order]


def spanning_links(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that join all linked sets of a block; with ``side``, of those between sets of two sides.

    The links of a few sets are followed from one to the next. If that leaves any apart that may be
    linked still, all pairs are compared.
    """
    sizes = np.array([len(s) for s in sets])
    unseen, found, reached, fruitless = sizes > 0, [], [], 0
    for _ in range(SEARCHES):
        if fruitless == FRUITLESS:
            break
        if reached:
            at = reached.pop()
        else:
            left = np.flatnonzero(unseen)
            if not len(left):
                break
            at = int(left[0])
            unseen[at] = False
        may = unseen & (100 * np.minimum(sizes, sizes[at]) >= percent * np.maximum(sizes, sizes[at]))
        others = np.flatnonzero(may if side is None else may & (side != side[at]))
        if len(others):
            own, rest = sets[at], np.concatenate([sets[k] for k in others])
            place = np.searchsorted(own, rest)
            place[place == len(own)] = 0
            ends = np.cumsum(sizes[others])
            common = np.diff(np.append(0, np.cumsum(own[place] == rest)[ends - 1]))
            linked = others[100 * common >= percent * (sizes[at] + sizes[others] - common)]
            unseen[linked] = False
            fruitless = 0 if len(linked) else fruitless + 1
            found += [(at, int(k)) for k in linked]
            reached += linked.tolist()
    if not unseen.any():
        return found
    block = np.zeros(len(sets), int) if side is None else side
    return forest(len(sets), *exact_pairs(sets, block, side is not None, percent))


def joint_links(
    sets: list[np.ndarray], bounds: np.ndarray, side: np.ndarray | None, percent: int
) -> list[tuple[int, int]]:
    """``spanning_links`` of all blocks (from each of ``bounds`` to the next) at once, for small blocks."""
    sizes = np.array([len(s) for s in sets])
    block = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    owner = np.repeat(np.arange(len(sets)), sizes)
    # A number for each element of each block.
    flat = np.concatenate(sets).astype(np.uint64, copy=False) + block[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # Places are sorted with the upper bits of the elements, which tell nearly all elements apart.
    low = np.uint64((1 << len(flat).bit_length()) - 1)
    order = np.sort(flat & ~low | np.arange(len(flat), dtype=np.uint64)) & low
    if ((flat[order][1:] ^ flat[order][:-1]) - np.uint64(1) < low).any():
        order = np.argsort(flat)
    flat = flat[order]
    new = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
    code = np.empty(len(flat), np.int64)
    code[order] = np.cumsum(new) - 1
    mark = np.zeros(int(new.sum()), bool)
    unseen, waiting = sizes > 0, np.zeros(len(sets), bool)
    found: list[list[tuple[int, int]]] = [[] for _ in bounds[1:]]
    reached: list[list[int]] = [[] for _ in bounds[1:]]
    for _ in range(SEARCHES):
        left = np.flatnonzero(unseen)
        if not len(left):
            break
        blocks, at = np.unique(block[left], return_index=True)
        source = left[at]
        for n, b in enumerate(blocks.tolist()):
            if reached[b]:
                source[n] = reached[b].pop()
        unseen[source] = waiting[source] = False
        chosen = np.zeros(len(sets), bool)
        chosen[source] = True
        mark[:] = False
        mark[code[chosen[owner]]] = True
        common = np.bincount(owner[mark[code]], minlength=len(sets))
        lead = np.full(len(found), -1)
        lead[blocks] = source
        others = np.flatnonzero(unseen)
        first = lead[block[others]]
        linked = 100 * common[others] >= percent * (sizes[first] + sizes[others] - common[others])
        linked &= first >= 0
        if side is not None:
            linked &= side[first] != side[others]
        others, first = others[linked], first[linked]
        unseen[others], waiting[others] = False, True
        for a, b, n in zip(first.tolist(), others.tolist(), block[others].tolist(), strict=True):
            found[n].append((a, b))
            reached[n].append(b)
        # The elements of blocks that are done, and of sets that were compared with all others, go.
        busy = np.zeros(len(found), bool)
        busy[block[unseen]] = True
        needed = ((unseen | waiting) & busy[block])[owner]
        code, owner = code[needed], owner[needed]
    for n in np.unique(block[unseen]).tolist():
        low, high = int(bounds[n]), int(bounds[n + 1])
        own = np.zeros(high - low, int) if side is None else side[low:high]
        pairs = forest(high - low, *exact_pairs(sets[low:high], own, side is not None, percent))
        found[n] = [(low + a, low + b) for a, b in pairs]
    return [link for own in found for link in own]


def _slices(sets: list[np.ndarray], bounds: np.ndarray):
    """Ranges of blocks, of several ones only if they have no more elements than are compared at once."""
    upto = np.append(0, np.cumsum([len(s) for s in sets]))[bounds]
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + ELEMENTS_AT_ONCE, "right")) - 1)
        yield at, to
        at = to


def _with_stars(sets: DataFrame, large: DataFrame, links: DataFrame) -> DataFrame:
    """(component, node, size) with the stars of the links in the place of the large groups."""
    stars = links.select("a", "b").filter("a <> b").distinct()
    stars = stars.union(stars.select("a", F.col("a").alias("b")).distinct())
    members = sets.join(large, "component").select(F.col("node").alias("b"), "size")
    stars = stars.join(members, "b").select(F.col("a").alias("component"), F.col("b").alias("node"), "size")
    return sets.join(large, "component", "left_anti").select("component", "node", "size").union(stars)


def near_links(
    items: DataFrame,
    content: Callable[[DataFrame], DataFrame],
    as_sets: Callable[[list[bytes]], list[np.ndarray]],
    coordinates: int,
    threshold: float,
    scratch: Scratch,
    one_key: bool = False,
    packed: Packed | None = None,
) -> DataFrame:
    """(a, b): links that join all items whose sets are linked, directly or through others.

    ``items``: id (long, distinct), size (of the set), sig (binary, a byte for each coordinate),
    keys (one for each band). ``content(ids)`` gives (id, content), one row for each wanted id; it gets the
    other columns of ``items`` with the ids, if there are any. ``as_sets`` turns contents into sets of hashes, sorted and distinct. ``one_key``: as for
    ``likely_links``. ``packed`` are the same items, to be read from packs.
    """
    least, percent = looks_alike(coordinates, threshold), round(threshold * 100)

    def blocks(number):
        return F.ceil(F.greatest(number / SET_BLOCK, F.sum("size") / ELEMENT_BLOCK)).cast("int")

    def exact(placed: DataFrame, keys: list[str], two_sides: bool) -> DataFrame:
        """(a, b, several): a forest of links for each block of (keys, id, side, several)."""

        def run(batches):
            for piece, bounds in whole_groups(batches, keys):
                sets = as_sets([x or b"" for x in piece["content"].to_pylist()])
                ids, side = piece["id"].to_numpy(), piece["side"].to_numpy()
                several = piece["several"].to_numpy(zero_copy_only=False)
                out: list[tuple[int, int, bool]] = []
                for at, to in _slices(sets, bounds):
                    first, last = int(bounds[at]), int(bounds[to])
                    own, sides = sets[first:last], side[first:last] if two_sides else None
                    if to - at > 1:
                        pairs = joint_links(own, bounds[at : to + 1] - first, sides, percent)
                    else:
                        pairs = spanning_links(own, sides, percent)
                    out += [(ids[first + a], ids[first + b], several[first + a]) for a, b in pairs]
                if out:
                    a, b, more = zip(*out, strict=True)
                    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(more, pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "several"])

        rows = placed.join(contents, "id").select(*keys, "id", "side", "several", "content")
        return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run), "a long, b long, several boolean")

    links, mixed, some = likely_links(items, least, scratch, one_key, packed)
    likely = components(links, "a", "b").join(some.drop("sig").withColumnRenamed("id", "node"), "node")
    likely = scratch.saved(likely, "likely")
    # The contents of all likely groups are read once, whatever the number of comparisons.
    ids = likely.drop("component", "size").withColumnRenamed("node", "id")
    contents = scratch.saved(content(ids), "contents")
    groups = scratch.saved(likely.groupBy("component").agg(blocks(F.count("*")).alias("blocks")), "groups")
    sets = likely.select("component", "node", "size")
    large = groups.filter(F.col("blocks") > GROUP_BLOCKS).select("component")
    by_stars = bool(large.take(1))
    if by_stars:
        sets = scratch.saved(_with_stars(sets, large, links if one_key else links.union(mixed)), "stars")
        groups = scratch.saved(sets.groupBy("component").agg(blocks(F.count("*")).alias("blocks")), "groups")
    placed = sets.join(groups, "component").select(
        "component",
        spread(F.col("node"), parts=F.col("blocks")).alias("block"),
        F.col("node").alias("id"),
        "size",
        F.lit(0).alias("side"),
        (F.col("blocks") > 1).alias("several"),
        "blocks",
    )
    # A group's first set goes to all of its blocks.
    roots = groups.filter("blocks > 1").select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("component").alias("id")
    )
    roots = roots.select("*", F.lit(0).alias("side"), F.lit(True).alias("several"))
    every = placed.select(roots.columns).filter("not several or id <> component").union(roots)
    links = exact(every, ["component", "block"], False)
    if not groups.filter("blocks > 1").take(1):
        return links.select("a", "b")
    links = scratch.saved(links, "links")
    # Stars of one block may join the sets of others.
    joined = links if by_stars else links.filter("several")
    parts = components(joined, "a", "b").withColumnRenamed("component", "part")
    members = placed.filter("several").join(parts, F.col("id") == F.col("node"), "left")
    members = scratch.saved(members.withColumn("part", F.coalesce("part", "id")).drop("node"), "members")
    counted = members.groupBy("component", "part").agg(F.count("*").alias("n"))
    largest = counted.groupBy("component").agg(F.max(F.struct("n", "part"))["part"].alias("largest"))
    largest = scratch.saved(largest, "largest")
    rest = scratch.saved(members.join(largest, "component").filter("part <> largest").drop("largest", "part"), "rest")
    apart = rest.groupBy("component").agg(blocks(F.count("*")).alias("apart"))
    apart = scratch.saved(apart, "apart")
    # Every block of the sets apart meets every block of the group.
    low, high = F.sequence(F.lit(0), F.col("apart") - 1), F.sequence(F.lit(0), F.col("blocks") - 1)
    own = rest.join(apart, "component").select(
        "component", spread(F.col("id"), parts=F.col("apart")).alias("low"), F.explode(high).alias("high"), "id", F.lit(0).alias("side")
    )
    others = members.join(apart, "component").select(
        "component", F.explode(low).alias("low"), F.col("block").alias("high"), "id", F.lit(1).alias("side")
    )
    across = exact(own.union(others).withColumn("several", F.lit(True)), ["component", "low", "high"], True)
    return links.union(across).select("a", "b")


def signatures(minimum: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A byte for each coordinate, and a key for each band."""
    return (minimum >> np.uint32(3)).astype(np.uint8), bands(minimum, rows).view(np.int64)


def sketch_columns(minimum: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array]:
    """The columns sig (a byte for each coordinate) and keys (one for each band)."""
    n = len(minimum)
    sig, keys = signatures(minimum, rows)
    width = keys.shape[1] if n else 1
    return (
        pa.array([x.tobytes() for x in sig], pa.binary()),
        pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), keys.ravel()),
    )


def near_rows(
    docs: DataFrame,
    sketches: Callable[[DataFrame], DataFrame],
    as_sets: Callable[[list[bytes]], list[np.ndarray]],
    coordinates: int,
    threshold: float,
    one_key: bool = False,
) -> DataFrame:
    """(doc_id, size of the set, component_id, kept) for each row of ``docs`` (doc_id long, text string).

    ``sketches`` turns (doc_id, at, text) into rows of ``SKETCH``, ``as_sets`` texts into their sets.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("at"), "text")
    scratch = Scratch()
    rows = saved(sketches(docs), "sketches")
    # Equal sets are one class; the text of its first document stands for it.
    some = rows.filter("size > 0 and doc_id is not null")
    classes = some.groupBy("digest").agg(
        F.min(F.struct("doc_id", "at")).alias("first"),
        F.first("size").alias("size"),
        F.first("sig").alias("sig"),
        F.first("keys").alias("keys"),
    )
    items = scratch.saved(classes.select("*", F.monotonically_increasing_id().alias("id")), "classes")

    def content(ids: DataFrame) -> DataFrame:
        wanted = ids if "first" in ids.columns else items.join(ids, "id", "left_semi")
        wanted = wanted.select("id", "first.doc_id", "first.at")
        texts = docs.join(wanted, ["doc_id", "at"]).select("id", F.col("text").cast("binary").alias("content"))
        # Rows that repeat doc_id and text give one; all but one in a task go before the shuffle.
        return texts.dropDuplicates(["id"])

    links = near_links(
        items.select("id", "first", "size", "sig", "keys"), content, as_sets, coordinates, threshold, scratch, one_key
    )
    # Sets of one doc_id belong together: each with the smallest of them.
    ids = items.select("id", "digest")
    named = some.select("doc_id", "digest")
    several = named.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = named.join(several.filter("low <> high").select("doc_id", "low"), "doc_id").filter("digest <> low")
    several = several.join(ids.withColumnRenamed("id", "b"), "digest")
    several = several.join(ids.select(F.col("digest").alias("low"), F.col("id").alias("a")), "low")
    found = components(links.union(several.select("a", "b")), "a", "b")

    members = items.join(found, items["id"] == found["node"]).select("digest", "first.doc_id", "component")
    least = members.groupBy("component").agg(F.min("doc_id").alias("least"))
    near = members.join(least, "component").select("digest", "least")
    labels = items.select("digest", F.col("first.doc_id").alias("own")).join(near, "digest", "left")
    labels = saved(labels.select("digest", F.coalesce("least", "own").alias("least")), "labels")
    scratch.clear()
    out = rows.select("doc_id", "size", "digest").join(labels, "digest", "left")
    component = F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "size", "component_id", kept.alias("kept"))
