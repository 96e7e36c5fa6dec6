"""Numpy steps that run inside tasks, each on one bounded piece of Arrow data.

The functions travel with the job, so executors need no copy of this package.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Scores that agree to this many digits are ties.
SCORE_DIGITS = 12
# Scores held in memory at once, of which a search makes several copies in each of an executor's workers.
_CELLS = 1 << 20
# Up to this many best ones are picked one by one, which is quicker than sorting.
_FEW = 32


def unit_rows(vectors) -> np.ndarray:
    """One row per vector of one length, scaled to length 1; a zero vector stays zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    rows = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)
    norms = np.sqrt(np.einsum("nd,nd->n", rows, rows))
    return rows / np.where(norms == 0.0, 1.0, norms)[:, None]


def widths(vectors) -> np.ndarray:
    """The length of each vector that can be compared; 0 if it is null, empty, or holds a null, NaN or infinity."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    found = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten()  # those of null vectors left out
    bad = ~np.isfinite(values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    if bad.any():
        owner = np.repeat(np.arange(len(found)), found)
        found[np.unique(owner[bad])] = 0
    return found


def best_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row, the columns of the k highest scores, best first; ties by column."""
    k = min(k, scores.shape[1])
    if k > _FEW:
        return np.argsort(-scores, axis=1, kind="stable")[:, :k]
    best = np.empty((len(scores), k), dtype=np.int64)
    rows, rest = np.arange(len(scores)), scores.copy()
    for place in range(k):
        best[:, place] = rest.argmax(axis=1)  # the first of equal ones
        rest[rows, best[:, place]] = -np.inf
    return best


def search_side(candidates: pa.Table) -> dict:
    """Candidates made ready for a search: by length of vector, ids in order, labels, unit vectors."""
    candidates = candidates.sort_by("id")
    found = widths(candidates["vector"])
    out = {}
    for width in np.unique(found[found > 0]).tolist():
        part = candidates.take(pa.array(np.flatnonzero(found == width)))
        out[width] = (part["id"].combine_chunks(), part["label"].combine_chunks(), unit_rows(part["vector"]))
    return out


def least_of(matches: pa.Table, k: int, count: int) -> np.ndarray:
    """For rows 0 to ``count`` - 1, the score that a further match must reach to be among the k best."""
    least = np.full(count, -np.inf)
    rows = matches["row"].to_numpy()
    if len(rows):
        full = np.flatnonzero(np.bincount(rows, minlength=count) >= k)
        lowest = np.full(count, np.inf)
        np.minimum.at(lowest, rows, matches["score"].to_numpy())
        least[full] = lowest[full]
    return least


def best_matches(vectors, side: dict, k: int, schema: pa.Schema, least=None) -> pa.Table:
    """Rows (row, score, id, label): the k best candidates of each vector, by its place.

    With ``least``, vectors none of whose scores reaches theirs are left out.
    """
    found = widths(vectors)
    parts = []
    for width in np.unique(found).tolist():
        if width not in side:
            continue
        ids, labels, candidates = side[width]
        rows = np.flatnonzero(found == width)
        units = unit_rows(vectors.take(pa.array(rows)))
        step = max(1, _CELLS // len(ids))
        for start in range(0, len(units), step):
            block, own = np.round(units[start : start + step] @ candidates.T, SCORE_DIGITS), rows[start : start + step]
            if least is not None:
                reach = block.max(axis=1) >= least[own]
                block, own = block[reach], own[reach]
            best = best_columns(block, k)
            at = pa.array(best.ravel())
            parts.append(
                pa.Table.from_arrays(
                    [
                        pa.array(np.repeat(own, best.shape[1])),
                        pa.array(np.take_along_axis(block, best, axis=1).ravel()),
                        ids.take(at),
                        labels.take(at),
                    ],
                    schema=schema,
                )
            )
    return pa.concat_tables(parts) if parts else schema.empty_table()


def best_of(matches: pa.Table, k: int) -> pa.Table:
    """The k best of each row, best first; of equal scores the smaller id."""
    matches = matches.sort_by([("row", "ascending"), ("score", "descending"), ("id", "ascending")])
    rows = matches["row"].to_numpy()
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    return matches.filter(pa.array(place < k))


def match_lists(matches: pa.Table, count: int) -> pa.ListArray:
    """The matches of rows 0 to ``count`` - 1, in order, as lists of (id, label, score)."""
    offsets = np.searchsorted(matches["row"].to_numpy(), np.arange(count + 1)).astype(np.int32)
    names = ["id", "label", "score"]
    found = pa.StructArray.from_arrays([matches[n].combine_chunks() for n in names], names=names)
    return pa.ListArray.from_arrays(pa.array(offsets), found)


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def split_by_key(table: pa.Table, keys: list[str]):
    """(key, rows of the key) for each key in the table."""
    if not keys:
        yield (), table
        return
    frame = table.select(keys).to_pandas()
    numbers = frame.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    for number in np.unique(numbers):
        rows = np.flatnonzero(numbers == number)
        yield tuple(frame.iloc[rows[0]]), table.take(pa.array(rows))


def products(items: pa.Table, classes: pa.Table):
    """(rows, columns, scores) for each length of vector that items and classes have."""
    mine, other = widths(items["vector"]), widths(classes["vector"])
    for width in np.intersect1d(mine[mine > 0], other):
        rows, columns = np.flatnonzero(mine == width), np.flatnonzero(other == width)
        units = unit_rows(items["vector"].take(pa.array(rows)))
        yield rows, columns, np.round(units @ unit_rows(classes["vector"].take(pa.array(columns))).T, SCORE_DIGITS)


def score_counts(items: pa.Table, classes: pa.Table, names: list[str], scored=None) -> pa.Table:
    """For each class and score: how many of the items have it, and how many of these are of the class.

    ``scored``: the products of both, if they are known.
    """
    labels, own = items["label"].to_pandas().to_numpy(), classes["label"].to_pandas().to_numpy()
    owner, scores, counts, positives = [], [], [], []
    for rows, columns, found in products(items, classes) if scored is None else scored:
        for n, c in enumerate(columns):
            values, place = np.unique(found[:, n], return_inverse=True)
            owner.append(np.full(len(values), c))
            scores.append(values)
            counts.append(np.bincount(place, minlength=len(values)))
            positives.append(np.bincount(place[labels[rows] == own[c]], minlength=len(values)))
    if not owner:
        return classes.select(names[:-3]).slice(0, 0).append_column("score", pa.array([], pa.float64())).append_column(
            "items", pa.array([], pa.int64())
        ).append_column("positives", pa.array([], pa.int64()))
    found = classes.select(names[:-3]).take(pa.array(np.concatenate(owner)))
    for name, parts in zip(names[-3:], (scores, counts, positives)):
        found = found.append_column(name, pa.array(np.concatenate(parts)))
    return found


def hit_counts(items: pa.Table, classes: pa.Table | None, k: int, keys: list[str], scored) -> pa.Table:
    """(keys, label, items, first, among): items by label, and how many find a class of their label as
    the best match and among the k best. ``scored``: products of items and classes in order of label."""
    labels = items["label"].combine_chunks()
    hits = np.zeros((2, len(items)), bool)
    if classes is not None:
        own = classes["label"].combine_chunks()
        known = own.is_valid().to_numpy(zero_copy_only=False)
        numbers = pa.concat_arrays([own.cast(labels.type), labels]).dictionary_encode().indices.fill_null(-1).to_numpy()
        of_class, of_item = numbers[: len(own)], numbers[len(own) :]
        for rows, columns, found in scored:
            usable = known[columns]
            if usable.any():
                best = columns[usable][best_columns(found[:, usable], k)]
                same = of_class[best] == of_item[rows][:, None]
                hits[0, rows], hits[1, rows] = same[:, 0], same.any(axis=1)
    table = items.select([*keys, "label"])
    for name, values in (("first", hits[0]), ("among", hits[1])):
        table = table.append_column(name, pa.array(values.astype(np.int64)))
    counted = table.group_by([*keys, "label"]).aggregate([([], "count_all"), ("first", "sum"), ("among", "sum")])
    counted = counted.select([*keys, "label", "count_all", "first_sum", "among_sum"])
    return counted.rename_columns([*keys, "label", "items", "first", "among"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
