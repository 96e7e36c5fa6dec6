"""Fuzzy line dedup: lines that share three quarters of their character shingles, once in the corpus.

Lines are compared in lower case (ASCII letters) with each run of white space as one blank. Signatures
of their shingles of eight characters find candidates in bands, full sets decide (see ``linking``),
and of all lines that are linked, directly or through others, the first one stays: that of the
smallest doc_id, and the first in its document. Of lines that differ in one inner character, those of
63 characters or more reach the threshold: shorter shingles would link shorter lines, but in text of few
syllables chance pairs then share so many that bands of three have more false candidates than lines.

Defined results: blank lines always stay; a line shorter than a shingle is one shingle; null texts
and rows without doc_id stay as they are, and their lines count for nothing; rows that repeat doc_id
and text are one document, which other texts of the same doc_id follow by a hash. Extra columns stay.
``n_chars`` is set anew where a text changes, if the table has it. No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch, by_group, lean, one_of_each, saved, texts_of
from gridledger.llm.components import components
from gridledger.llm.linking import Packed, near_links, scattered, signatures

CHARACTERS, THRESHOLD = 8, 0.75
#: 12 bands of 3: lines at the threshold share a band with probability 0.9986, at 0.85 with 0.99999.
COORDINATES, ROWS = 36, 3
#: Bytes of text for each pack of lines, lines that a task sorts at once, and lines in a row of those known
#: to be repeated.
PACK_BYTES, LINES_AT_ONCE, ROW_LINES = 4 << 20, 1 << 16, 1 << 12
#: Bytes of the lines that are sketched at once.
SLICE_BYTES = 1 << 15

_STEP = 0x9E3779B97F4A7C15
_FACTORS = np.random.default_rng(7).integers(0, 1 << 31, COORDINATES // 2).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


#: ASCII letters in lower case, and blanks for the white space that is no end of a line.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\v\f\r", b"abcdefghijklmnopqrstuvwxyz    ")


def normal_lines(text: bytes) -> list[bytes]:
    """``normal`` of each line of a text."""
    text = text.translate(_PLAIN)
    if b"  " in text or b" \n" in text or b"\n " in text or text[:1] == b" " or text[-1:] == b" ":
        return [b" ".join(line.split()) for line in text.split(b"\n")]
    return text.split(b"\n")


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all (normal, not empty) lines in a row, and how many each line has."""
    points = np.frombuffer(b"\n".join([*lines, b""]).decode().encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10)
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    h = points.astype(np.uint64)
    width = 1
    while width < CHARACTERS:  # twice as wide each time
        h = np.append(h[:-width] * np.uint64(pow(_STEP, width, 1 << 64)) + h[width:], np.zeros(width, np.uint64))
        width *= 2
    counts = np.maximum(lengths - CHARACTERS + 1, 1)
    upto = np.append(0, np.cumsum(counts))
    h = h[np.arange(upto[-1]) + np.repeat(starts - upto[:-1], counts)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    for k in np.flatnonzero(lengths < CHARACTERS).tolist():
        h[upto[k]] = xxhash.xxh3_64_intdigest(lines[k])
    return h, counts


def shingle_sets(lines: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each normal line, sorted."""
    if not lines:
        return []
    h, counts = shingles(lines)
    upto = np.append(0, np.cumsum(counts))
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        h[a:b].sort()
    new = np.append(True, h[1:] != h[:-1])
    new[upto[:-1]] = True
    ends = np.cumsum(np.add.reduceat(new, upto[:-1], dtype=np.int64)).tolist()
    h = h[new]
    return [h[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def sketch(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of (normal, not empty) lines, and the number of shingles of each.

    Hashes of 32 bits do here, as full sets decide. A shingle's hash is scattered and multiplied with odd
    numbers: the first half of the coordinates are the least products, the second half the greatest, which
    are the least ones with the negative numbers.
    """
    # Slices of whole lines that fit a core's cache.
    upto = np.append(0, np.cumsum([len(x) for x in lines]))
    at, parts = 0, []
    while at < len(lines):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + SLICE_BYTES, "right")) - 1)
        parts.append(_sketch(lines[at:to]))
        at = to
    return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])


def _sketch(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(b"\n".join([*lines, b""]).decode().encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10)
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    h, width = scattered(points), 1
    while width < CHARACTERS:  # twice as wide each time
        wider = h[:-width] * np.uint32(pow(_STEP, width, 1 << 32))
        wider += h[width:]
        h[:-width] = wider
        width *= 2
    # Shingles that would go beyond their line are left out; a line shorter than one is one.
    whole = np.ones(len(h), bool)
    for k in range(CHARACTERS):
        whole[np.maximum(ends - k, starts)] = False
    short = lengths < CHARACTERS
    whole[starts] = True
    h[starts[short]] = [xxhash.xxh3_64_intdigest(lines[k]) & 0xFFFFFFFF for k in np.flatnonzero(short)]
    counts = np.maximum(lengths - CHARACTERS + 1, 1)
    x, low = scattered(h[whole]), np.append(0, np.cumsum(counts)[:-1])
    out, y, half = np.empty((len(lines), COORDINATES), np.uint32), np.empty_like(x), len(_FACTORS)
    for k in range(half):
        np.multiply(x, _FACTORS[k], out=y)
        out[:, k] = np.minimum.reduceat(y, low)
        out[:, half + k] = np.maximum.reduceat(y, low)
    return out, counts


#: Columns of the packs: the lines of a row, one after another, as bytes of these types. ``n`` is the number
#: of times that a line was met.
_FIELDS = {"doc_id": np.int64, "at": np.int64, "line": np.int32, "n": np.int64, "size": np.int64, "digest": (np.uint64, 2), "sig": (np.uint8, COORDINATES), "keys": (np.int64, COORDINATES // ROWS)}
_OCCURRENCE = ("doc_id", "at", "line", "digest")
_PACK = "pack int, " + ", ".join(f"{c} binary" for c in _FIELDS)


def _ranked(lines: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Lines in the order of digest and place, each occurrence once, and which of them are the first of
    their digest; the first has the number of all."""
    digest = lines["digest"]
    order = np.lexsort((lines["line"], lines["at"], lines["doc_id"], digest[:, 1], digest[:, 0]))
    keys = [lines[c][order] for c in _OCCURRENCE]
    new = np.ones(len(order), bool)
    new[1:] = (keys[3][1:] != keys[3][:-1]).any(1)
    starts = np.flatnonzero(new)
    n = np.add.reduceat(lines["n"][order], starts) if len(starts) else lines["n"]
    other = new.copy()
    for key in keys[:3]:
        other[1:] |= key[1:] != key[:-1]
    chosen = order[other]
    out, first = {c: values[chosen] for c, values in lines.items()}, new[other]
    out["n"][first] = n
    return out, first


def _bytes_of(lines: dict[str, np.ndarray], names, starts: np.ndarray) -> list[pa.Array]:
    """A binary column for each name, a row for the lines from each of ``starts`` to the next."""
    ends = np.append(starts, len(lines["at"]))
    out = []
    for name in names:
        values = np.ascontiguousarray(lines[name])
        offsets = pa.py_buffer((ends * (values.itemsize * (values.size // max(1, len(values))))).astype(np.int32))
        out.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(values)]))
    return out


def _packed(held: list[dict[str, np.ndarray]], packs: int):
    """Rows of packs. Of each line of a task the first occurrence goes to the pack of its digest, and the
    others, which are known to be repeated, to any pack, without what is known of the first."""
    lines, first = _ranked({c: np.concatenate([part[c] for part in held]) for c in _FIELDS})
    heads, others = ({c: values[chosen] for c, values in lines.items()} for chosen in (first, ~first))
    to = ((heads["digest"][:, 0] >> np.uint64(32)) * np.uint64(packs) >> np.uint64(32)).astype(np.int32)
    starts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
    columns = [pa.array(to[starts]), *_bytes_of(heads, _FIELDS, starts)]
    yield pa.RecordBatch.from_arrays(columns, ["pack", *_FIELDS])
    if len(others["at"]):
        starts = np.arange(0, len(others["at"]), ROW_LINES)
        to = ((np.arange(len(starts)) + int(others["digest"][0, 1] >> np.uint64(33))) % packs).astype(np.int32)
        columns = [pa.array(to), *(x if c in _OCCURRENCE else pa.nulls(len(starts), pa.binary()) for c, x in zip(_FIELDS, _bytes_of(others, _FIELDS, starts), strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["pack", *_FIELDS])


def _read(rows: pa.Table | pa.RecordBatch, names) -> dict[str, np.ndarray]:
    """The lines of rows of packs, one after another."""
    kinds = {c: np.dtype(_FIELDS[c]) for c in names}
    return {c: np.frombuffer(b"".join(rows.column(c).to_pylist()), kinds[c].base).reshape(-1, *kinds[c].shape) for c in names}


def _merged(group: pa.Table) -> pa.RecordBatch:
    """A pack as up to two rows: the first occurrence of each of its lines, with their number and what is
    known of them, and the other occurrences, without."""
    whole = pc.is_valid(group["sig"])
    known = _read(group.filter(pc.invert(whole)), _OCCURRENCE)
    lines, first = _ranked(_read(group.filter(whole), _FIELDS))
    heads = {c: values[first] for c, values in lines.items()}
    others = {c: np.concatenate([lines[c][~first], known[c]]) for c in _OCCURRENCE}
    out = [(part, len(part["at"])) for part in (heads, others) if len(part["at"])]
    columns = [pa.array([group["pack"][0].as_py()] * len(out), pa.int32()), pa.array([n for _, n in out], pa.int64())]
    columns += [pa.array([part[c].tobytes() if c in part else None for part, _ in out], pa.binary()) for c in _FIELDS]
    return pa.RecordBatch.from_arrays(columns, ["pack", "lines", *_FIELDS])


def _fixed(values: np.ndarray) -> pa.Array:
    """Binary values of the bytes of each row."""
    values = np.ascontiguousarray(values)
    offsets = np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.itemsize * values.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _line_rows(lines: dict[str, np.ndarray], ids: np.ndarray | None = None) -> pa.RecordBatch:
    columns = {} if ids is None else {"id": pa.array(ids, pa.int64())}
    columns |= {c: pa.array(x) if x.ndim == 1 else _fixed(x) for c, x in lines.items()}
    return pa.RecordBatch.from_pydict(columns)


_HEADS = ("doc_id", "at", "line", "digest", "n", "size", "sig")
_ITEM = "id long, doc_id long, at long, line int, digest binary, n long, size long, sig binary"


def _items(packs: DataFrame) -> DataFrame:
    """(id, doc_id, at, line, digest, n, size, sig) of the lines of packs: all, or the ``wanted`` ids, if
    there is such a column. An id is the line's pack and its place there."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                lines, base = _read(row, _HEADS), row.column("pack")[0].as_py() << 32
                at = np.arange(len(lines["at"]))
                if "wanted" in row.schema.names:
                    at = np.sort(row.column("wanted").flatten().to_numpy() - base)
                for start in range(0, len(at), ROW_LINES):
                    own = at[start : start + ROW_LINES]
                    yield _line_rows({c: values[own] for c, values in lines.items()}, base + own)

    kept = ["pack", *_HEADS, *(c for c in packs.columns if c == "wanted")]
    return packs.filter("sig is not null").select(*kept).mapInArrow(lean(run), _ITEM)


def _chosen(packs: DataFrame, ids: DataFrame) -> DataFrame:
    """``_items`` of the (distinct) ids."""
    wanted = ids.groupBy(F.shiftright("id", 32).cast("int").alias("pack")).agg(F.collect_list("id").alias("wanted"))
    return _items(packs.filter("sig is not null").join(wanted, "pack"))


def _repeated(packs: DataFrame) -> DataFrame:
    """(doc_id, at, line, digest, again) of all occurrences of the lines that are there several times;
    those that are not the first of their line are there ``again``."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                lines, again = _read(row, _OCCURRENCE), not row.column("n")[0].is_valid
                at = np.arange(len(lines["at"])) if again else np.flatnonzero(_read(row, ["n"])["n"] > 1)
                for start in range(0, len(at), ROW_LINES):
                    own = {c: values[at[start : start + ROW_LINES]] for c, values in lines.items()}
                    yield _line_rows(own | {"again": np.full(len(own["at"]), again)})

    return packs.select(*_OCCURRENCE, "n").mapInArrow(lean(run), "doc_id long, at long, line int, digest binary, again boolean")


def classed_lines(docs: DataFrame) -> DataFrame:
    """Packs of the lines of (doc_id, at, text) that aren't blank: (pack, lines, and a binary column of numbers
    for each of ``_FIELDS``), a row for the first occurrences of the lines of a pack, with the number of
    all, the signature and the keys, and a row for other occurrences, without these. Rows that repeat a
    document count in ``n`` only.

    Packs are ranges of the lines' digests. A task sends one of each line that it has met to the line's
    pack, and the others to any, so that a line of very many occurrences loads no pack.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = max(1, math.ceil(total / PACK_BYTES))

    def run(batches):
        held, number = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                row, number_in, lines = [], [], []
                for k, text in enumerate(texts_of(part)):
                    for n, plain in enumerate(normal_lines(text)):
                        if plain:
                            row.append(k)
                            number_in.append(n)
                            lines.append(plain)
                if not lines:
                    continue
                found, counts = sketch(lines)
                sig, keys = signatures(found, ROWS)
                ids = {c: part.column(part.schema.get_field_index(c)).to_numpy()[row] for c in ("doc_id", "at")}
                digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), np.uint64).reshape(-1, 2)
                held.append(
                    ids
                    | {"line": np.array(number_in, np.int32), "n": np.ones(len(lines), np.int64), "size": counts}
                    | {"digest": digest, "sig": sig, "keys": keys}
                )
                number += len(lines)
                if number >= LINES_AT_ONCE:
                    yield from _packed(held, packs)
                    held, number = [], 0
        if number:
            yield from _packed(held, packs)

    return by_group(docs.mapInArrow(lean(run), _PACK), ["pack"], _merged, _PACK.replace(",", ", lines long,", 1))


def _picked(texts: DataFrame) -> DataFrame:
    """(id, content): the wanted lines of (doc_id, at, text, wanted: array of line and id), in normal
    form. Rows that repeat doc_id and text give each line once."""

    def run(batches):
        seen = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                doc_id, at, wanted = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "at", "wanted"))
                ids, out = [], []
                for key, text, lines in zip(zip(doc_id, at, strict=True), texts_of(part), wanted, strict=True):
                    if key in seen:
                        continue
                    seen.add(key)
                    parts = normal_lines(text)
                    for x in lines:
                        ids.append(x["id"])
                        out.append(parts[x["line"]])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "content"])

    picked = texts.select("doc_id", "at", "text", "wanted").mapInArrow(lean(run), "id long, content binary")
    # Other tasks may have met the same document.
    return picked.dropDuplicates(["id"])


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, at, dropped) for the documents that lose lines: the number of each such line, and which
    line (kept_doc_id, kept_line) is the one that is kept of those linked with it."""
    own = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("at"), "text"
    )
    scratch = Scratch()
    # Equal lines are one class, which its first occurrence stands for.
    packs = scratch.saved(classed_lines(own), "packs")
    first = F.struct("doc_id", "at", "line").alias("first")
    kept = ("id", first, "digest", "size", "sig")
    items = _items(packs).select(*kept)
    likely: list[DataFrame] = []

    def content(ids: DataFrame) -> DataFrame:
        found = ids if "first" in ids.columns else items.join(ids, "id", "left_semi")
        likely[:] = [scratch.saved(found.select("id", "first", "digest"), "likely")]
        wanted = likely[0].groupBy("first.doc_id", "first.at")
        wanted = wanted.agg(F.collect_list(F.struct("first.line", "id")).alias("wanted"))
        return _picked(own.join(wanted.hint("shuffle_hash"), ["doc_id", "at"]))

    links = near_links(
        items,
        content,
        shingle_sets,
        COORDINATES,
        THRESHOLD,
        scratch,
        False,
        Packed(
            packs.filter("sig is not null").select((F.col("pack").cast("long") * (1 << 32)).alias("id"), "lines", "keys"),
            lambda ids: _chosen(packs, ids).select(*kept),
        ),
    )
    found = components(links, "a", "b")
    # A line that is there once and is linked with no other one loses nothing.
    linked = found.join(likely[0], F.col("node") == F.col("id")).select("digest", "first", "component")
    linked = scratch.saved(linked, "linked")
    roots = linked.groupBy("component").agg(F.min("first").alias("kept"))
    linked = scratch.saved(linked.join(roots, "component").select("digest", "first", "kept"), "kept")
    # The first occurrence of a class, and the others, follow the one that is kept.
    place = ("doc_id", "at", "line")
    firsts = linked.select(*(F.col(f"first.{c}").alias(c) for c in place), "kept")
    repeated = _repeated(packs)
    firsts_of = repeated.filter("not again").select("digest", first).join(linked.select("digest", "kept"), "digest", "left")
    firsts_of = firsts_of.select("digest", F.coalesce("kept", "first").alias("kept"))
    again = repeated.filter("again").select(*place, "digest").join(firsts_of, "digest").select(*place, "kept")
    itself = (F.col("doc_id") == F.col("kept.doc_id")) & (F.col("at") == F.col("kept.at")) & (F.col("line") == F.col("kept.line"))
    gone = firsts.union(again).filter(~itself)
    line = F.struct("line", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line").alias("kept_line"))
    dropped = saved(gone.groupBy("doc_id", "at").agg(F.sort_array(F.collect_set(line)).alias("dropped")), "dropped")
    scratch.clear()
    return dropped


def _rebuilt(texts: pa.Array, lines: pa.Array) -> pa.Array:
    """Each text without its dropped lines; null if it loses none."""
    out = []
    for start in range(0, len(texts), 256):
        left = []
        for text, gone in zip(texts.slice(start, 256).to_pylist(), lines.slice(start, 256).to_pylist(), strict=True):
            if gone:
                gone = set(gone)
                text = "\n".join(p for n, p in enumerate(text.split("\n")) if n not in gone)
            left.append(text if gone else None)
        out.append(pa.array(left, pa.string()))
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def _cleaned(docs: DataFrame) -> DataFrame:
    """(row: all columns, done: text, n_lines, n_kept, dropped): ``done`` is null for rows that stay as
    they are."""
    rows = docs.select(F.struct("*").alias("row"))
    key = F.when(F.col("row.text").isNotNull(), F.col("row.doc_id").cast("long"))
    rows = rows.select("row", key.alias("doc_id"), F.xxhash64("row.text").alias("at"))
    rows = rows.join(dropped_lines(docs).hint("shuffle_hash"), ["doc_id", "at"], "left")
    # Only texts that lose lines go to Python.
    rebuilt = F.arrow_udf(_rebuilt, "string")
    rows = rows.withColumn("left", rebuilt(F.when(F.col("dropped").isNotNull(), F.col("row.text")), "dropped.line"))
    lost = F.coalesce(F.size("dropped"), F.lit(0))
    done = F.struct(
        F.coalesce("left", "row.text").alias("text"), _n_lines("row.text").alias("n_lines"), (_n_lines("row.text") - lost).alias("n_kept")
    )
    return rows.select("row", F.when(F.col("doc_id").isNotNull(), done).alias("done"), "dropped")


def _n_lines(text: str) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1).cast("long")


def deduplicated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_kept, text, dropped) for each row of ``docs``: its lines, those that stay, the
    text of these, and for each of the others (line) the one that is kept of its class."""
    rows = _cleaned(docs)
    lines = F.coalesce(_n_lines("row.text"), F.lit(0).cast("long"))
    return rows.select(
        "row.doc_id",
        F.coalesce("done.n_lines", lines).alias("n_lines"),
        F.coalesce("done.n_kept", lines).alias("n_kept"),
        F.coalesce("done.text", "row.text").alias("text"),
        "dropped",
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left, in one row for each doc_id and text. Documents all of whose
    lines occurred before are gone."""
    docs = one_of_each(docs)
    rows = _cleaned(docs)
    blank = r"^[\x20\x09-\x0D]*$"
    emptied = F.col("done").isNotNull() & F.col("done.text").rlike(blank) & ~F.col("row.text").rlike(blank)
    rows = rows.filter(~emptied)
    text = F.coalesce("done.text", "row.text")
    fresh = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.col("done").isNotNull() & (F.col("done.n_kept") < F.col("done.n_lines"))
        fresh["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*(fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
