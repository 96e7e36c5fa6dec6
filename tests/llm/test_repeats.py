"""Repeated passages against counts of all strings of 200 bytes, and the sorting of suffixes by itself."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from brute import FOLDER, ROWS
from gridledger.llm import repeats
from gridledger.llm.queries import QUERIES

WINDOW = repeats.WINDOW


def expected(table):
    texts = [(r[0], (r[1] or "").encode()) for r in table]
    count = Counter(t[i : i + WINDOW] for _, t in texts for i in range(len(t) - WINDOW + 1))
    out = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - WINDOW + 1):
            if count[text[i : i + WINDOW]] > 1:
                gone[i : i + WINDOW] = b"\1" * WINDOW
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd():
    choose = random.Random(3)
    words = ["".join(choose.choice("abcdeé") for _ in range(choose.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(choose.choice(words) for _ in range(n))

    shared = [prose(80) for _ in range(5)]
    out = [(1, None), (2, ""), (3, "a" * 900), (4, "ab" * 300), (5, "x" * 199), (6, "x" * 200), (7, "y" * 201)]
    for k in range(60):
        tail = choose.choice(shared)[: choose.randint(0, 400)]
        out.append((100 + k, prose(choose.randint(0, 60)) + choose.choice(shared) + prose(choose.randint(0, 60)) + tail))
    out += [(500, out[20][1]), (500, out[20][1]), (501, shared[0][:150]), (None, prose(90))]
    return out + [(None, shared[1] + "\0" * 500 + shared[2]), (8, prose(30_000) + shared[3] + prose(9))]


def test_difference_cover():
    for period in (7, 13, 32, 57):
        cover = repeats.difference_cover(period)
        assert {(a - b) % period for a in cover.tolist() for b in cover.tolist()} == set(range(period))
        shifts = repeats._shifts(period)
        inside = set(cover.tolist())
        assert all((x + shifts[x, y]) % period in inside and (y + shifts[x, y]) % period in inside for x in range(period) for y in range(period))


@pytest.mark.parametrize("text", [b"ab" * 700, bytes(900), b"the same words again, " * 60, None])
def test_suffixes_in_order(text):
    if text is None:
        choose = random.Random(2)
        parts = [bytes(choose.choices(b"xyz", k=260)) for _ in range(4)]
        text = b"".join(choose.choice(parts)[: choose.randint(180, 260)] for _ in range(40))
    block, at = repeats.Block(text), np.arange(len(text) - WINDOW + 1)
    order, _ = block.in_order(at, np.zeros(len(at), np.int64))
    heads = [text[i : i + WINDOW] for i in at[order].tolist()]
    assert heads == sorted(heads)
    count = Counter(heads)
    found = block.repeated(at, np.zeros(len(at), np.int64))
    assert found.tolist() == [count[text[i : i + WINDOW]] > 1 for i in range(len(at))]


def test_runs_do_not_depend_on_chunks(monkeypatch):
    choose = random.Random(4)
    texts = [bytes(choose.choices(b"abcd ", k=n)) for n in (0, 150, 200, 5000, 40_000, 230)]
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    whole = repeats.runs(data, lengths)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    cut = repeats.runs(data, lengths)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert (whole[1] + 1).sum() == sum(max(0, len(t) - WINDOW + 1) for t in texts)


@pytest.mark.parametrize("slices", [repeats.BUCKET_SLICES, 3])
def test_passages(spark, monkeypatch, odd, slices):
    monkeypatch.setattr(repeats, "BUCKET_SLICES", slices)
    table = spark.createDataFrame(odd, "doc_id long, text string").repartition(5)
    clashing = table.selectExpr("*", "1 AS digest", "2 AS h", "3 AS s", "4 AS a", "5 AS starts", "6 AS copied", "7 AS n")
    assert rows(repeats.removed_passages(clashing)) == expected(odd)


def test_marks_of_blocks(odd):
    # One block of all buckets, and a block for each, mark the same strings.
    texts = [t.encode() for _, t in odd if t and len(t.encode()) >= WINDOW]
    slices = {}
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        for a, span, off, h, s in zip(*(x.tolist() for x in repeats.runs(data, np.array([len(data)]))), strict=True):
            slices[h - (1 << 63), s - (1 << 63)] = (h - (1 << 63), s - (1 << 63), span, off, text[a : a + span + WINDOW])
    every = sorted(slices.values())
    whole = repeats._marks(every).to_pylist()
    buckets = [[x for x in every if x[0] == h] for h in dict.fromkeys(x[0] for x in every)]
    assert whole == [m for bucket in buckets for m in repeats._marks(bucket).to_pylist()] and whole


def test_documents(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    assert rows(QUERIES["op13_repeated_passages"](spark, FOLDER)) == expected(table.collect())


def test_no_rows(spark):
    assert rows(repeats.removed_passages(spark.createDataFrame([], ROWS))) == []


def test_what_is_kept(spark):
    passage = "".join(chr(97 + k * k % 23) for k in range(250))
    table = spark.createDataFrame([("x", "ü" + passage), ("y", passage + "end")], "doc_id string, text string")
    found = {r.doc_id: r for r in repeats.without_repeats(table).collect()}
    assert [tuple(x) for x in found["x"].removed] == [(2, 252)] and found["x"].kept == "ü".encode()
    assert [tuple(x) for x in found["y"].removed] == [(0, 250)] and found["y"].kept == b"end"
