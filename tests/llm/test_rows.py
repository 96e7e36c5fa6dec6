"""Sharding, mixing, fingerprints, formatting and packing: exact results on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import FOLDER, ROWS, spot_signatures, taken
from gridledger.llm import chat, mixing, packing, sharding, spotsigs
from gridledger.llm.queries import ORACLE_SQL, QUERIES

EDGES = [
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, "  \n", "en", "b", 3),
    (6, "one two  three\x0bfour five", "en", "b", 9),
    (6, "one two  three\x0bfour five", "en", "b", 9),
    (None, "no id here", None, "a", 1),
    (7, "word " * 9000, "en", "é", 5),
    (8, "x " * 10 + "y", "en", "Z", 5),
    (9, "seven words that are not very many", "en", None, 5),
]


def edges(spark):
    return spark.createDataFrame(EDGES, ROWS).selectExpr("*", "1 AS size", "2 AS digits", "'t' AS target", "0 AS tie", "'p' AS part")


# --- sharding ---


def test_jump_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    before = sharding.jump(keys, 1)
    assert (before == 0).all()
    for shards in range(2, 12):
        after = sharding.jump(keys, shards)
        moved = after != before
        assert (after[moved] == shards - 1).all() and abs(moved.mean() - 1 / shards) < 0.02
        before = after


def test_jump_one_key_at_a_time():
    def plain(key, shards):
        at, after = -1, 0
        while after < shards:
            at = after
            key = (key * 2862933555777941757 + 1) % 2**64
            after = int((at + 1) * (2**31 / ((key >> 33) + 1)))
        return at

    keys = [0, 1, -1, 17, 2**62, -(2**63)]
    assert sharding.jump(np.array(keys), 9).tolist() == [plain(k % 2**64, 9) for k in keys]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 40)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    table = edges(spark).select(*docs.columns).union(docs.selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars"))
    found = sharding.shard_documents(table.selectExpr("*", "1 AS shard", "2 AS slot", "3 AS n")).collect()
    data = [(r.doc_id, (r.text or "").encode()) for r in table.collect()]
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in found) == sorted((d or -1, len(t) + 1, zlib.crc32(t)) for d, t in data)
    for shard in range(8):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8) for r in found)
    assert len({(r.doc_id, r.shard) for r in found}) == len({r.doc_id for r in found})
    assert rows(sharding.shard_documents(spark.createDataFrame([], ROWS))) == []


def test_slots_of_very_many_alike_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 16)
    table = spark.createDataFrame([(None, None, None, None, None)] * 500 + [(k, "t", None, None, None) for k in range(90)], ROWS)
    found = sharding.shard_documents(table)
    for shard in range(8):
        slots = sorted(r.slot for r in found.collect() if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert found.count() == 590
    pieces = found.filter("doc_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(pieces) > 1 and max(r["count"] for r in pieces) < 500


# --- mixing ---


def numbered_digits(sized):
    """The digits of each row: those of equal rows are hashed with their number."""
    seen, out = Counter(), []
    for r in sized:
        k = seen[r.digits]
        seen[r.digits] += 1
        out.append(hashlib.md5(f"{r.digits}|{k}".encode()).hexdigest()[:12] if k else r.digits)
    return out


def test_mix(spark):
    found = rows(mixing.mix(edges(spark)))
    sized = mixing.sized(edges(spark)).collect()
    target, copies = taken([(n, r.source, r.size, d) for n, (r, d) in enumerate(zip(sized, numbered_digits(sized), strict=True))])
    sizes = {s: sum(r.size for r in sized if r.source == s) for s in target}
    expected = [(r.doc_id, r.size, sizes[r.source], target[r.source], r.size * copies[n]) for n, r in enumerate(sized)]
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in sorted(expected, key=repr)]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in sorted(expected, key=repr)])
    words = {n: len(re.findall("[^\x20\x09-\x0d]+", d[1] or "")) for n, d in enumerate(EDGES)}
    assert sorted(r.size for r in sized) == sorted(words.values())
    assert rows(mixing.mix(spark.createDataFrame([], ROWS))) == []


def test_mix_by_sql_and_as_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = mixing.mix(docs)
    assert not re.search("Python|Arrow|Pandas", plan(found))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL['op5_source_mixing']})").fetchall()
    assert rows(found.select(columns)) == sorted(expected, key=repr)
    by_source = {}
    for r in found.collect():
        by_source.setdefault(r.source_size, []).append(r)
    for own in by_source.values():  # nearer than by half of any row
        assert 2 * abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    many = mixing.mixed(docs.selectExpr("*", "7 AS copies"))
    copies = {r.doc_id: r.taken // r.size for r in found.collect() if r.size}
    assert sorted(r.doc_id for r in many.collect()) == sorted(d for d, n in copies.items() for _ in range(n))
    assert many.columns == [*docs.columns, "copies"]


@pytest.mark.parametrize("few", [True, False])
def test_mix_of_rows_that_are_there_often(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(mixing, "row_bound", lambda df: False)
    data = [(1, "one two three", "en", "a", 3)] * 1000 + [(k, "w " * (k % 50), "en", "b", 3) for k in range(2000)] + [(9, "x y", "en", None, 3)] * 40
    table = spark.createDataFrame(data, ROWS).repartition(6)
    found = mixing.mix(table).collect()
    assert len(found) == len(data)
    by_source = {}
    for r in found:
        by_source.setdefault(r.source_size, []).append(r)
    for own in by_source.values():
        assert 2 * abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken <= 2 * r.size for r in own)
    assert rows(mixing.mix(table.repartition(3, "source"))) == sorted((tuple(r) for r in found), key=repr)
    duck = duckdb.connect()
    duck.register("documents", table.toArrow())
    answer = duck.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLE_SQL['op5_source_mixing']})").fetchall()
    assert sorted(answer, key=repr) == sorted((tuple(r) for r in found), key=repr)
    many = mixing.mixed(table).groupBy("doc_id", "source", "text").count().collect()
    assert sum(r["count"] for r in many if r.text and r.text.strip()) == sum(r.taken // r.size for r in found if r.size)


def test_sources_beyond_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = rows(mixing.mix(docs))
    monkeypatch.setattr(mixing, "row_bound", lambda df: False)
    assert rows(mixing.mix(docs)) == expected


# --- fingerprints ---


def test_signatures_word_by_word(spark):
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts += ["", " ", "?!", "one", "the", "the cat", "the cat sat", "A the b", "É é the Ünder x", "w " * 40, "the a of " * 9]
    for text in texts:
        assert spotsigs.signatures(text).tolist() == spot_signatures(text, spotsigs.ANCHORS, spotsigs.REACH)


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars")
    table = edges(spark).filter("doc_id <> 6 OR doc_id IS NULL").select(*docs.columns).union(docs)
    data = sorted(((r.doc_id, r.text or "") for r in table.collect()), key=lambda r: -(r[0] or 0))
    for size in (20_000, 1 << 30):  # in many ranges, in one
        found = {r.doc_id: r for r in spotsigs.fingerprints(table.selectExpr("*", "1 AS also", "2 AS key"), size).collect()}
        assert len(found) == len(data)
        for n, (doc_id, text) in enumerate(data):
            after, r = data[(n + 1) % len(data)][1], found[doc_id]
            third = len(text) // 3
            edited = text[: len(text) - third] + after[:third]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            own, new, other = (set(spotsigs.signatures(t).tolist()) for t in (text, edited, after))
            assert r.near_edited == pytest.approx(len(own & new) / len(own | new) if own | new else 1)
            assert r.near_next == pytest.approx(len(own & other) / len(own | other) if own | other else 1)
            assert r.fingerprint == spotsigs.fingerprint(spotsigs.signatures(text))
    one = spotsigs.fingerprints(spark.createDataFrame([(1, "abcdef ghi")], "doc_id long, text string")).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest() and one.near_next == 1
    assert rows(spotsigs.fingerprints(spark.createDataFrame([], ROWS))) == []


def test_a_frequent_id_is_split_over_ranges(spark):
    data = [(5, f"text number {n} of them " * 20) for n in range(200)] + [(5, "same")] * 5 + [(4, "last one"), (9, "first one")]
    table = spark.createDataFrame(data, "doc_id long, text string")
    assert spotsigs.with_next(table, 4000).select("part").distinct().count() > 5
    found = spotsigs.fingerprints(table, 4000)
    assert rows(found) == rows(spotsigs.fingerprints(table, 1 << 30)) and found.count() == len(data)


def test_signatures_of_spots():
    spots = spotsigs.signatures("the cat of a sleeping dog")
    assert len(spots) == 3  # the, of and a, each with its next two content words
    assert spotsigs.likeness(spots, spots) == 1 and spotsigs.likeness(spots, spots[:1], 0.5) == 0
    assert len(spotsigs.signatures("")) == 0 and len(spotsigs.signatures("?!")) == 1
    assert len(spotsigs.signatures("one")) == 1


# --- chat ---

TURNS = "conv_id long, turn long, role string, text string"


def test_turns_read_back(spark):
    rng = random.Random(4)
    bits = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "OUT]", " ", "\n", "/TURN]", "[/ROLE] ", "é", "</s>\n", " [/SYS]"]
    data = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "[/ROLE] x\n", "".join(rng.choices(bits, k=3))])
            data.append((conv, turn, role, rng.choice([None, "", "".join(rng.choices(bits, k=rng.randrange(12)))])))
    data += [(60, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    data += [(61, None, "user", "b"), (61, 0, "user", "a"), (61, 0, "user", "a"), (None, 1, "user", "x")]
    table = chat.with_example(spark.createDataFrame(data, TURNS).selectExpr("*", "1 AS seq", "'r' AS piece"))
    found = {r.conv_id: r for r in chat.digests(table).collect()}
    by_conv = {}
    for r in table.collect():
        by_conv.setdefault(r.conv_id, []).append(r)
    assert set(found) == set(by_conv) and -7 in found
    pieces = chat.formatted(table).collect()
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: tuple((x is not None, x or "") if not isinstance(x, int) else (True, x) for x in (r.turn, r.role, r.text)))
        whole = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in turns)
        learnt = "".join(r.text or "" for r in turns if r.role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        output = "".join(p.piece for p in sorted((p for p in pieces if p.conv_id == conv), key=lambda p: p.seq))
        assert len(output) == r.formatted_chars
        assert output.count("</s>") == sum(r.role == "assistant" for r in turns)
    assert rows(chat.digests(spark.createDataFrame([], TURNS))) == []


def test_escapes_are_undone_and_hide_all_controls():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choices(["<", "[", "\\", *chat.CONTROLS, "a"], k=9))
        held = chat.escape(text)
        assert chat.unescape(held) == text
        assert not any(a + b in held for a in "<[" for b in chat.CONTROLS)


def render(template, turns=()):
    return "".join(p for p, _ in chat.compiled(template)(turns))


def test_templates():
    assert render("a{# no #}{{ 'b' + 'c' | upper }}{{ 3 }}") == "abC3"
    assert render("{% for t in turns %}{{ loop.index }}{{ t.role }}{% if not loop.last %},{% endif %}{% endfor %}", [{"role": "x"}, {"role": "y"}]) == "1x,2y"
    assert render("{% set a = 'q' %}{% if a == 'q' and true %}yes{% elif a %}no{% else %}never{% endif %}") == "yes"
    assert list(chat.compiled("{% generation %}x{% endgeneration %}y")(())) == [("x", True), ("y", False)]
    folded = chat.fold(chat.parse("a{% if 1 == 2 %}b{% else %}c{% endif %}{{ 'd' }}"))
    assert folded == [chat.Text("acd")]


@pytest.mark.parametrize("bad", ["{{ open('x') }}", "{{ a | eval }}", "{% if x %}", "{% import os %}", "{{ 1 2 }}", "{{ x.y( }}", "{{ x[0] }}", "{{ £ }}"])
def test_what_the_language_lacks(bad):
    with pytest.raises(chat.TemplateError):
        chat.compiled(bad)


def test_no_way_to_objects():
    with pytest.raises((KeyError, TypeError)):
        render("{{ turns.__class__ }}", [])


def test_a_conversation_of_the_added_number(spark):
    own = spark.createDataFrame([(-7, 0, "system", "Hi."), (-7, 5, "user", "So?"), (1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.digests(chat.with_example(own)).collect()}
    text = "</s>[INST] ok [/INST]"
    turns = [("system", "Hi."), ("user", text), ("assistant", text), ("user", "So?")]
    assert set(found) == {-7, 1} and found[-7].n_turns == 4
    assert found[-7].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert found[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


# --- packing ---


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_words_have_the_tokenizers_ids(whole, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 50)
    texts = ["", "Don't STOP'll 12ab №5 ½x", "a<|endoftext|>b <|startoftext|>", "É́ İstanbul ΑΣ ﬁ", "x\u0085y z q\x1cw", "日本語 текст!?..##", "é ｆｕｌｌ ­ soft", "ABC,. " * 50, "ªº²µß ÀÖØÿ"]
    texts += [" ".join(f"word{i}x{j}." for i in range(30)) for j in range(5)]
    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    expected = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        assert [x.tolist() for x in tokens.ids([t.encode() for t in texts])] == expected


def test_cuts_are_cheapest():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(2, 9)
        ends = np.cumsum([0, *(rng.randrange(1, 9) for _ in range(n))])
        costs = np.array([0, *(rng.randrange(6) for _ in range(n))], float)

        def cost(at):
            edges = [0, *at]
            return sum(12 - (b - a) + costs[list(ends).index(b)] for a, b in zip(edges, edges[1:]))

        best = min(
            cost([e for k, e in enumerate(ends[1:-1]) if mask >> k & 1] + [ends[-1]])
            for mask in range(1 << (n - 1))
            if all(b - a <= 12 for a, b in zip(*(lambda p: (p, p[1:]))([0, *[e for k, e in enumerate(ends[1:-1]) if mask >> k & 1], ends[-1]])))
        )
        assert cost(packing.cuts(ends, costs, 12)) == best


def test_tails():
    for size in range(1, 2049):
        parts = packing.tail(size, 2048)
        assert sum(parts) == size and (parts == [size] or all(p & (p - 1) == 0 for p in parts))
    assert packing.tail(1536, 2048) == [1024, 512] and packing.tail(2047, 2048) == [2047]


def test_pieces(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "WINDOWS", 20)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars")
    table = edges(spark).select(*docs.columns).union(docs).coalesce(2)
    found = packing.packed(table.selectExpr("*", "1 AS start")).collect()
    ids = {}
    for r in table.collect():
        ids.setdefault(r.doc_id, []).append(np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces = {}
    for p in found:
        pieces.setdefault(p.doc_id, []).append(p)
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        tokens, copies = ids[doc_id][0], len(ids[doc_id])
        assert sum(p.length for p in own) == copies * len(tokens)
        assert all(p.doc_tokens == len(tokens) for p in own)
        assert all(p.ids_crc32 == zlib.crc32(tokens[p.start : p.start + p.length].tobytes()) for p in own)
        at = sorted((p.start, p.start + p.length) for p in own)[::copies]
        assert [a for a, _ in at] == [0, *(b for _, b in at[:-1])] and at[-1][1] == len(tokens)
    sequences = {}
    for p in found:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        size = sum(n for _, n in parts)
        assert size <= 2048
        padding += 0 if size & (size - 1) == 0 else 2048 - size
    assert padding < 0.03 * sum(p.length for p in found)
    assert rows(packing.packed(spark.createDataFrame([], ROWS))) == []


def test_every_query_is_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
