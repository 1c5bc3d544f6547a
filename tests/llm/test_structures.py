"""Conversation repair, prefix trie and token files: brute force, round trips, odd rows, SQL twins."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from odd_rows import odd  # noqa: F401  (fixture)
from pyspark.sql import functions as F

from cardlens.llm import byte_codes, piece_cache, prefix_trie, structure_repair, token_files
from cardlens.llm.queries import damaged_turns
from cardlens.llm.registry import llm_queries
from cardlens.llm.token_encoder import TokenEncoder
from cardlens.session import scratch_path

# ---- repair ----------------------------------------------------------------

_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_TO, _NAME = (2, 2, 3, 2), {2: "user", 3: "assistant"}


def best_repair(rows):
    """(cost, audit, hash) over all edit strings; rows are (role, text, must go, truncated)."""
    def inserted(paths):
        out, new = set(paths), set(paths)
        for _ in range(3):
            new = {(_TO[q], c + 2, a + "I", r + ((_NAME[_TO[q]], ""),)) for q, c, a, r in new}
            out |= new
        return out

    paths = inserted({(0, 0, "", ())})
    for role, text, gone, cut in rows:
        after = set()
        for q, c, a, r in paths:
            after.add((q, c + 3, a + "D", r))
            if not gone:
                if role[:1] in _KEEP[q]:
                    after.add((_KEEP[q][role[:1]], c + cut, a + "K", r + ((role, text),)))
                after.add((_TO[q], c + 2 + cut, a + "R", r + ((_NAME[_TO[q]], text),)))
        least = min(c for _, c, _, _ in after)
        paths = inserted({p for p in after if p[1] <= least + 8})  # no two states are further apart
    cost, audit, repaired = min((c, a, r) for q, c, a, r in paths if q in (0, 3))
    return cost, audit, hashlib.sha256("\n".join(f"{x}:{y}" for x, y in repaired).encode()).hexdigest()


def walked(rows):
    audit = []
    walk = structure_repair.Repair(audit.append)
    for role, text, gone, cut in rows:
        walk.row(role, text.encode(), gone, bool(cut))
    cost, digest = walk.finish()
    return cost, "".join(audit), digest


def test_repair_is_the_cheapest_and_least_of_all():
    r = random.Random(5)
    for _ in range(1500):
        roles = r.choice((["user", "assistant", "system", "tool", ""], ["user", "assistant"], ["user"]))
        rows = [(r.choice(roles), f"t{i}", f < 0.2, int(0.2 <= f < 0.4)) for i, f in enumerate(r.random() for _ in range(r.randrange(0, 7)))]
        assert walked(rows) == best_repair(rows), rows


def test_survivors_coalesce_and_time_is_linear():
    emitted = []
    walk = structure_repair.Repair(emitted.append)
    for i in range(2000):
        walk.row("user" if i % 2 == 0 else "assistant", b"x.", False, False)
        assert len(emitted) >= i - 1  # settled rows do not wait for the end

    def seconds(n):
        start = time.perf_counter()
        walked([("user", "x", i % 3 == 1, 0) for i in range(n)])  # nothing settles before the end
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(16_000) < 3.5 * seconds(8_000)


def faults_of(rows):
    """The contract's counts and fault flags of rows (turn, role, text), in order."""
    seen, out, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        trimmed = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 0 if not trimmed else 1 if (role, text) in seen else 2 if trimmed[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        out.append((role, text, fault in (0, 1), int(fault == 2)))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *counts, illegal), out


CONVERSATIONS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"), (1, 1, "assistant", "Yes?"), (1, 5, "user", "cut off"), (1, None, "system", "Be kind."),
    (2, 0, None, None), (2, 1, "user", " \t\n"), (2, 2, "user", "a."), (2, 2, "user", "b."),
    (3, 0, "assistant", "No."), (3, 1, "tool", "x!"), (3, 2, "", "y."), (3, None, "user", None),
    (None, 0, "user", "who?"), (None, 1, "assistant", "me."), (4, 0, "system", "alone."), (4, 3, "user", "long " * 50_000 + "."),
    (5, 7, "user", "same."), (5, 7, "user", "same."), (5, 7, "user", "same."), (6, 0, "u", "é…"), (6, 1, "a", "nbsp "),
]


@pytest.fixture(scope="module")
def turns(spark):
    rows = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    for name in ("id", "cost", "present", "audit", "a.b", "__row", "row"):
        if name != "__row":
            rows = rows.withColumn(name, F.lit("own"))
    return rows.repartition(5).cache()


def _grouped():
    found = {}
    for c, t, role, text in CONVERSATIONS:
        found.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in found.items()}


def test_report_equals_brute_force(spark, turns):
    got = {r.conv_id: tuple(r)[1:] for r in structure_repair.repair_report(turns).collect()}
    want = {}
    for c, rows in _grouped().items():
        counts, flagged = faults_of(rows)
        want[c] = (*counts, *best_repair(flagged))
    assert got == want
    assert structure_repair.repair_report(turns.limit(0)).count() == 0
    none = structure_repair.repair_report(turns, present=F.lit(False)).collect()
    assert {tuple(r)[1:] for r in none} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())} and len(none) == len(want)


def test_repaired_turns_are_those_of_the_report(spark, turns):
    report = {r.conv_id: r for r in structure_repair.repair_report(turns).collect()}
    rows = {}
    for r in structure_repair.repair_turns(turns).orderBy("position").collect():
        rows.setdefault(r.conv_id, []).append(r)
    for c, one in report.items():
        mine = rows.get(c, [])
        assert [r.position for r in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == one.repaired_sha256
        assert "".join(r.edit for r in mine) == one.audit.replace("D", "")
        assert all(r.turn is None for r in mine if r.edit == "I")
    assert structure_repair.repair_turns(turns.limit(0)).count() == 0


def test_damage(spark):
    rows = spark.createDataFrame([(i, 1, "assistant", "A. b! c?") for i in range(400)], "conv_id long, turn long, role string, text string")
    found = {}
    for r in damaged_turns(rows).collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text, r.present))
    for i in range(400):
        kind = zlib.crc32(f"{i}:1".encode()) % 20
        one = ("user" if kind == 4 else "assistant", "" if kind == 1 else "A b c" if kind == 2 else "A. b! c?", kind != 0)
        assert found[i] == [one] * (2 if kind == 3 else 1)


# ---- trie ------------------------------------------------------------------

def trie(rows, base=None, head=None):
    """{(depth, members' sequence): row} by plain prefixes; rows are (conv, turn, role, text) without ties."""
    found = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        found.setdefault(c, []).append((role or "", text or ""))
    rebuilt = {}
    for c, own in found.items():
        h = head(c) if head and c is not None else 0
        rebuilt[c] = (found.get(base(c), []) if base and c is not None else [])[:h] + own[h:]
    order = lambda c: (c is None, c or 0)
    members = {}
    for c in sorted(rebuilt, key=order):
        for d in range(len(rebuilt[c]) + 1):
            members.setdefault(tuple(rebuilt[c][:d]), []).append(c)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[:len(path)] == path]
        kids = sum(len(p) == len(path) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in own if c is not None and len(rebuilt[c]) == len(path))
        out.append((own[0], len(path), members[path[:-1]][0] if path else None, len(own), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _random_turns(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(100, 125), *range(0, 12), 207, 300, -7, -100, None]:
        for t in range(r.choice((1, 1, 2, 3, 5, 9))):
            rows.append((c, r.choice((None, t)) if t == 0 else t, r.choice(("user", None, "a")), r.choice(("", None, "x", "yy", "é😀"))))
    return rows


@pytest.mark.parametrize("cell", [4096, 2])
def test_trie_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(prefix_trie, "CELL", cell)
    rows = _random_turns(3)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("c", F.lit("own")).withColumn("a.b", F.lit(1))
    c = F.col("c")
    truncated = lambda x: x - int(x % 100 if x >= 0 else -(-x % 100))
    got = prefix_trie.prefix_trie(turns, base=c - c % 100, head=F.crc32(c.cast("string")) % 6).collect()
    assert sorted(map(tuple, got), key=str) == trie(rows, truncated, lambda x: zlib.crc32(str(x).encode()) % 6)
    assert sorted(map(tuple, prefix_trie.prefix_trie(turns).collect()), key=str) == trie(rows)
    assert prefix_trie.prefix_trie(turns.limit(0)).count() == 0


def test_trie_of_tied_and_repeated_turns(spark):
    rows = [(c, 1, "user", "tie") for c in (1, 2) for _ in range(3)] + [(3, 1, "user", "a"), (3, 1, "user", "b"), (4, 1, "user", "b"), (4, 1, "user", "a")]
    got = {(r.depth, r.conv_id): r.n_convs for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {(0, 1): 4, (1, 1): 2, (2, 1): 2, (3, 1): 2, (1, 3): 2, (2, 3): 2}


def test_shared_hashes_are_found(spark, monkeypatch):
    rows = _random_turns(4)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    with pytest.raises(RuntimeError, match="share a hash"):
        prefix_trie.prefix_trie(turns, primes=(3, 5), bases=((2, 3),))  # a field of 15 elements cannot tell them apart
    real, calls = prefix_trie._same_turns, []
    monkeypatch.setattr(prefix_trie, "_same_turns", lambda *a: bool(calls.append(1)) or len(calls) > 1 and real(*a))
    assert sorted(map(tuple, prefix_trie.prefix_trie(turns).collect()), key=str) == trie(rows) and len(calls) == 2


# ---- token files -----------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 1000])
def test_byte_codes_round_trip(n):
    r = np.random.default_rng(n)
    values = r.integers(0, 1 << r.integers(1, 33, n), n).astype(np.uint32) if n else np.empty(0, np.uint32)
    control, data = byte_codes.encode(values)
    assert len(control) == -(-n // 4) and len(data) == sum(max(1, -(-int(v).bit_length() // 8)) for v in values)
    assert (byte_codes.decode(control, data, n) == values).all()
    if n:
        with pytest.raises(ValueError):
            byte_codes.decode(control, data[:-1], n)
    edges = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    assert (byte_codes.decode(*byte_codes.encode(edges), 8) == edges).all()


def _odd_texts(n, seed):
    r = random.Random(seed)
    parts = ["the", " the", "The", "don't", "'s", " 'll", "été", " straße", " ", " ", "　", "你好", "\U0001f600", "\n\n", "\t", "  ", " ", "12", "3.5", "...",
             "!?", "a_b", "\x1f", "\x7f", "́", "×", "÷", "ǅ", "ﬁ", "x" * 40, "co-op", "#", "\r\n", "\u0085", " ", "I'M", "he'd"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(0, 40))) for _ in range(n)]


def _slice(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


@pytest.fixture(scope="module")
def vocabulary():
    with open(token_files.tokenizer_file(), encoding="utf-8") as source:
        return source.read()


@pytest.mark.parametrize("small, collide", [(False, False), (True, False), (False, True)])
def test_ids_are_those_of_the_library(vocabulary, monkeypatch, small, collide):
    if small:  # the caches are emptied all the time
        for name in ("CACHE_PIECES", "CACHE_LONG", "CACHE_LONG_BYTES", "CACHE_CODES"):
            monkeypatch.setattr(piece_cache, name, 3)
    if collide:  # nearly all pieces share a hash
        monkeypatch.setattr(piece_cache, "mix64", lambda h: h.astype(np.uint64) & np.uint64(3))
    encoder = TokenEncoder(vocabulary)
    for seed in range(4):
        texts = _odd_texts(60, seed) + ["", "a <|endoftext|> b"][: 1 + seed % 2]
        ids, counts = encoder.encode(*_slice(texts))
        want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert not len(encoder.encode(*_slice([]))[0]) and not len(encoder.encode(*_slice(["", ""]))[0])


def test_another_splitter_goes_to_the_library_whole():
    with open(token_files.tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as source:
        encoder = TokenEncoder(source.read())
    assert not encoder.by_pieces
    texts = _odd_texts(20, 9)
    ids, _ = encoder.encode(*_slice(texts))
    assert ids.tolist() == [i for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def test_token_files_round_trip(spark, vocabulary, monkeypatch):
    """Several blocks and files; null, repeated and text ids; the ranking; what the files hold alone is what comes back."""
    monkeypatch.setattr(token_files, "BLOCK_IDS", 200)
    monkeypatch.setattr(token_files, "FILE_BLOCKS", 2)
    texts = [None, "", *_odd_texts(150, 1), "word " * 400]
    rows = [(None if i % 7 == 0 else f"k{i % 50:03d}", t, "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "`the.id` string, text string, ids string").repartition(4)
    path = scratch_path(spark, "files")
    token_files.write_token_files(docs, path, id_col="the.id")
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    encoder = TokenEncoder(vocabulary)
    want = sorted(((i is not None, i or ""), tuple(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t, _ in rows)
    found = [((r.id is not None, r.id or ""), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got]
    assert sorted(found) == want and [k for k, _ in found] == [k for k, _ in want]
    place = 0
    for r in got:
        assert (r.start, r.n_tokens) == (place, len(r.ids) // 4)
        place += r.n_tokens
    index = spark.read.parquet(f"{path}/index").collect()
    assert len(index) > 3 and sum(i.n_docs for i in index) == len(rows) and sum(i.n_ids for i in index) == place
    times = {}
    for _, ids in want:
        for i in ids:
            times[i] = times.get(i, 0) + 1
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert len(ranks) == encoder.size and [(-r.occurrences, r.token_id) for r in ranks] == sorted((-times.get(i, 0), i) for i in range(encoder.size))


def test_token_files_of_nothing_and_damaged_files(spark):
    path = scratch_path(spark, "files")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path)
    assert token_files.read_token_files(spark, path).count() == 0
    import pyarrow as pa

    block = token_files._block(pa.array([1, 2]), [2, 1], np.array([0, 300, 5], np.uint32)) + b"\n"
    assert [(b[0], b[1]) for b in token_files.parse_blocks(block + block)] == [(2, 3), (2, 3)]
    for bad in (block[:-1], b"XXXX" + block[4:], block + block[:-3]):
        with pytest.raises((ValueError, Exception)):
            list(token_files.parse_blocks(bad))


def test_token_query_equals_the_library(spark, vocabulary):
    got = sorted(map(tuple, llm_queries()["op13_token_files"](spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    tokenizer, start, want = TokenEncoder(vocabulary).tokenizer, 0, []
    for r in docs:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


@pytest.mark.parametrize("name", ["op11_structure_repair", "op12_prefix_trie"])
def test_query_equals_sql(spark, name):
    import duckdb

    from cardlens.llm.registry import llm_oracle_sql

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF_SMALL}/conversations.parquet')")
    columns = sorted(con.sql(llm_oracle_sql()[name]).columns)
    got = llm_queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == columns
    want = con.sql(f"select {', '.join(columns)} from ({llm_oracle_sql()[name]})").fetchall()
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted(want, key=str) and want
