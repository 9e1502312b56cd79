"""The trie of conversations, periodic runs and packing (11, 12, 13) against brute force and round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import packing, runs, tokens, trie
from lakemart.llm.queries import PATTERN, QUERIES, TOKENIZER, VOCABULARY

# 11 -----------------------------------------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string"


def brute_trie(turns, rebuild):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(t)] for c, t in own.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
        first = {c: c - int(np.fmod(c, 100)) for c in own}
        own = {c: own.get(first[c], [])[: h[c]] + t[h[c] :] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        for d in range(len(own[c]) + 1):
            members[tuple(own[c][:d])].append(c)
        ends[tuple(own[c])].append(c)
    below = {node: [n for n in members if n[: len(node)] == node] for node in members}
    children = {node: sum(len(n) == len(node) + 1 for n in below[node]) for node in members}
    return sorted(
        (
            members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), children[node],
            sum(children[n] == 0 for n in below[node]), sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below[node]),
            hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
        )
        for node in members
    )


def some_turns(rng):
    """Common beginnings, a conversation copied very often, turns without number, role or text, and ids below zero."""
    turns = [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc")) for c in range(60) for t in range(rng.randrange(1, 7))]
    turns += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(5)]
    turns += [(c, t, "user", "deep" if c % 2 else f"deep {t}") for c in (301, 302, 303, 304) for t in range(40 + c)]
    turns += [(-7, 1, "user", "a"), (-150, 1, None, "a"), (400, None, None, None), (400, 1, "", ""), (401, 3, "us", "er:a"), (401, 3, "u", "ser:a")]
    turns += [(402, 1, "user", "again")] * 3 + [(None, 1, "user", "x"), (None, None, None, None), (403, 1, "é", "漢字 \U0001f600")]
    return turns


@pytest.mark.parametrize("rebuild", [True, False])
@pytest.mark.parametrize("per_shard", [20, 300, 10**9])
def test_trie(spark, rebuild, per_shard):
    turns = some_turns(random.Random(per_shard))
    rng = random.Random(3)
    rng.shuffle(turns)
    table = spark.createDataFrame(turns, CHAT).repartition(3).selectExpr("*", "'x' AS path", "1 AS shard", "2 AS points", "3 AS Depth")
    found = trie.prefix_trie(table, rebuild=rebuild, per_shard=per_shard)
    expected = brute_trie(turns, rebuild)
    assert sorted(map(tuple, found.collect())) == expected


def test_trie_is_cut_into_shards(spark):
    """The splitters also part equal conversations, and their paths are bounded."""
    turns = [(c, t, "user", f"same {t}") for c in range(400) for t in range(3)]
    rows = trie.as_paths(trie.paths(spark.createDataFrame(turns, CHAT))).cache()
    bones = trie.skeleton(rows, turns=100)
    assert len(bones.splitters) > 5 and len(bones.parent) == 4
    shards = [bones.shard(bytes(r["path"]), r["conv_id"]) for r in rows.collect()]
    assert max(shards.count(s) for s in set(shards)) < 200
    few = trie.skeleton(rows, turns=100, most=16 * 4 * trie.SAMPLES * 2)
    assert 1 <= len(few.splitters) <= 4
    rows.unpersist()


def test_trie_without_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CHAT)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], CHAT), rebuild=True).count() == 0


def test_trie_by_shards_like_sql(spark, testdata, monkeypatch):
    """The whole query gives the same with one shard and with very many."""
    one = sorted(map(tuple, QUERIES["op11_prefix_trie"](spark, testdata).collect()))
    turns = spark.read.parquet(f"{testdata}/conversations.parquet")
    assert sorted(map(tuple, trie.prefix_trie(turns, rebuild=True, per_shard=40).collect())) == one


# 12 -----------------------------------------------------------------------------------------------------------------


def brute_runs(words):
    """Every stretch with its smallest period, straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, rewrite):
    from fractions import Fraction

    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    if found:
        s, n, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = s, n, q, 1000 * n // q
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(), found, left


@pytest.mark.parametrize("rewrite", [False, True])
def test_runs(spark, awkward, nothing, rewrite):
    rng = random.Random(12)
    rows = []
    for doc in range(300):
        words = [rng.choice("abcd") for _ in range(rng.randrange(0, 70))]
        for _ in range(rng.randrange(3)):
            unit, times = [rng.choice("abcde") for _ in range(rng.randrange(1, 9))], rng.randrange(3, 8)
            at = rng.randrange(len(words) + 1)
            words[at:at] = unit * times + unit[: rng.randrange(len(unit) + 1)]
        rows.append((doc, rng.choice([" ", "\n", "  \t"]).join(words)))
    rows += [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect() if r["doc_id"] != 8]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS start", "1 AS Runs")
    found = [(*r[:8], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs, rewrite=rewrite).collect()]
    assert sorted(found, key=repr) == sorted((brute_row(d, t, rewrite) for d, t in rows), key=repr)
    assert runs.periodic_runs(nothing).count() == 0
    assert runs.periodic_runs(awkward, with_runs=False).count() == awkward.count()


def test_runs_of_long_texts():
    """A text of one period all through, one of very many runs, and ties between exponents."""
    for period in (1, 777, 24_999):
        names = np.arange(100_000, dtype=np.uint64) % np.uint64(period)
        start, length, q = runs.runs_of(names, np.full(len(names), len(names)))
        assert (start.tolist(), length.tolist(), q.tolist()) == ([0], [100_000], [period])
    names = np.repeat(np.arange(20_000, dtype=np.uint64), 6)
    start, length, q = runs.runs_of(names, np.full(len(names), len(names)))
    assert len(start) == 20_000 and set(length.tolist()) == {6} and runs._best(start, length, q) == 0


# 13 -----------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    with open(TOKENIZER, encoding="utf-8") as file:
        return packing.Encoder(file.read(), {entry: i for i, entry in enumerate(tokens.read_ranks(VOCABULARY))}, PATTERN)


def test_encoder_is_the_tokenizer(encoder, documents):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    texts = [r["text"] for r in documents.select("text").limit(200).collect()]
    texts += ["", " ", "a <|endoftext|> b<|endoftext|>", "<|endoftext|", "x" * 20_000, "\n\t  \x00 été 漢字 \U0001f600 don't 12  ", "   　a​"]
    texts += ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)}" for c in range(lo, lo + 64)) for lo in (0x80, 0x300, 0x600, 0x1E00, 0x2000, 0x3000, 0xAC00, 0x1F600)]
    for text in texts:
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs, encoder, size):
    """Every id in one piece, no gap in a sequence, no padding, whole ids back. Returns the sequences' lengths."""
    expected = sorted(((d, np.append(encoder.ids(t or ""), np.uint32(0)).astype("<u4").tobytes()) for d, t in docs), key=repr)
    by_sequence = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    lengths = []
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        lengths.append(end)
    assert all(n <= size for n in lengths)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
    for (doc_id, n), own in by_doc.items():
        wanted = [ids for d, ids in expected if d == doc_id and len(ids) == 4 * n]
        assert sum(len(ids) for _, ids in own) == 4 * n * len(wanted)
        if len({*wanted}) == 1:  # pieces of equal documents can't be told apart
            for start, ids in own:
                assert wanted[0][4 * start : 4 * start + len(ids)] == ids
    assert sum(len(ids) for _, ids in expected) == sum(4 * n for n in lengths)
    return lengths


@pytest.mark.parametrize("group", [10, 4096])
def test_packing(awkward, documents, nothing, encoder, group):
    docs = documents.select("doc_id", "text").limit(150).union(awkward.select("doc_id", "text"))
    rows = packing.pack(docs, encoder, group=group).collect()
    lengths = check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], encoder, 1024)
    assert all(n & (n - 1) == 0 for n in lengths)  # nothing is padded
    assert packing.pack(nothing, encoder).count() == 0
    slim = packing.pack(awkward, encoder, with_ids=False)
    assert slim.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert slim.where("doc_tokens = 1").count() == 3  # NULL and empty texts are the end mark


def test_packing_copies(spark, encoder):
    """Rests of one length that never fit together: what first-fit leaves open is filled by cutting."""
    docs = spark.createDataFrame([(7, "river " * 600)] * 300, "doc_id long, text string").repartition(3)
    rows = packing.pack(docs, encoder, group=100).collect()
    lengths = check_packing(rows, [(7, "river " * 600)] * 300, encoder, 1024)
    assert sum(lengths) / 1024 > len(lengths) - 3 * 11
    again = packing.pack(docs, encoder, group=100)
    place = lambda r: (r["start"], r["length"], r["sequence_id"], r["offset"])
    assert len({place(r) for r in rows}) == len(rows) and again.count() > 0


def test_first_fit_decreasing():
    """The tournament tree finds the same bin as looking at one after another."""
    rng = np.random.default_rng(0)
    for n, size in ((0, 10), (1, 10), (2, 10), (300, 100), (1000, 64)):
        lengths = np.sort(rng.integers(1, size + 1, n))[::-1]
        room, expected = [], []
        for i, length in enumerate(lengths.tolist()):
            at = next((k for k, r in enumerate(room) if r >= length), len(room))
            if at == len(room):
                room.append(size)
                expected.append([])
            room[at] -= length
            expected[at].append(i)
        assert packing.first_fit_decreasing(lengths, size) == expected


def test_fill_gaps():
    rng = random.Random(13)
    for _ in range(200):
        bins, item = [], 0
        for _ in range(rng.randrange(0, 12)):
            left, own = 64, []
            while left and (not own or rng.random() < 0.7):
                length = rng.randrange(1, left + 1)
                own.append((item, 0, length))
                item, left = item + 1, left - length
            bins.append(own)
        whole = {p[0]: p[2] for b in bins for p in b}
        out = packing.fill_gaps(bins, 64)
        total = sum(whole.values())
        sizes = [sum(p[2] for p in b) for b in out]
        assert sizes.count(64) == total // 64 and all(n & (n - 1) == 0 for n in sizes) and sum(sizes) == total
        for k, length in whole.items():
            own = sorted((p[1], p[2]) for b in out for p in b if p[0] == k)
            assert [s for s, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(n for _, n in own) == length


def test_packed_group_in_any_order():
    rows = [{"doc_id": d, "group": 3, "start": 0, "length": n, "doc_tokens": n, "ids": bytes(4 * n)} for d, n in enumerate([600, 600, 5, 1000, 600, 7])]
    one, other = pa.Table.from_pylist(rows), pa.Table.from_pylist(rows[::-1])
    assert packing.packed_group(one, 1024).to_pylist() == packing.packed_group(other, 1024).to_pylist()
