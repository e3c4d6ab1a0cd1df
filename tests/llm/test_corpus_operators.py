"""Operators that relate documents to each other, against brute force on the hard cases."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from claimlake.llm import common, line_dedup, pack, shard, simhash, topk
from claimlake.llm.common import vocabulary
from pyspark.sql import functions as F
from tests.llm import frames


@pytest.fixture(scope="module")
def docs(spark):
    return frames.clashing(frames.frame(spark)).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frames.frame(spark, [])


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = common.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == label
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    w = frames.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_simhash(spark, docs, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    data = frames.rows()
    prints = [brute_fingerprint(t) for _, t, *_ in data]
    label = list(range(len(data)))
    for _ in data:
        for a in range(len(data)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {k: min((data[i][0] for i in range(len(data)) if label[i] == k and data[i][0] is not None), default=None) for k in set(label)}
    want = sorted((repr(i), p, least[k]) for (i, *_), p, k in zip(data, prints, label))
    got = sorted((repr(r["key"]), r["code"] % 2 ** 64, r["component"]) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_first(nothing).count() == 0


def test_gray_index_finds_all():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    flip = lambda: np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)
    codes = np.unique(np.concatenate([base] + [base ^ flip() ^ flip() for _ in range(10)]))
    got = {(int(a), int(b)) for x, y in simhash.GrayIndex(codes).search(codes, 3) for a, b in zip(x, y)}
    want = {(i, int(j)) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes) <= 3)}
    assert got == want


@pytest.mark.parametrize("n_shards", [16, 3])
def test_shards(spark, docs, nothing, n_shards):
    rows = shard.sharded(docs, n_shards).collect()
    sizes = sorted((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in frames.rows())
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sizes
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n_shards))
    assert shard.sharded(nothing).count() == 0


def test_shards_split_repeated_rows(spark):
    same = spark.createDataFrame([(7, "the same row")] * 1000 + [(i, "x" * 12) for i in range(500)], "doc_id long, text string")
    sizes = [r["b"] for r in shard.sharded(same).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 2 * 13


def test_packing(spark, docs, nothing):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = []
    for i, text, *_ in frames.rows():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(repr(i), n, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for n, a in enumerate(range(0, len(ids), 2048))]
    rows = pack.pack_documents(docs, path).collect()
    assert sorted((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == -(-sum(r["length"] for r in rows) // 2048)
    assert pack.pack_documents(nothing, path).count() == 0


def test_packing_in_groups_and_rounds(spark, monkeypatch):
    """Dealing underfull remains again packs better than groups on their own; one group packs like the whole."""
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(sizes)], "row long, piece int, length long")

    def sequences(group_pieces):
        rows = pack.packed(pieces, 100, group_pieces=group_pieces).collect()
        assert sorted(r["row"] for r in rows) == list(range(3000))
        fills = collections.Counter()
        for r in rows:
            fills[r["sequence_id"]] += r["length"]
        assert max(fills.values()) <= 100
        return len(fills)

    with_rounds = sequences(200)
    whole = sequences(5000)
    monkeypatch.setattr(pack, "ROUNDS", 1)
    assert whole <= len(pack.best_fit(np.array(sizes, np.int64), 100)) <= with_rounds < sequences(200)


def test_local_search_empties_a_bin():
    # two-for-one: 6 gives way to 4 + 3 twice, and the donor's rest moves
    lengths = np.array([6, 3, 7, 2, 4, 3, 5], np.int64)
    bins = pack.local_search([[0, 1], [2, 3], [4, 5], [6]], lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(7))
    assert all(lengths[b].sum() <= 10 for b in bins) and len(bins) <= 4
    assert len(pack.local_search([[0], [1], [2]], np.array([4, 4, 2], np.int64), 10)) == 1


@pytest.mark.parametrize("block, seeds", [(8192, 2048), (16, 16)])
def test_top_k(spark, monkeypatch, block, seeds):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SEED_ROWS", seeds)
    rng = np.random.default_rng(4)
    data = [(i, (rng.normal(0, 1, 8) * rng.choice([0.2, 1, 5])).tolist()) for i in range(400)]
    data += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (None, [1.0] * 8), (403, []), (404, [0.0] * 8), (405, [2.0, 1.0])]
    data += [data[0], data[7]]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("row", F.lit("x"))
    good = [(n, i, np.array([np.floor(1024 * x) for x in v] + [0] * (8 - len(v)))) for n, (i, v) in enumerate(data)
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, i, v in good:
        if i % 100 == 0:
            best = sorted((-int(v @ w), j) for m, j, w in good if m != n)[:10]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = topk.top_k(vectors, F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def brute_removed(data):
    """How many lines go, by all pairs that have a shingle in common (from the definition, not the operator's code)."""
    places = sorted(((i is None, i or 0, n), p, line) for n, (i, t, *_) in enumerate(data) for p, line in frames.lines(t))
    lines = list(dict.fromkeys(line for _, _, line in places))
    sets = [frames.shingles(line) for line in lines]
    holders, label = collections.defaultdict(list), list(range(len(lines)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, own in enumerate(sets):
        common = collections.Counter(m for shingle in own for m in holders[shingle])
        for m, both in common.items():
            if 10 * both >= 8 * (len(own) + len(sets[m]) - both):
                label[root(n)] = root(m)
        for shingle in own:
            holders[shingle].append(n)
    number, seen, gone = {line: n for n, line in enumerate(lines)}, set(), 0
    for _, _, line in places:
        c = root(number[line])
        gone += c in seen
        seen.add(c)
    return gone


def test_lines_of_a_table(spark):
    """On the documents of the smallest table the search misses no more than 1 % of the lines that go."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute_removed([tuple(r) for r in docs.collect()])
    got = line_dedup.line_report(docs).agg(F.sum("n_removed")).first()[0]
    assert want > 100 and 0.99 * want <= got <= want


def test_exact_shingle_numbers():
    """Common shingles as counted on the strings: short lines, null characters, more characters than a byte holds."""
    rng = random.Random(9)
    wide = ["".join(chr(rng.randrange(0x4E00, 0x5200)) for _ in range(60)) for _ in range(8)]
    wide += [line[:40] + "x" + line[40:] for line in wide]
    narrow = ["ab", "ab\0\0\0\0\0\0", "abcdefg", "abcdefgh", "abcdefghi", "bcdefghi" * 5, "\U0001F600 home | about | help"]
    for lines in (narrow, narrow + wide):
        sets = line_dedup._packed([line.encode() for line in lines])
        near = line_dedup._alike_matrix(sets)
        for a, x in enumerate(map(frames.shingles, lines)):
            assert len(sets[a]) == len(x)
            for b, y in enumerate(map(frames.shingles, lines)):
                assert len(np.intersect1d(sets[a], sets[b])) == len(x & y)
                assert a == b or near[a, b] == (10 * len(x & y) >= 8 * len(x | y))


@pytest.mark.parametrize("block", [line_dedup.BLOCK, 2])
def test_lines(spark, docs, nothing, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    report = line_dedup.line_report(docs).collect()
    assert len(report) == len(frames.rows())
    assert sum(r["n_removed"] for r in report) == brute_removed(frames.rows())
    by_id = {r["doc_id"]: r for r in report if r["doc_id"] is not None}
    assert by_id[12]["n_removed"] == 2 and by_id[0]["n_removed"] == 0 and by_id[16]["n_removed"] >= 1
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert texts[0]["text"] == frames.rows()[0][1] and 12 not in texts and texts[17]["text"] is None
    assert line_dedup.line_report(nothing).count() == 0 and line_dedup.deduplicated(nothing).count() == 0


def test_alike_lines_share_buckets():
    rng = random.Random(6)
    shared = 0
    for _ in range(200):
        line = frames.sentence(rng, 40)
        other = line.split(" ")
        other[rng.randrange(40)] = "changed"
        a, b = line_dedup._bands([line, " ".join(other)])
        shared += bool((a == b).any())
    assert shared >= 198


def test_short_lines_take_part(spark):
    """Exact copies at any length, near copies from a shingle on; lines of white space never."""
    texts = ["ab\nOnly here\n \n" + "x" * 40, "AB\nhome | about | help\n \n\nab", "home | about | help!\n  ab\nabc\nmenü"]
    docs = frames.frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(docs).collect()}
    assert got == {0: [], 1: [0, 4], 2: [0, 1]}


def test_short_alike_lines_share_buckets():
    rng = random.Random(8)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(12, 30))) for _ in range(400)]
    pairs = [(a, a + "!") for a in lines
             if 10 * len(frames.shingles(a) & frames.shingles(a + "!")) >= 8 * len(frames.shingles(a) | frames.shingles(a + "!"))]
    assert len(pairs) > 300
    shared = sum(bool((a == b).any()) for a, b in (line_dedup._bands(list(p)) for p in pairs))
    assert shared >= 0.985 * len(pairs)
    # lines with one shingle in common rarely meet
    some = line_dedup._bands([f"{i:07x} headline {i * 7919 % 99991:05d}"[:22] for i in range(500)])
    assert (some[:250] == some[250:]).any(1).mean() < 0.1


def test_short_own_text_is_kept(spark):
    line = "a line of some length that many documents hold"
    data = [(0, line), (1, f"{line}\nmine"), (2, f"{line}\n \t"), (3, line), (4, f" \n{line} and its own end of many more words")]
    docs = frames.frame(spark, [(i, t, "en", "s", len(t)) for i, t in data])
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.deduplicated(docs).collect()}
    assert left == {0: (line, len(line)), 1: ("mine", 4), 4: (data[4][1], len(data[4][1]))}
