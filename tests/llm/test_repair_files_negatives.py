"""Conversation repair, token files and hard negatives against brute force on hard cases."""

import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimlake.llm import conversation_repair as repair
from claimlake.llm import hard_negatives, token_files
from claimlake.llm.common import staged, vocabulary
from tests.llm import frames

# ---------------------------------------------------------------- conversation repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute_repair(rows):
    """(cost, audit, lines) of (role, text, forced, truncated), by search over (place, state) with whole strings."""
    n = len(rows)

    @functools.cache
    def best(at, said, inserts):
        """Least (cost, audit, lines) from here; ``said`` is the last two initials given so far, '' at the start."""
        found = []
        if at == n and (said == "" or said == "ua"):
            found.append((0, "", ()))
        fits = {"": "su", "s": "u", "u": "a", "ua": "u"}[said]
        after = {"s": "s", "u": "u", "a": "ua"}
        if inserts < 3:
            for initial, role in (("u", "user"), ("a", "assistant")):
                if initial in fits:
                    c, a, lines = best(at, after[initial], inserts + 1)
                    found.append((c + 5, "I" + a, (role + ":",) + lines))
        if at < n:
            role, text, forced, truncated = rows[at]
            c, a, lines = best(at + 1, said, 0)
            found.append((c + 2, "D" + a, lines))
            if not forced:
                late = 5 if truncated else 0
                if role[:1] and role[:1] in fits:
                    c, a, lines = best(at + 1, after[role[:1]], 0)
                    found.append((c + late, "K" + a, (f"{role}:{text}",) + lines))
                for initial, other in (("u", "user"), ("a", "assistant")):
                    if initial in fits:
                        c, a, lines = best(at + 1, after[initial], 0)
                        found.append((c + late + 1, "R" + a, (f"{other}:{text}",) + lines))
        return min(found) if found else (math.inf, "", ())

    return best(0, "", 0)


def brute_conversation(rows):
    """The result columns from present (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, judged, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit, lines = brute_repair(tuple(judged))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def conversations(seed, n=60, hot=150):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "agent", "", "User", None]
    texts = ["One.", "Two!", "Three?", "four", " \t\n", "", "Five. \n", "no end, \x0b", None, "Six " * 50 + ".", "é。", "x "]
    rows = []
    for conv in list(range(n)) + [None]:
        length = hot if conv == 7 else rng.randint(0, 9)
        for turn in range(length):
            number = None if rng.random() < 0.05 else turn // (2 if rng.random() < 0.2 else 1)
            rows.append((conv, number, rng.choice(roles[:2] if rng.random() < 0.5 else roles), rng.choice(texts)))
    rows += rng.choices(rows, k=30) + [(500, 0, "system", "Alone."), (501, 0, "user", "Hello.")]
    rng.shuffle(rows)
    return rows


def turns_frame(spark, rows):
    from tests.llm.frames import clashing
    return clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("part_rows", [repair.PART_ROWS, 40, 11])
def test_repair(spark, part_rows):
    """Whole conversations and, with small parts, conversations that lie in many parts."""
    rows = conversations(part_rows)
    want = {c: brute_conversation(r) for c, r in brute_damage(rows).items()}
    got = repair.repaired(repair.damaged(turns_frame(spark, rows)), present=F.col("present"), part_rows=part_rows).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]], r["conv_id"]


def test_repaired_text_is_legal(spark):
    """Every repaired conversation has the grammar; parts joined in order give the checksum's text."""
    rows = conversations(3)
    pieces = repair.repaired_parts(repair.damaged(turns_frame(spark, rows)), present=F.col("present"), part_rows=25).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: p["part"]):
        if p["kept"]:
            whole.setdefault(p["key"], []).append(p["repaired"])
    assert any(not p["whole"] for p in pieces) and any(p["whole"] for p in pieces)
    for lines in whole.values():
        initials = [line[0] for text in lines for line in text.split("\n") if re.match("(system|user|assistant|agent):", line)]
        assert GRAMMAR.fullmatch("".join(initials))


def test_repair_of_nothing(spark):
    empty = turns_frame(spark, [])
    assert repair.repaired(repair.damaged(empty), present=F.col("present")).count() == 0
    gone = repair.repaired(turns_frame(spark, [(1, 0, "user", "A.")]), present=F.lit(False)).first()
    assert tuple(gone[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_block_tables_equal_single_steps():
    tables, rng = repair.BlockTables(), random.Random(1)
    for _ in range(300):
        symbols = [rng.randrange(repair.SYMBOLS) for _ in range(rng.randrange(15))]
        cost = repair.LAST
        for x in reversed(symbols):
            cost = repair._before(x, cost)
        vector, total, _ = tables.back(symbols, tables.number[repair._normal(repair.LAST)[0]])
        assert tuple(c + total for c in tables.vectors[vector]) == cost


# ---------------------------------------------------------------- token files

@pytest.mark.parametrize("file_ids", [token_files.FILE_IDS, 700])
def test_token_files(spark, file_ids):
    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = []
    for doc, text, *_ in frames.rows():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        rows.append((doc, len(ids) // 4, zlib.crc32(ids)))
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    want, start = [], 0
    for doc, n, crc in rows:
        want.append((doc, start, n, crc))
        start += n
    docs = frames.clashing(frames.frame(spark)).withColumn("file", F.lit("own")).withColumn("control", F.lit("own"))
    got = token_files.round_trip(docs, path, file_ids=file_ids).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_of_nothing(spark):
    read = token_files.round_trip(frames.frame(spark, []), vocabulary("word_bpe_49k.json"))
    assert read.columns == ["doc_id", "start", "n_tokens", "ids"] and read.count() == 0


def test_code_of_every_width():
    rng = random.Random(2)
    documents = [np.array([rng.randrange(1 << rng.choice([3, 8, 9, 16, 17, 24, 25, 32])) for _ in range(n)], np.uint32)
                 for n in [0, 1, 2, 3, 4, 5, 8, 9, 1000]]
    documents.append(np.array([0, 255, 256, 65535, 65536, 2 ** 24 - 1, 2 ** 24, 2 ** 32 - 1], np.uint32))
    counts = np.array(list(map(len, documents)))
    control, control_ends, data, data_ends = token_files.encode_ranks(np.concatenate(documents), counts)
    assert np.array_equal(token_files.decode_ranks(control, data, counts), np.concatenate(documents))
    assert np.array_equal(np.diff(control_ends, prepend=0), -(-counts // 4))
    assert data_ends[-1] == len(data) and data_ends[-1] - data_ends[-2] == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4


def test_frequent_ids_take_one_byte(spark):
    """Ranks follow the corpus counts: the most frequent id has rank 0."""
    path = vocabulary("word_bpe_49k.json")
    docs = frames.frame(spark)
    tokens = token_files.token_ids(docs, path)
    counts = {}
    for r in tokens.collect():
        for i in np.frombuffer(r["ids"], "<u2"):
            counts[int(i)] = counts.get(int(i), 0) + 1
    order = sorted(range(token_files.vocabulary_size(path)), key=lambda i: (-counts.get(i, 0), i))
    ranks = {r["rank"]: r["id"] for r in token_files.id_ranks(tokens, token_files.vocabulary_size(path)).collect()}
    assert [ranks[i] for i in range(len(order))] == order


# ---------------------------------------------------------------- hard negatives

def brute_negatives(rows):
    good = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in good), default=0)
    m = np.zeros((len(good), width), dtype=object)
    for n, (_, v, _) in enumerate(good):
        m[n, :len(v)] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for n, (i, _, lab) in enumerate(good):
        if i % 100:
            continue
        score = [int(sum(a * b for a, b in zip(m[n], row))) for row in m]
        order = sorted(range(len(good)), key=lambda c: (-score[c], good[c][0]))
        for p in [c for c in order if good[c][2] == lab and c != n][:5]:
            window = [c for c in order if good[c][2] != lab and 30 * score[p] <= 100 * score[c] <= 90 * score[p]][:10]
            out += [(i, good[p][0], rank, good[c][0], score[p], score[c]) for rank, c in enumerate(window, 1)]
    return sorted(out)


def vectors(seed, n=900, width=6, clusters=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, width))
    rows = []
    for i in range(n):
        v = (centre[rng.integers(clusters)] + 0.1 * rng.normal(size=width)).astype(np.float32).tolist()
        rows.append((int(i * 5), v, int(rng.integers(4))))
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (200, rows[4][1][:3], 2), (300, [], 1), (400, None, 1), (500, [None] + [1.0] * 5, 1),
             (600, [float("nan")] * 6, 2), (700, [float("inf")] * 6, 2), (800, rows[5][1], None), (None, rows[6][1], 1), (900, [0.0] * 6, 3)]
    return rows + [(10_000 + i, rows[0][1], i % 2) for i in range(300)]  # one vector in a quarter of all rows


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_BYTES": 16 * 48, "PART": 3, "ZONE_BYTES": 16 * 6 * 20}])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(4)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("row", F.lit("own")).withColumn("block", F.lit("own"))
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1), (5, [1.0], 2)], VECTORS)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 100 == 0).count() == 0


def test_zone_maps_skip_blocks(spark, monkeypatch):
    """On rows in clusters, windows read few of the blocks, and never miss a row of theirs."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 32 * 48)
    data = spark.createDataFrame([r for r in vectors(9, n=3000) if r[1] and r[2] is not None and r[0] is not None and
                                  len(r[1]) == 6 and all(x is not None and math.isfinite(x) for x in r[1])], VECTORS)
    rows = staged(data.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"),
                              F.transform("embedding", lambda v: F.floor(256 * v.cast("double"))).alias("vec")), "test")
    blocks = hard_negatives.blocks_of(rows, 6, rows.count())
    n = blocks.count()
    home = blocks.select("block", F.explode("rows").alias("row")).withColumnRenamed("block", "home")
    anchors = rows.where("vec_id % 100 = 0").join(home, "row").withColumn("part", F.lit(0)).withColumn(
        "windows", F.array(hard_negatives._window(F.lit(0), F.lit(-2 ** 63), F.lit(2 ** 63 - 1))))
    hits, asks = hard_negatives.windows_read(anchors, blocks, True, 5)
    assert n > 60 and asks.count() < 0.5 * n * anchors.count()
    assert hits.count() == 5 * anchors.count()


@pytest.mark.parametrize("d,bits", [(1, 4), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_hilbert_rank_walks_through_neighbours(d, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    place = hard_negatives.hilbert_rank(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_words_end_at_the_six_spaces():
    """The files' word splitting takes the same white space as ``bytes.split``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    every = "a".join(map(chr, range(1, 0x3100)))
    assert [w for w in pc.ascii_split_whitespace(pa.array([every])).to_pylist()[0] if w] == [w.decode() for w in every.encode().split()]
