"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents become token ids (one closing id each); only documents longer than a
sequence are cut.  Pieces are dealt at random into groups of bounded size, each
group is packed by best fit (longest piece first, into the fullest sequence it
fits) and then improved by swap-based local search: pieces of the least filled
sequence are moved, exchanged one for one, or two for one, with other underfull
sequences whenever that raises the sum of squared fills, until it is empty or
nothing helps.  What lies in sequences that stay underfull is dealt again into
fewer groups, so each round packs a small remainder of the one before.

Tokens: a word-level vocabulary that drops white space encodes the words of a
text (runs outside ``\\x20\\x09-\\x0D``) independently of each other, so the
tokenizer is asked once per distinct word and worker.

Defined cases: null and empty texts consist of the closing id alone; repeated
rows are packed each for itself; an empty table gives no pieces; columns other
than the key and the text are not read.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.llm.common import WordTable, staged, tune, words_of, worker_memory

GROUP_PIECES = 16_384   # pieces that one task packs together
ROUNDS = 4              # each round packs what the one before left in underfull sequences
UNDERFULL = 0.97        # a sequence filled less is packed again while there are several groups
SEARCH_STEPS = 4_000    # exchanges tried per group


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """The tokenizer's ids of words.

    Words of simple letters (below U+0250, which composition leaves alone and which lower
    letter by letter) are split as the tokenizer splits them, and its merge model is asked
    once per distinct part; all other words go through the whole tokenizer."""

    PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # fixed: the vocabulary's split
    LIMIT = 1_000_000

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.whole.model
        self.find = regex.compile(self.PARTS).findall
        self.simple = re.compile("[\x21-\u012f\u0131-\u024f]+").fullmatch
        self.letters = _byte_letters()
        self.parts: dict[str, list[int]] = {}

    def part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > self.LIMIT:
                self.parts.clear()
            letters = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[part] = [t.id for t in self.model.tokenize(letters)]
        return ids

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        out, odd = [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            if self.simple(text):
                parts = self.find(text.lower())
                out.append(self.part(parts[0]) if len(parts) == 1 else [i for p in parts for i in self.part(p)])
            else:
                odd.append((len(out), text))
                out.append([])
        for (at, _), coded in zip(odd, self.whole.encode_batch_fast([t for _, t in odd], add_special_tokens=False)):
            out[at] = coded.ids
        return out


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                     end_id: int = 0, length: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row per piece: key, row (a number of the document's row), piece, start, length, ids_crc32[, ids].

    ``ids`` are little-endian unsigned 32-bit integers."""
    tune(docs.sparkSession)
    out = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("row", T.LongType()),
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = worker_memory(f"pack {tokenizer_path}", lambda: WordTable(WordEncoder(tokenizer_path)))
        for batch in batches:
            split = [words_of(t) for t in batch.iloc[:, 2]]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            numbers = words.look_up([w for d in split for w in d])
            tokens = words.gather(numbers).astype("<u4")
            word_ends = np.concatenate([[0], np.cumsum(words.count[numbers], dtype=np.int64)])
            doc_ends = word_ends[np.cumsum(sizes)]
            rows, at = [], 0
            for name, row, end in zip(batch.iloc[:, 0].tolist(), batch.iloc[:, 1].tolist(), doc_ends.tolist()):
                ids = np.append(tokens[at:end], np.uint32(end_id)).astype("<u4")
                at = end
                for piece, start in enumerate(range(0, len(ids), length)):
                    part = ids[start:start + length].tobytes()
                    rows.append((name, row, piece, start, len(part) // 4, zlib.crc32(part), *([part] if keep_ids else [])))
            yield pd.DataFrame(rows, columns=out.names)

    source = docs.select(F.col(key), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("text"))
    # The key goes through pandas as text: a null in a whole-number column would turn it into floats.
    wide = T.StructType([T.StructField(key, T.StringType()), *out.fields[1:]])
    return (source.withColumn(key, F.col(key).cast("string")).mapInPandas(cut, wide)
            .withColumn(key, F.col(key).cast(out[key].dataType)))


def best_fit(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Best fit, longest first: lists of piece numbers."""
    bins: list[list[int]] = []
    room_of: list[list[int]] = [[] for _ in range(length + 1)]  # bins by room left
    rooms = 0                                                  # bit r is set if room_of[r] holds a bin
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = room_of[room].pop()
            if not room_of[room]:
                rooms &= ~(1 << room)
        else:
            room, b = length, len(bins)
            bins.append([])
        bins[b].append(i)
        room_of[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, length: int, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Empty the least filled sequences by moves and exchanges that raise the sum of squared fills."""
    fill = np.array([int(lengths[b].sum()) if b else 0 for b in bins], np.int64)
    under = [int(b) for b in np.argsort(fill, kind="stable") if fill[b] < length]
    for donor in under[:-1]:
        others = [b for b in under if b != donor and 0 < fill[b] < length]
        if not others or not bins[donor]:
            continue
        items = np.array([i for b in others for i in bins[b]])
        home = np.array([b for b in others for _ in bins[b]])
        need = int(fill[donor])
        if int((length - fill[others]).sum()) < need:
            break  # no way to empty it, and fuller donors need even more
        before = [list(bins[b]) for b in [donor, *others]]
        fill_before = fill.copy()
        while bins[donor] and steps > 0:
            steps -= 1
            if not _improve(donor, bins, fill, lengths, items, home, length):
                break
        if bins[donor]:  # the squared fill rose, but no sequence was saved: keep the simpler packing
            for b, old in zip([donor, *others], before):
                bins[b] = old
            fill = fill_before
    return [b for b in bins if b]


def _improve(donor, bins, fill, lengths, items, home, length) -> bool:
    """One move, one-for-one or two-for-one exchange out of ``donor``; False if none helps."""
    room = length - fill[home]
    mine = sorted(bins[donor], key=lambda i: -lengths[i])
    for y in mine:  # move
        able = np.flatnonzero(room >= lengths[y])
        if len(able):
            b = int(home[able[np.argmin(room[able])]])
            bins[donor].remove(y)
            bins[b].append(y)
            fill[donor] -= lengths[y]
            fill[b] += lengths[y]
            return True
    pairs = [((y,), int(lengths[y])) for y in mine]
    pairs += [((y, z), int(lengths[y] + lengths[z])) for n, y in enumerate(mine[:24]) for z in mine[n + 1:24]]
    for given, size in pairs:  # exchange for one shorter piece
        gain = size - lengths[items]
        able = np.flatnonzero((gain > 0) & (gain <= room))
        if len(able):
            at = int(able[np.argmax(gain[able])])
            x, b = int(items[at]), int(home[at])
            for y in given:
                bins[donor].remove(y)
                bins[b].append(y)
            bins[b].remove(x)
            bins[donor].append(x)
            fill[donor] -= gain[at]
            fill[b] += gain[at]
            # x now lies in the donor; one of the given pieces takes its place in the index
            items[at] = given[0]
            return True
    return False


def _group_packer(step: int, length: int):
    def pack(group, rows):
        rows = rows.drop(columns="group").reset_index(drop=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins = local_search(best_fit(lengths, length), lengths, length)
        order = np.array([i for b in bins for i in b])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        size = lengths[order]
        ends = np.cumsum(size)
        fills = np.bincount(number, size, len(bins)).astype(np.int64)
        first = np.cumsum(fills) - fills
        return rows.iloc[order].assign(
            sequence_id=(np.int64(step) << 58) + (np.int64(group[0]) << 24) + number,
            offset=ends - size - first[number], fill=fills[number])

    return pack


def packed(pieces: DataFrame, length: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset.  ``pieces`` needs row, piece and length (at most ``length``)."""
    left = staged(pieces, "pieces")
    columns = left.columns
    out = T.StructType([*left.schema.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType()), T.StructField("fill", T.LongType())])
    # Through pandas whole numbers that may be null travel as text.
    text_columns = [f.name for f in left.schema.fields if f.name not in ("row", "piece", "start", "length", "ids_crc32", "ids")]
    wide = T.StructType([T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType) for f in out.fields])
    done, count = [], left.count()
    for step in range(ROUNDS):
        groups = max(1, math.ceil(count / group_pieces))

        dealt = left.withColumns({c: F.col(c).cast("string") for c in text_columns}).withColumn(
            "group", F.pmod(F.xxhash64("row", "piece", F.lit(step)), F.lit(groups)).cast("int"))
        result = dealt.groupBy("group").applyInPandas(_group_packer(step, length), wide).withColumns(
            {c: F.col(c).cast(out[c].dataType) for c in text_columns})
        last = groups == 1 or step == ROUNDS - 1
        result = result if last and step == 0 else staged(result, f"packed{step}")
        if last:
            done.append(result)
            break
        full = F.col("fill") >= math.floor(UNDERFULL * length)
        done.append(result.where(full))
        left = result.where(~full).select(columns)
        rest = left.count()
        if rest == 0:
            break
        if rest > 0.9 * count:  # the sizes leave every sequence underfull: another deal changes nothing
            done.append(result.where(~full))
            break
        count = rest
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole.drop("fill")


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 2048, **options) -> DataFrame:
    """Tokenise and pack: one row per piece with its place."""
    return packed(tokenised_pieces(docs, tokenizer_path, length=length, **options), length)
