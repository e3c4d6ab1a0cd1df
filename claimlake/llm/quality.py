"""Quality rules by tokenizer fertility.

A public sub-word vocabulary describes ordinary text of a language well and
everything else badly.  Per document three figures of the vocabulary are held
against a band for the document's language, or for the script of most of its letters
where its language has none: characters per token, the share of byte-fallback tokens,
and the entropy of the document's tokens (over at most 10 bits, so that length does
not count).  Before that come the plain counts of the base rules.

Words are the runs outside white space (``\\x20\\x09-\\x0D``); the vocabulary is
asked once per distinct word and worker.  One scan, no shuffle; a document is
read whole, and a batch holds at most ``BATCH_ROWS`` documents.

Defined cases: null and empty text have no words, fail the base rule and are not
kept; a null or unknown language gets the band of the text's script, or the default
band where the script has none; equal rows get equal answers; an empty table gives an empty result; other columns pass untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import WordTable, free_name, tune, words_of, worker_memory

#: (least, most) characters per token, most byte-fallback share, least token entropy
#: (as a share of the most bits the length allows, 10 at most).  Per language, for the
#: public 32k vocabulary.  Ordinary prose of these languages has about 2.8 to 5 characters
#: per token, invented words about 2, so the upper limits are wide.
BANDS = {
    "en": (1.68, 6.00, 0.10, 0.48),
    "fr": (1.58, 6.00, 0.10, 0.48),
    "de": (1.97, 6.00, 0.10, 0.48),
    "es": (1.68, 6.00, 0.10, 0.48),
    None: (0.80, 6.00, 0.40, 0.40),
}
#: The same for scripts that the vocabulary spells in short pieces and bytes: plain prose has 0.57
#: to 0.59 characters per token in cjk, 0.62 in hangul, 0.74 to 0.77 in indic, 0.79 in thai, and up
#: to a quarter of bytes.  Letters of other scripts may be three bytes each.
SCRIPT_BANDS = {
    "cjk": (0.40, 2.50, 0.40, 0.40),
    "hangul": (0.40, 2.50, 0.50, 0.40),
    "indic": (0.45, 3.00, 0.50, 0.40),
    "thai": (0.45, 3.00, 0.40, 0.40),
    "other": (0.25, 3.00, 1.00, 0.30),
}
#: Fixed values: (script, first and last code point) of the scripts that have a band.
SCRIPTS = (
    ("other", 0x0530, 0x058F), ("indic", 0x0900, 0x0DFF), ("thai", 0x0E00, 0x0EFF), ("other", 0x0F00, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("other", 0x1200, 0x18AF), ("cjk", 0x2E80, 0x2FDF), ("cjk", 0x3040, 0x312F),
    ("hangul", 0x3130, 0x318F), ("cjk", 0x31A0, 0x31FF), ("cjk", 0x3400, 0x4DBF), ("cjk", 0x4E00, 0x9FFF),
    ("hangul", 0xA960, 0xA97F), ("hangul", 0xAC00, 0xD7FF), ("cjk", 0xF900, 0xFAFF), ("cjk", 0x20000, 0x3FFFF),
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
ENTROPY_BITS = 10.0

METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_tokens long, chars_per_token double, byte_share double, token_entropy double, "
           "base_failed boolean, kept boolean")

_OTHER_BYTES = bytes(set(range(256)) - set(SYMBOLS))
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words lying in windows of ``window`` words that occur twice or more in the text.

    Windows get exact numbers by doubling: pairs of words, pairs of pairs, ..."""
    n = len(numbers) - window + 1
    if n < 2:
        return 0
    ids, width = numbers, 1
    while width < window:
        step = min(width, window - width)
        left, right = ids[:len(ids) - step], ids[step:]
        ids = np.unique(left * (int(ids.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)
        width += step
    hit = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines (split at \\n) with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


_EDGES = np.array([edge for _, first, last in SCRIPTS for edge in (first, last + 1)])


def script(text: bytes) -> str | None:
    """The script with a band that most letters beyond punctuation are of; none if most are of no such script."""
    if text.isascii():
        return None
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    place = np.searchsorted(_EDGES, points, side="right")
    inside = place[place % 2 == 1] // 2
    outside = int(((place % 2 == 0) & ((points >= 0xC0) | ((points | 32) - 97 < 26)) & ((points < 0x2000) | (points > 0x303F))).sum())
    times: dict[str, int] = {}
    for at, n in enumerate(np.bincount(inside, minlength=len(SCRIPTS)).tolist()):
        times[SCRIPTS[at][0]] = times.get(SCRIPTS[at][0], 0) + n
    most = max(times, key=times.get)
    return most if times[most] > outside else None


def _sentencepiece(model_path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    is_byte = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    return WordTable(lambda words: sp.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)), is_byte


def _entropy(tokens: np.ndarray, doc: np.ndarray, n_docs: int, vocab: int) -> np.ndarray:
    """Bits of each document's token distribution."""
    pair, times = np.unique(doc * vocab + tokens, return_counts=True)
    owner = pair // vocab
    total = np.bincount(owner, times, n_docs)
    return np.log2(np.maximum(total, 1)) - np.bincount(owner, times * np.log2(times), n_docs) / np.maximum(total, 1)


def _measure(texts, langs, table: WordTable, is_byte: np.ndarray, bands: dict) -> pd.DataFrame:
    docs = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    numbers = table.look_up([w for d in docs for w in d])
    ends = np.cumsum(sizes)
    tokens = table.gather(numbers)
    doc_of_token = np.repeat(np.repeat(np.arange(len(docs)), sizes), table.count[numbers])
    n_tokens = np.bincount(doc_of_token, minlength=len(docs))
    byte_share = np.bincount(doc_of_token, is_byte[tokens], len(docs)) / np.maximum(n_tokens, 1)
    bits = _entropy(tokens.astype(np.int64), doc_of_token, len(docs), len(is_byte))
    entropy = bits / np.minimum(np.log2(np.maximum(n_tokens, 2)), ENTROPY_BITS)
    rows = []
    for i, (text, lang) in enumerate(zip(texts, langs)):
        text = text or b""
        n = int(sizes[i])
        chars = sum(map(len, docs[i])) - sum(len(w) - len(w.translate(None, _CONTINUATION)) for w in docs[i] if not w.isascii())
        repeats = repeated_words(numbers[ends[i] - n:ends[i]])
        failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
        low, high, most_bytes, least_entropy = (bands.get(lang) if lang else None) or SCRIPT_BANDS.get(script(text)) or bands[None]
        per_token = chars / n_tokens[i] if n_tokens[i] else 0.0
        kept = not failed and low <= per_token <= high and byte_share[i] <= most_bytes and entropy[i] >= least_entropy
        rows.append((n, chars, len(text) - len(text.translate(None, SYMBOLS)), duplicate_lines(text), repeats,
                     int(n_tokens[i]), per_token, float(byte_share[i]), float(entropy[i]), failed, bool(kept)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in METRICS.split(", ")])


def fertility(docs: DataFrame, model_path: str, text: str = "text", lang: str = "lang",
              bands: dict | None = None, into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into`` of the figures and verdicts (``METRICS``)."""
    tune(docs.sparkSession)
    bands = bands or BANDS

    @F.pandas_udf(METRICS)
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        table, is_byte = worker_memory(f"quality {model_path}", lambda: _sentencepiece(model_path))
        for texts, langs in batches:
            yield _measure(texts, langs, table, is_byte, bands)

    return docs.withColumn(into, measure(F.col(text).cast("binary"), F.col(lang).cast("string")))


def keep_good(docs: DataFrame, model_path: str, **options) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    name = free_name(docs, "quality")
    return fertility(docs, model_path, into=name, **options).where(F.col(name)["kept"]).select(*docs.columns)
