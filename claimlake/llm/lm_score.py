"""Text scores from a log-bilinear language model trained with noise-contrastive estimation.

Words fall into classes: the most frequent words are classes of their own, all others
share classes by their ending.  The model predicts the class of each token from the
classes of the two before it: a position-weighted sum of their vectors, times the
vector of the class, plus a bias.  It is trained in numpy against noise drawn from the
class frequencies, over all training texts: every task trains on its own texts from
the same start, and the tasks' models are averaged, weighted by their tokens.  Scoring
normalises over all classes, with one batched matrix product per batch over the
distinct contexts in it.  A word's share within its class comes from exact corpus
counts, with one unseen word per shared class.

Counts of the most frequent words go to every worker (at most ``FREQUENT`` words of at
most ``LONG`` bytes); all other words meet their counts in a join, once per document
and word.

Defined cases: null and empty texts consist of the end token; a null document id trains;
repeated rows train and are scored each for itself; without training text every count
is zero and the model knows nothing but its classes; an empty table gives an empty
result; columns other than the key and the text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune, words_of

FREQUENT = 200_000      # words whose counts every worker holds, at most
LONG = 64               # bytes of such a word, at most
TOP = 384               # words that are classes of their own, at most
SHARED = 128            # classes of the other words, by ending
CLASSES = TOP + SHARED
WIDTH = 24              # of the vectors
NOISE = 64              # noise samples a minibatch shares
MINIBATCH = 4_096
RATE = 0.1
CONTEXTS = 2_048        # contexts normalised at a time
LIMIT = 200_000         # words a worker keeps facts of
END = b""               # the end token; words are never empty


def shared_class(word: bytes) -> int:
    """The class of a word that has none of its own: by its last two bytes and whether it is plain ASCII."""
    return TOP + zlib.crc32(word[-2:] + (b"a" if word.isascii() else b"u")) % SHARED


def tokens_of(text: bytes | None) -> list[bytes]:
    words = words_of(text.lower() if text else None)
    words.append(END)
    return words


class Model:
    """Context vectors r, class vectors w, position weights c, biases b."""

    def __init__(self, r: np.ndarray, w: np.ndarray, c: np.ndarray, b: np.ndarray):
        self.r, self.w, self.c, self.b = r, w, c, b

    @classmethod
    def start(cls, frequency: np.ndarray) -> "Model":
        """Small fixed vectors; the biases are the classes' log frequencies, so that training starts from them."""
        rng = np.random.default_rng(7)
        draw = lambda n: rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32)
        return cls(draw(CLASSES), draw(CLASSES), np.ones((2, WIDTH), np.float32), np.log(frequency).astype(np.float32))

    def dumps(self) -> bytes:
        return np.concatenate([self.r.ravel(), self.w.ravel(), self.c.ravel(), self.b]).astype("<f4").tobytes()

    @classmethod
    def loads(cls, raw: bytes) -> "Model":
        flat, n = np.frombuffer(raw, "<f4").copy(), CLASSES * WIDTH
        return cls(flat[:n].reshape(CLASSES, WIDTH), flat[n:2 * n].reshape(CLASSES, WIDTH),
                   flat[2 * n:2 * n + 2 * WIDTH].reshape(2, WIDTH), flat[2 * n + 2 * WIDTH:])

    def predicted(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        return self.r[far] * self.c[0] + self.r[near] * self.c[1]

    def log10_of(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 probability of each target after its context, normalised over all classes.

        The sum over the classes is taken once per distinct context, ``CONTEXTS`` at a time."""
        context, place = np.unique(far * CLASSES + near, return_inverse=True)
        hat = self.predicted(context // CLASSES, context % CLASSES)
        whole = np.empty(len(context), np.float32)
        for at in range(0, len(context), CONTEXTS):
            scores = hat[at:at + CONTEXTS] @ self.w.T
            scores += self.b
            top = scores.max(1)
            np.exp(np.subtract(scores, top[:, None], out=scores), out=scores)
            whole[at:at + CONTEXTS] = np.log(scores.sum(1)) + top
        out = np.empty(len(target))
        for at in range(0, len(target), 1 << 16):
            part, chosen = place[at:at + (1 << 16)], target[at:at + (1 << 16)]
            out[at:at + (1 << 16)] = np.einsum("ij,ij->i", hat[part], self.w[chosen]) + self.b[chosen] - whole[part]
        return out / math.log(10)


class ClassOf(dict):
    """The class of each word, computed once while ``LIMIT`` words are held."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__()
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > LIMIT:
            self.clear()
        found = self.own.get(word)
        found = self[word] = shared_class(word) if found is None else found
        return found


class WordFacts(dict):
    """Numbers for words, and by number: class, log10 base share, log10 share within the class, known (in ``counts``)."""

    def __init__(self, counts: dict[bytes, int], own: dict[bytes, int], base_whole: float, class_whole: np.ndarray):
        super().__init__()
        self.counts, self.class_of, self.base_whole, self.class_whole = counts, ClassOf(own), base_whole, class_whole
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.words: list[bytes] = []
        self.of, self.base, self.inner, self.known = (np.zeros(2 * LIMIT, t) for t in (np.int32, float, float, bool))

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        if n == len(self.of):  # a batch with very many words
            self.of, self.base, self.inner, self.known = (np.concatenate([x, np.zeros_like(x)]) for x in (self.of, self.base, self.inner, self.known))
        self.words.append(word)
        self.of[n] = k = self.class_of[word]
        c = self.counts.get(word)
        if c is not None:
            self.known[n], self.base[n] = True, math.log10((c + 0.5) / self.base_whole)
            if k >= TOP:
                self.inner[n] = math.log10((c + 0.5) / self.class_whole[k])
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) > LIMIT:
            self.forget()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Trainer:
    """Noise-contrastive estimation by minibatches, with a step size per parameter (Adagrad)."""

    def __init__(self, model: Model, frequency: np.ndarray, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.log_noise = (np.log(frequency) + math.log(NOISE)).astype(np.float32)
        self.cumulative = np.cumsum(frequency)
        self.sums = [np.full_like(p, 1e-6) for p in (model.r, model.w, model.c, model.b)]

    def _step(self, k: int, parameter: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        self.sums[k][at] += gradient * gradient
        parameter[at] += RATE * gradient / np.sqrt(self.sums[k][at])

    def learn(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> None:
        m, n = self.m, len(target)
        hat = m.predicted(far, near)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1], side="right").clip(0, CLASSES - 1)
        # data against noise: the weights say how far each is from being told apart
        data = 1 / (1 + np.exp((hat * m.w[target]).sum(1) + m.b[target] - self.log_noise[target]))
        false = -1 / (1 + np.exp(-(hat @ m.w[noise].T + m.b[noise] - self.log_noise[noise])))
        d_hat = data[:, None] * m.w[target] + false @ m.w[noise]
        d_w = _sum_rows(target, data[:, None] * hat)
        d_b = np.bincount(target, data, CLASSES)
        np.add.at(d_w, noise, false.T @ hat)
        np.add.at(d_b, noise, false.sum(0))
        d_r = _sum_rows(far, d_hat * m.c[0]) + _sum_rows(near, d_hat * m.c[1])
        d_c = np.stack([(d_hat * m.r[far]).sum(0), (d_hat * m.r[near]).sum(0)])
        for k, (parameter, gradient) in enumerate(((m.r, d_r), (m.w, d_w), (m.c, d_c), (m.b, d_b))):
            self._step(k, parameter, (gradient / n).astype(np.float32))


def _sum_rows(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    out = np.zeros((CLASSES, rows.shape[1]), np.float32)
    out[at[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _contexts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class two before, class before, class) of every token; before a text stands the end token's class, 0."""
    target = np.concatenate(docs)
    near = np.concatenate([np.concatenate([[0], d[:-1]]) for d in docs])
    far = np.concatenate([np.concatenate([[0, 0], d[:-2]])[:len(d)] for d in docs])
    return far, near, target


def is_held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens; ``texts`` has the binary column text."""

    def counted(seen: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens_of(text))
            if len(seen) > 300_000:
                yield counted(seen)
                seen = Counter()
        yield counted(seen)

    return texts.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, limit: int) -> dict[bytes, int]:
    """The words above the lowest count level that leaves at most ``limit`` of them."""
    level = F.floor(F.log2(F.col("n")) * 8)
    short = counts.where(F.octet_length("word") <= LONG)
    held, least = 0, None
    for r in sorted(short.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["level"]):
        held += r["words"]
        if held > limit:
            break
        least = r["level"]
    if least is None:
        return {}
    table = short.where(level >= F.lit(least)).toArrow()  # at most ``limit`` short words
    return dict(zip(table["word"].to_pylist(), table["n"].to_pylist()))


def _averaged(texts: DataFrame, own: dict[bytes, int], frequency: np.ndarray) -> Model:
    """Every task's model after its training texts, averaged in two steps."""
    start = Model.start(frequency).dumps()

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model.loads(start)
        trainer, tokens, kept = Trainer(model, frequency, 11), 0, []

        def learn(docs: list[np.ndarray]) -> None:
            far, near, target = _contexts(docs)
            order = np.random.default_rng(len(target)).permutation(len(target))
            for at in range(0, len(target), MINIBATCH):
                part = order[at:at + MINIBATCH]
                trainer.learn(far[part], near[part], target[part])

        class_of = ClassOf(own)
        for batch in batches:
            for text in batch["text"]:
                words = tokens_of(text)
                kept.append(np.fromiter(map(class_of.__getitem__, words), np.int64, len(words)))
                tokens += len(words)
            if sum(map(len, kept)) >= 16 * MINIBATCH:
                learn(kept)
                kept = []
        if kept:
            learn(kept)
        if tokens:
            yield pd.DataFrame({"tokens": [tokens], "model": [model.dumps()]})

    def average(rows: pd.DataFrame) -> pd.DataFrame:
        weights = rows["tokens"].to_numpy(float)
        mixed = sum(w * np.frombuffer(m, "<f4").astype(float) for w, m in zip(weights / weights.sum(), rows["model"]))
        return pd.DataFrame({"tokens": [int(weights.sum())], "model": [mixed.astype("<f4").tobytes()]})

    schema = "tokens long, model binary"
    models = staged(texts.mapInPandas(train, schema), "models")
    groups = max(1, math.isqrt(models.count()))  # so neither step holds more than about the square root
    some = models.groupBy(F.pmod(F.xxhash64("model"), F.lit(groups)).alias("g")).applyInPandas(lambda rows: average(rows), schema)
    # one model per group of the first step, at most the square root of the tasks
    last = staged(some, "averages").toPandas()
    return Model.loads(average(last)["model"][0]) if len(last) else Model.loads(start)


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: Column | None = None) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) of each text."""
    spark = tune(docs.sparkSession)
    held_out = is_held_out(F.col(key)) if held_out is None else held_out
    training = docs.where(~held_out).select(F.col(text).cast("binary").alias("text"))
    counts = staged(word_counts(training), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = _frequent(counts, FREQUENT)
    # the end token is class 0; then the words by falling count
    own = {w: i for i, w in enumerate([END, *(w for w in sorted(frequent, key=lambda w: (-frequent[w], w)) if w != END)][:TOP])}

    def class_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"of": [own[w] if w in own else shared_class(w) for w in batch["word"]], "n": batch["n"]})

    sums, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.mapInPandas(class_sums, "of int, n long").groupBy("of").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        sums[r["of"]], kinds[r["of"]] = r["n"], r["v"]
    frequency = (sums + 0.5) / (sums + 0.5).sum()
    model = _averaged(training, own, frequency)
    base_whole = total + 0.5 * (distinct + 1)
    # within its class: certain for a class of one word, else smoothed like the base, with one unseen word
    class_whole = np.where(np.arange(CLASSES) < TOP, 0.0, sums + 0.5 * (kinds + 1))
    parts = spark.sparkContext.broadcast((frequent, own, model.dumps()))

    @F.pandas_udf("n_tokens long, known long, base double, score double, rare array<binary>, times array<int>, of array<int>")
    def local(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts, own, raw = parts.value
        model, facts = Model.loads(raw), WordFacts(counts, own, base_whole, class_whole)
        for texts in batches:
            docs = [tokens_of(t) for t in texts]
            sizes = np.fromiter(map(len, docs), np.int64, len(docs))
            number = facts.numbers([w for d in docs for w in d])
            doc = np.repeat(np.arange(len(docs)), sizes)
            target = facts.of[number].astype(np.int64)
            logs = model.log10_of(*_contexts(np.split(target, np.cumsum(sizes)[:-1])))
            known = facts.known[number]
            # words without a count here: once per document
            pair, times = np.unique(doc[~known] * len(facts.of) + number[~known], return_counts=True)
            owner, word = pair // len(facts.of), pair % len(facts.of)
            cuts = np.searchsorted(owner, np.arange(1, len(docs)))
            yield pd.DataFrame({
                "n_tokens": sizes,
                "known": np.bincount(doc, known, len(docs)).astype(np.int64),
                "base": np.bincount(doc, facts.base[number], len(docs)),
                "score": np.bincount(doc, logs + facts.inner[number], len(docs)),
                "rare": [[facts.words[i] for i in part] for part in np.split(word, cuts)],
                "times": np.split(times.astype(np.int32), cuts),
                "of": np.split(facts.of[word], cuts)})

    here = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), held_out.alias("held_out"),
                              local(F.col(text).cast("binary")).alias("m")).select("row", "key", "held_out", "m.*"), "scored")
    rare = here.select("row", F.explode(F.arrays_zip("rare", "times", "of")).alias("r")) \
        .select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"), F.col("r.of").alias("of"))
    c = F.coalesce(F.col("n"), F.lit(0))
    whole = F.get(F.array(*[F.lit(float(x)) for x in class_whole[TOP:]]), F.col("of") - TOP)
    sums_of = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(float(base_whole)))).alias("more_base"),
        F.sum(F.when(F.col("of") >= TOP, F.col("times") * F.log10((c + 0.5) / whole)).otherwise(0.0)).alias("more_score"))
    return here.join(sums_of, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
