"""Personal data by candidate gradient boosting.

Four fixed kinds (mail and network addresses, payment cards, phones) are found by
pattern and check.  Generators with high recall propose further spans, which may
overlap: national phone numbers, social-security numbers, bank accounts, hidden
mail addresses, hardware addresses.  Boosted trees judge every candidate by
features of its format and context; a threshold calibrated on candidates that the
trees have not seen selects the spans to add.  Fixed spans always stay, and added
spans overlap neither them nor each other.

Documents are scanned once, whole; candidates with their features are staged, and
the trees are fitted on all of them: equal feature vectors are counted, binned and
counted again, and every level of a tree is chosen from histograms that the tasks
sum over their share of the counted vectors.  The labels are weak: a candidate of a fixed kind counts as personal data if
it passes that kind's check and stands free of letters and digits, one of a further
kind if it passes its own format check and a word of its kind stands before it.

Defined cases: null and empty texts have no spans; repeated rows are answered each
for itself; candidates of one label only give no added spans; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune

HELD_OUT = 0.3          # share of the candidates that calibrates the threshold
GRID = 10_000           # steps of a probability that the threshold tells apart
PRECISION = 0.99        # of the selected candidates held out
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32
CONTEXT = 32            # characters before a candidate that count as its context

# The base kinds in order, then the kinds that the generators add.
BASE_KINDS = ["email", "ip", "card", "phone"]
MORE_KINDS = ["national", "ssn", "iban", "hidden", "hardware"]
KINDS = BASE_KINDS + MORE_KINDS

# Patterns.  Possessive where the plain form could try again in vain.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GENERATORS = [
    ("national", re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z])")),
    ("ssn", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("hardware", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Za-z:])")),
]
HIDDEN = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]{1,63}){1,5}", re.I)
CUES = {
    "email": ("mail", "contact"), "ip": ("ip", "host", "address"), "card": ("card", "visa", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "national": ("phone", "tel", "call", "mobile", "fax"),
    "ssn": ("ssn", "social"), "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "hidden": ("mail", "contact"), "hardware": ("mac", "hardware", "ethernet"),
}

SPAN = "array<struct<kind:int,start:int,end:int>>"
FEATURES = ["length", "digits", "letters", "separators", "runs", "longest_run", "shortest_run", "distinct", "plus",
            "valid", "cue", "free_before", "free_after", "context_digits"]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ outwards (long runs are walked once)."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            at += 1


def _valid(kind: str, found: str) -> bool:
    digits = _digits(found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "national":
        return 9 <= len(digits) <= 12
    if kind == "ssn":
        return found[:3] not in ("000", "666") and found[0] != "9" and found[4:6] != "00" and found[7:] != "0000"
    if kind == "iban":
        plain = found.replace(" ", "")
        return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    return True


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of all that patterns and generators propose."""
    out = []
    if "@" in text:
        out += [("email", a, b, True) for a, b in emails(text)]
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE), *GENERATORS):
            if kind != "phone" or "+" in text:
                out += [(kind, m.start(), m.end(), _valid(kind, m[0])) for m in pattern.finditer(text)]
    if "at]" in (low := text.lower()) or "at)" in low or "at ]" in low or "at )" in low:
        out += [("hidden", m.start(), m.end(), True) for m in HIDDEN.finditer(text)]
    return out


def features(text: str, kind: str, start: int, end: int, valid: bool) -> list[float]:
    found, before = text[start:end], text[max(0, start - CONTEXT):start].lower()
    runs = [len(r) for r in re.findall(r"[0-9]+", found)] or [0]
    digits = sum(runs)
    letters = sum(c.isalpha() for c in found)
    return [end - start, digits, letters, end - start - digits - letters, len(runs), max(runs), min(runs), len(set(found)),
            found[:1] == "+", valid, any(w in before for w in CUES[kind]),
            not (start and text[start - 1].isalnum()), not (end < len(text) and text[end].isalnum()),
            sum(c.isdigit() for c in before)]


def weak_label(kind: str, x: list[float]) -> bool:
    at = dict(zip(FEATURES, x))
    good = bool(at["valid"] and at["free_before"] and at["free_after"])
    return good if kind in BASE_KINDS else bool(good and at["cue"])


class BoostedTrees:
    """Logistic gradient boosting of small trees over binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            score += self._walk(tree, binned)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)

    def _grow(self, x, g, h, at, depth):
        """A leaf's value, or (feature, bin, low branch, high branch) by the best gain."""
        total_g, total_h = g[at].sum(), h[at].sum()
        leaf = RATE * total_g / (total_h + 1.0)
        if not depth or len(at) < 20:
            return leaf
        best = (1e-6, None, None)
        for f in range(x.shape[1]):
            size = len(self.edges[f]) + 1
            low_g = np.cumsum(np.bincount(x[at, f], g[at], size))[:-1]
            low_h = np.cumsum(np.bincount(x[at, f], h[at], size))[:-1]
            if len(low_g):
                gain = low_g ** 2 / (low_h + 1) + (total_g - low_g) ** 2 / (total_h - low_h + 1) - total_g ** 2 / (total_h + 1)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], f, i)
        if best[1] is None:
            return leaf
        low = x[at, best[1]] <= best[2]
        return best[1], best[2], self._grow(x, g, h, at[low], depth - 1), self._grow(x, g, h, at[~low], depth - 1)

    def _walk(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._walk(low, x), self._walk(high, x))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.binned_probability(self._bin(x))

    def binned_probability(self, binned: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.base + sum(self._walk(t, binned) for t in self.trees))))

    def steps(self, binned: np.ndarray) -> np.ndarray:
        """Probabilities on the threshold's grid."""
        return np.floor(self.binned_probability(binned) * GRID).astype(int)


def split_gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Gain of cutting after each bin but the last; ``g`` and ``h``: sums by feature and bin."""
    low_g, low_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
    total_g, total_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    return low_g ** 2 / (low_h + 1) + (total_g - low_g) ** 2 / (total_h - low_h + 1) - total_g ** 2 / (total_h + 1)


def _places(binned: np.ndarray, cuts: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node of a growing tree that each row lies in: 1 the root, 2n and 2n + 1 below n."""
    at = np.ones(len(binned), int)
    for node in sorted(cuts):
        f, cut = cuts[node]
        here = at == node
        at[here] = 2 * node + (binned[here, f] > cut)
    return at


def _grown(vectors: DataFrame, model: BoostedTrees, rate: float):
    """One tree over all counted vectors; the driver adds up the tasks' histograms of at most four nodes."""
    cuts: dict[int, tuple[int, int]] = {}
    leaves: dict[int, float] = {}
    nodes = [1]
    for depth in range(DEPTH):
        wanted, known = list(nodes), dict(cuts)

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(wanted), 3, len(FEATURES), BINS))
            for rows in batches:
                x = np.array(rows["b"].tolist(), int).reshape(len(rows), len(FEATURES))
                n, positive = rows["n"].to_numpy(float), rows["positive"].to_numpy(float)
                p = model.binned_probability(x)
                at = _places(x, known)
                for i, node in enumerate(wanted):
                    here = at == node
                    for part, v in enumerate((positive - n * p, n * p * (1 - p), n)):
                        for f in range(len(FEATURES)):
                            total[i, part, f] += np.bincount(x[here, f], v[here], BINS)
            yield pd.DataFrame({"sums": [total.ravel()]})

        total = sum(np.array(r["sums"]) for r in vectors.mapInPandas(sums, "sums array<double>").collect())
        total = np.reshape(total, (len(wanted), 3, len(FEATURES), BINS))
        nodes = []
        for node, (g, h, n) in zip(wanted, total):
            gain = split_gain(g, h)
            f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if n[0].sum() < 20 or gain[f, cut] <= 1e-6:
                leaves[node] = rate * g[0].sum() / (h[0].sum() + 1.0)
                continue
            cuts[node] = (int(f), int(cut))
            for child, part in ((2 * node, slice(None, cut + 1)), (2 * node + 1, slice(cut + 1, None))):
                leaves[child] = rate * g[f, part].sum() / (h[f, part].sum() + 1.0)
                nodes.append(child)

    def built(node: int):
        return (*cuts[node], built(2 * node), built(2 * node + 1)) if node in cuts else float(leaves[node])
    return built(1)


def calibrated(found: DataFrame) -> tuple[BoostedTrees, float] | None:
    """Trees fitted on all candidates (x, y, out) but those held out, and the lowest threshold that holds
    ``PRECISION`` on these; None without both labels."""
    counts = [F.sum("n").alias("n"), F.sum("positive").alias("positive")]
    vectors = staged(found.groupBy("x", "out").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("positive")), "pii-vectors")
    labels = {r["out"]: (r["n"], r["positive"]) for r in vectors.groupBy("out").agg(*counts).collect()}
    if any(out not in labels or not 0 < labels[out][1] < labels[out][0] for out in (False, True)):
        return None
    cuts = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
    spread = vectors.where("NOT out").select(F.posexplode("x").alias("feature", "value"), "n").groupBy("feature").agg(
        F.percentile("value", F.lit(cuts), F.col("n")).alias("cuts")).orderBy("feature").collect()  # one row per feature
    rate = np.clip(labels[False][1] / labels[False][0], 1e-3, 1 - 1e-3)
    model = BoostedTrees()
    model.edges, model.base, model.trees = [np.unique(r["cuts"]) for r in spread], float(np.log(rate / (1 - rate))), []

    @F.pandas_udf("array<tinyint>")
    def binned(x: pd.Series) -> pd.Series:
        return pd.Series(list(model._bin(np.array(x.tolist(), float).reshape(len(x), len(FEATURES))).astype(np.int8)))

    bins = staged(vectors.select(binned("x").alias("b"), "out", "n", "positive").groupBy("b", "out").agg(*counts), "pii-bins")
    fitted_on = bins.where("NOT out")
    for _ in range(TREES):
        model.trees.append(_grown(fitted_on, model, RATE))

    @F.pandas_udf("int")
    def step(b: pd.Series) -> pd.Series:
        return pd.Series(model.steps(np.array(b.tolist(), int).reshape(len(b), len(FEATURES))))

    by_step = bins.where("out").select(step("b").alias("step"), "n", "positive").groupBy("step").agg(*counts).collect()  # at most GRID + 1 rows
    by_step.sort(key=lambda r: -r["step"])
    precision = np.cumsum([r["positive"] for r in by_step]) / np.cumsum([r["n"] for r in by_step])
    able = np.flatnonzero(precision >= PRECISION)
    return (model, max(GRID // 2, by_step[able[-1]]["step"])) if len(able) else None


def found_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base and added: spans of the fixed kinds and spans that the trees select, by start, then kind."""
    tune(docs.sparkSession)
    scan_type = f"base {SPAN}, more array<struct<kind:int,start:int,end:int,y:boolean,x:array<float>>>"

    @F.pandas_udf(scan_type)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            base, more = [], []
            for t in texts:
                proposed = candidates(t) if t else []
                fixed = sorted((a, KINDS.index(k), b) for k, a, b, ok in proposed if ok and k in BASE_KINDS)
                base.append([{"kind": k, "start": a, "end": b} for a, k, b in fixed])
                judged = []
                for k, a, b, ok in proposed:
                    x = [float(v) for v in features(t, k, a, b, ok)]
                    judged.append({"kind": KINDS.index(k), "start": a, "end": b, "y": weak_label(k, x), "x": x})
                more.append(judged)
            yield pd.DataFrame({"base": base, "more": more})

    rows = staged(docs.select(F.col(key), scan(F.col(text).cast("string")).alias("found")).select(key, "found.*"), "pii")
    out = F.pmod(F.xxhash64("k", "kind", "start"), F.lit(10)) < int(10 * HELD_OUT)
    model = calibrated(rows.select(F.col(key).alias("k"), F.explode("more").alias("c")).select("k", "c.*").select("x", "y", out.alias("out")))

    @F.pandas_udf(SPAN)
    def select(base: pd.Series, more: pd.Series) -> pd.Series:
        trees, threshold = model
        out = []
        for fixed, proposed in zip(base, more):
            new = [c for c in proposed if c["kind"] >= len(BASE_KINDS)]
            if new:
                x = trees._bin(np.array([c["x"] for c in new], float))
                p, able = trees.binned_probability(x), trees.steps(x) >= threshold
                taken = [(s["start"], s["end"]) for s in fixed]
                chosen = []
                for i in sorted(range(len(new)), key=lambda i: (-p[i], new[i]["start"], new[i]["kind"])):
                    a, b = new[i]["start"], new[i]["end"]
                    if able[i] and all(b <= s or e <= a for s, e in taken):
                        taken.append((a, b))
                        chosen.append({"kind": new[i]["kind"], "start": a, "end": b})
                out.append(sorted(chosen, key=lambda c: (c["start"], c["kind"])))
            else:
                out.append([])
        return pd.Series(out)

    empty = F.array().cast(SPAN)
    further = F.exists("more", lambda c: c["kind"] >= len(BASE_KINDS))
    added = F.when(further, select("base", "more")).otherwise(empty) if model else empty
    return rows.select(key, "base", added.alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
