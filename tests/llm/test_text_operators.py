"""Operators that answer per document, against brute force on the hard cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from claimlake.llm import bpe, lm_score, pii, quality, queries, secret_scan
from claimlake.llm.common import vocabulary
from tests.llm import frames


@pytest.fixture(scope="module")
def docs(spark):
    return frames.clashing(frames.frame(spark)).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frames.frame(spark, [])


def by_text(found, *names):
    """Answers as sorted lists, so that null and repeated ids compare too."""
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def test_quality(spark, docs, nothing):
    path = vocabulary("piece_bpe_32k.model")
    found = quality.fertility(docs, path, into="q")
    assert "quality" in found.columns and found.columns[:-1] == docs.columns
    for r in found.collect():
        w, q = frames.words(r["text"]), r["q"]
        lines = [x for x in (r["text"] or "").split("\n") if frames.words(x)]
        windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        assert (q["n_words"], q["word_chars"]) == (len(w), sum(map(len, w)))
        assert q["n_symbols"] == len(re.findall(r"[#*$%&|<>]", r["text"] or ""))
        assert (q["n_dup_lines"], q["n_repeat_words"]) == (len(lines) - len(set(lines)), len(inside))
        assert q["base_failed"] == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert not (q["base_failed"] and q["kept"])
    kept = quality.keep_good(docs, path)
    assert kept.columns == docs.columns
    assert quality.fertility(nothing, path).count() == 0


PROSE = {
    "en": "The committee met on Thursday to discuss the new budget for the public library. Several members asked whether the "
          "opening hours could be extended during the summer, when many children visit the reading room with their parents.",
    "fr": "Le comité s'est réuni jeudi pour discuter du nouveau budget de la bibliothèque publique. Plusieurs membres ont demandé "
          "si les heures d'ouverture pouvaient être prolongées pendant l'été, lorsque de nombreux enfants visitent la salle.",
    "de": "Der Ausschuss traf sich am Donnerstag, um über den neuen Haushalt der öffentlichen Bücherei zu sprechen. Mehrere "
          "Mitglieder fragten, ob die Öffnungszeiten im Sommer verlängert werden könnten, wenn viele Kinder den Lesesaal besuchen.",
    "es": "El comité se reunió el jueves para hablar del nuevo presupuesto de la biblioteca pública. Varios miembros preguntaron "
          "si el horario podría ampliarse durante el verano, cuando muchos niños visitan la sala de lectura con sus padres.",
}


def test_plain_prose_is_kept(spark):
    rng = np.random.default_rng(3)
    noise = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(60))
    data = [(i, text, lang, "src", len(text)) for i, (lang, text) in enumerate(PROSE.items())] + [(9, noise, "en", "src", len(noise))]
    kept = quality.keep_good(frames.frame(spark, data), vocabulary("piece_bpe_32k.model"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3]


SCRIPTS = {
    "zh": "我们 昨天 一起 去 图书馆 看书 ， 然后 在 附近 的 餐厅 吃 晚饭 。 老师 说 这个 城市 的 历史 很 长 ， 每年 有 许多 游客 来 这里 参观 古老 的 建筑 。",
    "ja": "私たち は 昨日 図書館 で 本 を 読んで から 近く の 食堂 で 夕食 を 食べました 。 毎年 多く の 観光客 が 古い 建物 や 博物館 を 見 に 来ます 。",
    "ko": "우리는 어제 함께 도서관에 가서 책을 읽고 근처 식당에서 저녁을 먹었다 . 선생님은 이 도시의 역사가 매우 길다고 말씀하셨다 . "
          "해마다 많은 관광객이 오래된 건물과 박물관을 보러 온다 . 날씨가 좋으면 아이들은 공원에서 논다 .",
    "hi": "हम कल साथ में पुस्तकालय गए और फिर पास के भोजनालय में रात का खाना खाया । अध्यापक ने कहा कि इस शहर का इतिहास बहुत लंबा है ।",
    "th": "เมื่อวาน เรา ไป ห้องสมุด ด้วยกัน เพื่อ อ่าน หนังสือ แล้ว กิน อาหาร เย็น ที่ ร้าน ใกล้ ๆ ครู บอก ว่า ประวัติศาสตร์ ของ เมือง นี้ ยาว มาก",
    "ru": "Вчера мы вместе ходили в библиотеку читать книги, а потом ужинали в соседнем ресторане. Учитель сказал, что история этого "
          "города очень длинная, и каждый год многие туристы приезжают посмотреть старые здания.",
    "ar": "ذهبنا أمس معا إلى المكتبة لقراءة الكتب ثم تناولنا العشاء في مطعم قريب . قال المعلم إن تاريخ هذه المدينة طويل جدا وفي كل عام "
          "يأتي كثير من السياح لمشاهدة المباني القديمة والمتاحف .",
}


def test_plain_prose_of_other_scripts_is_kept(spark):
    broken = " ".join(SCRIPTS["ru"].encode().decode("latin-1").split())     # read in a wrong encoding
    texts = [(text, lang) for lang, text in SCRIPTS.items()] + [(text, None) for text in SCRIPTS.values()]
    data = [(i, text, lang, "src", len(text)) for i, (text, lang) in enumerate(texts)]
    data += [(90, broken, "en", "src", len(broken)), (91, SCRIPTS["zh"], "en", "src", 9), (92, "我 " * 60, "zh", "src", 120)]
    kept = quality.keep_good(frames.frame(spark, data), vocabulary("piece_bpe_32k.model"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(len(texts)))
    assert [quality.script(t.encode()) for t in SCRIPTS.values()] == ["cjk", "cjk", "hangul", "indic", "thai", None, None]
    assert quality.script("plain words with 我".encode()) is None and quality.script(b"\xff\xfe") is None


def test_language_model(spark, docs, nothing):
    rows = lm_score.scored(docs).collect()
    data = frames.rows()
    tokens = [[w.encode() for w in frames.words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + [b""] for _, t, *_ in data]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in data]
    count = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, kinds = sum(count.values()), len(count)
    want = sorted((i is None, i or 0, h, len(ws), sum(w in count for w in ws), total,
                   round(sum(math.log10((count[w] + .5) / (total + .5 * (kinds + 1))) for w in ws), 6))
                  for (i, *_), ws, h in zip(data, tokens, held))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                 for r in rows)
    assert got == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm_score.scored(nothing).count() == 0


def test_model_is_normalised():
    model, every = lm_score.Model.start(np.full(lm_score.CLASSES, 1 / lm_score.CLASSES)), np.arange(lm_score.CLASSES)
    for far, near in ((0, 1), (5, 2), (400, 511)):
        logs = model.log10_of(np.full(len(every), far), np.full(len(every), near), every)
        assert np.isclose((10 ** logs).sum(), 1, atol=1e-4)


def brute_pii(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_personal_data(spark, docs, nothing):
    found = pii.found_spans(docs)
    got = sorted((repr(r["doc_id"]), [(s["start"], s["kind"], s["end"]) for s in r["base"]]) for r in found.collect())
    assert got == sorted((repr(i), brute_pii(t or "")) for i, t, *_ in frames.rows())
    assert pii.found_spans(nothing).count() == 0


def test_long_runs_are_linear():
    assert pii.candidates("a" * 300_000 + "@") == []
    assert [c[0] for c in pii.candidates("1" * 300_000 + ".1.1")] == ["card"]
    assert pii.candidates("9" * 5000 + ".1.1.1")[0][3] is False


def test_boosted_trees_separate():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(pii.FEATURES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] > 0.3)).astype(float)
    model = pii.BoostedTrees().fit(x[:400], y[:400])
    assert ((model.probability(x[400:]) > 0.5) == y[400:].astype(bool)).mean() > 0.95


def test_bpe_round_trip(spark, docs, nothing):
    import tiktoken

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encoded(docs, path, P.PATTERN)
    rows = found.select("doc_id", "ids", bpe.decoded(found["ids"], path).alias("raw")).collect()
    got = sorted((repr(r["doc_id"]), list(r["ids"]), bytes(r["raw"])) for r in rows)
    assert got == sorted((repr(i), encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in frames.rows())
    assert bpe.encoded(nothing, path, P.PATTERN).count() == 0


def test_long_words_merge_alike():
    import tiktoken

    ranks = bpe.read_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    word = "theandingouéßñ" * 40
    assert np.frombuffer(bpe.merge_long(word.encode(), ranks), "<u4").tolist() == encoding.encode_ordinary(word)


def brute_secrets(x):
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 32])


def test_secrets(spark, docs, nothing):
    found = secret_scan.scanned(docs)
    got = sorted((repr(r["doc_id"]), [(s["start"], s["kind_no"], s["kind"], s["end"]) for s in r["spans"] if s["kind_no"] < 3])
                 for r in found.collect())
    assert got == sorted((repr(i), brute_secrets(t or "")) for i, t, *_ in frames.rows())
    assert secret_scan.scanned(nothing).count() == 0
    kept = secret_scan.redacted(docs)
    assert kept.columns == docs.columns and kept.count() == len(frames.rows())


def test_copied_examples_stay_and_live_values_go(spark):
    copied, live = "password=EXAMPLEvalue123", "token=9f8e7d6c5b4a39281706"
    data = [(i, f"see {copied} here", "en", f"src{i}", 9) for i in range(6)] + [(9, f"use {live}, {live}!", "en", "src1", 9)]
    rows = {r["doc_id"]: r for r in secret_scan.redacted(frames.frame(spark, data)).collect()}
    assert rows[0]["text"] == f"see {copied} here"
    assert rows[9]["text"] == f"use token={secret_scan.MARK}, token={secret_scan.MARK}!"
    assert rows[9]["n_chars"] == len(rows[9]["text"])


def test_short_live_values_go_and_runs_stay(spark):
    rng = np.random.default_rng(4)
    alphabets = ["0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    live = {"".join(rng.choice(list(a), n)) for a in alphabets for n in (8, 9, 10, 12, 16, 40) for _ in range(20)}
    live |= {"hunter22", "20241001", "a1b2a1b2"}
    runs = ["aaaaaaaa", "00000000", "xxxx-xxxx", "0000000000000000", "1212121212", "ab" * 20]
    data = [(i, f"password={v} end", "en", f"src{i % 9}", 9) for i, v in enumerate([*sorted(live), *runs])]
    data += [(1000 + i, "token=k3k3y4y4 end", "en", f"src{i}", 9) for i in range(secret_scan.MOST_OWNERS)]
    data += [(2000 + i, "token=c0c0p1p1 end", "en", f"src{i}", 9) for i in range(secret_scan.MOST_OWNERS + 1)]
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redacted(frames.frame(spark, data)).collect()}
    for i, before, *_ in data:
        stays = i >= 2000 or before.split("=")[1].split()[0] in runs
        assert texts[i] == (before if stays else re.sub("=[^ ]+", f"={secret_scan.MARK}", before))
    spans = [s for r in secret_scan.scanned(frames.frame(spark, data)).collect() for s in r["spans"] if s["kind"] == "assign"]
    assert sum(s["live"] for s in spans) == len(live) + secret_scan.MOST_OWNERS


def test_digest_columns(spark):
    """The thin query gives hashes of the spans in their documented form."""
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_secret_scan(spark, sf).collect():
        spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute_secrets(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()


def test_trees_see_every_candidate(spark, monkeypatch):
    """More candidates than the 20,000 of the former sample: the trees are those that all rows at once give."""
    import pandas as pd
    rng = np.random.default_rng(4)
    x = np.repeat(rng.integers(0, 6, (400, len(pii.FEATURES))), 60, axis=0).astype(float)  # 24,000 rows
    y = (x[:, 0] > 2) & (x[:, 3] < 4)
    out = np.arange(len(y)) % 10 < 3
    found = spark.createDataFrame(pd.DataFrame({"x": x.tolist(), "y": y, "out": out}), "x array<float>, y boolean, out boolean")
    monkeypatch.setattr(pii, "TREES", 3)
    model, threshold = pii.calibrated(found)
    whole = pii.BoostedTrees().fit(x[~out], y[~out].astype(float))
    assert np.allclose(model.probability(x), whole.probability(x)) and threshold >= pii.GRID // 2
    assert all((a == b).all() for a, b in zip(model.edges, whole.edges))
