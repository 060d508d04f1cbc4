"""Abusive, hateful or sexual content: dense features, boosted trees, isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distributed import require_at_most
from . import lexicon as lx

#: Labelled documents the model is fitted on, those with the smallest hash of their id.
MAX_LABELLED = 20_000
#: A passage ends where so many words in a row hold none of the lexicon's.
GAP = 9
#: Parts of the labelled documents, each scored by what the others taught.
FOLDS = 4
#: Words kept in a worker's table before it is emptied.
MEMO = 500_000

_KINDS = ("INSULT", "AIMED", "SCORN", "SEXUAL", "INTIMATE", "VIOLENCE", "DEHUMANISING", "GROUPS", "SECOND_PERSON", "LEARNED", "HIDDEN", "CAPITALS", "LOUD", "LETTER", "TALK", "AIM", "FIRST")
BIT = {k: 1 << i for i, k in enumerate(_KINDS)}
_CONTENT = sum(BIT[k] for k in _KINDS[:10]) - BIT["SECOND_PERSON"] + BIT["AIM"]
_GRAVE = BIT["INSULT"] | BIT["AIMED"] | BIT["SEXUAL"] | BIT["LEARNED"] | BIT["HIDDEN"] | BIT["AIM"]
_BITS = np.array([BIT[k] for k in _KINDS[:13]])
FEATURES = (
    *("insult", "aimed", "scorn", "sexual", "intimate", "violence", "dehumanising", "groups", "second_person", "learned", "hidden", "capitals", "loud"),
    *("length", "insult_at_you", "harm_at_you", "hate", "aimed_talk", "hits"),
    *("doc_insult", "doc_sexual", "doc_violence", "doc_dehumanising", "doc_second_person", "doc_hidden", "doc_capitals", "doc_loud"),
)
_HITS = FEATURES.index("hits")
_PRONOUNS = frozenset("they them these those diese sie ils elles ceux ellos ellas esos estos".split())
_DEMONYM = re.compile(r"(?:ans|ites|ese|ish|ists|aris|ims|ari|aner|iten|isten|esen|länder|linge|ais|ois|iens|istes|anos|eses|istas|itas|enses|folk|leute)$").search


class Reader:
    """Turns a text into the features of its passage with most hits and of the whole.

    ``learned`` are words and pairs of neighbouring words (``"a b"``) that labelled documents showed to be abusive; each
    has the bits of the folds it may be used in.

    Each distinct word is looked up once. A word is compared in its plain form: compatibility
    forms and letters of look-alike scripts as Latin, invisible marks dropped, single letters that
    are joined by marks put together, digits and signs that stand for letters as these, stretched
    letters shortened, starred letters matched by ends and length; and with one letter lost, doubled
    or swapped. Words that need any of these count as hidden.
    """

    def __init__(self, learned: dict[str, int] | None = None):
        import re
        import unicodedata

        self.learned = learned or {}
        self.firsts = {t.split(" ")[0] for t in self.learned}

        self.normal = lambda s: unicodedata.normalize("NFKC", s).casefold()
        self.re = re
        # Letters of other scripts that look like Latin ones (fixed values).
        self.alike = str.maketrans("аеорсухікһјѕԁԛԝӏвнмтгοαερυικτνν", "aeopcyxikhjsdqwlbhmtroaepuiktvv")
        self.invisible = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
        self.leet = str.maketrans("013457@$!|€+", "oieastasiiet")
        self.edges = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "*@$") + "«»„“”‘’…¡¿–—█"
        self.kinds: dict[str, int] = {}
        for k in _KINDS[:9]:
            for w in getattr(lx, k):
                self.kinds[w] = self.kinds.get(w, 0) | BIT[k]
        for w in lx.PESTS | lx.BLIGHT | lx.HUMAN | lx.BREED | lx.BELONG | lx.HARMED | lx.HARM | lx.KNOW | lx.HOPE | lx.NEED | lx.FINISH:
            self.kinds[w] = self.kinds.get(w, 0) | BIT["TALK"]
        strong = {w for k in ("INSULT", "SCORN", "SEXUAL", "DEHUMANISING", "GROUPS", "VIOLENCE", "INTIMATE") for w in getattr(lx, k)}
        self.long = {w for w in strong if len(w) >= 6}
        self.lost: dict[str, str] = {}
        for w in sorted(self.long):
            for i in range(len(w)):
                self.lost.setdefault(w[:i] + w[i + 1 :], w)
        self.masked: dict[tuple[str, str, int], str] = {(w[0], w[-1], len(w)): w for w in sorted(set(lx.INSULT) | set(lx.SCORN) | set(lx.AIMED) | set(lx.SEXUAL), reverse=True) if len(w) > 3}
        reader = self

        class Memo(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= MEMO:
                    self.clear()
                    reader.plain.clear()
                n, plain = reader.look(word)
                reader.plain[word] = plain
                self[word] = n = n | (BIT["FIRST"] if plain in reader.firsts else 0)
                return n

        self.plain: dict[str, str] = {}
        self.memo = Memo()

    def known(self, w: str) -> str | None:
        """The lexicon's word that ``w`` is, perhaps with one letter lost, added or two swapped."""
        if w in self.kinds:
            return w
        if len(w) >= 5:
            if w in self.lost:
                return self.lost[w]
            for i in range(len(w)):
                if i + 1 < len(w) and (x := w[:i] + w[i + 1] + w[i] + w[i + 2 :]) in self.long:
                    return x
                if len(w) >= 7 and (x := w[:i] + w[i + 1 :]) in self.long:
                    return x
        return None

    def look(self, raw: str) -> tuple[int, str]:
        """Kinds of a word, and its plain form."""
        w = self.normal(raw)
        bits = BIT["LOUD"] if "!" in raw[-3:] else 0
        letters = [c for c in raw if c.isalpha()]
        if len(letters) > 3 and raw.upper() == raw:
            bits |= BIT["CAPITALS"]
        bare = w.strip(self.edges)
        if len(bare) == 1 and bare.isalpha():
            return bits | BIT["LETTER"], bare
        if found := self.kinds.get(bare):
            return bits | found, bare
        for tail in ("'s", "’s", "'ll", "'re", "'d", "'ve"):
            if bare.endswith(tail) and (found := self.kinds.get(bare[: -len(tail)])):
                return bits | found, bare[: -len(tail)]
        plain = bare.translate(self.invisible).translate(self.alike)
        hidden = plain != bare and bare.isalpha() or any(ord(c) in self.invisible for c in bare)
        if "*" in plain and len(plain) > 3 and plain[0].isalpha() and plain[-1].isalpha() and set(plain[1:-1]) == {"*"}:
            if word := self.masked.get((plain[0], plain[-1], len(plain))):
                return bits | BIT["HIDDEN"] | self.kinds[word], word
        if len(plain) >= 5 and self.re.fullmatch(r"(?:[^\W_][.\-_]){2,}[^\W_]", plain):
            plain, hidden = self.re.sub(r"[.\-_]", "", plain), True
        if any(c.isalpha() for c in plain) and any(c in "0134579@$!|€+" for c in plain):
            plain, hidden = plain.translate(self.leet), True
        if short := self.re.sub(r"(.)\1{2,}", r"\1", plain):
            hidden = hidden or short != plain
            doubled = self.re.sub(r"(.)\1{2,}", r"\1\1", plain)
            for form in (short, doubled):
                if word := self.known(form):
                    return bits | self.kinds[word] | (BIT["HIDDEN"] if hidden else 0), word
        return bits, bare

    def terms(self, text: str | None) -> set[str]:
        """Plain words of two letters and more and pairs of neighbouring ones, from which terms are learned."""
        words = (text or "").split()
        for w in words:
            self.memo[w]
        plain = [self.plain.get(w) or self.look(w)[1] for w in words]
        return {w for w in plain if len(w) > 1} | {f"{a} {b}" for a, b in zip(plain, plain[1:]) if a and b}

    def __call__(self, text: str | None, fold: int = FOLDS) -> list[float]:
        words = (text or "").split()
        out = np.zeros(len(FEATURES), dtype="float32")
        if not words:
            return out.tolist()
        codes = np.fromiter(map(self.memo.__getitem__, words), dtype="int64", count=len(words))
        words, codes = self.spelled(words, codes)
        per = 1000.0 / max(len(words), 100)
        for i, k in enumerate(("INSULT", "SEXUAL", "VIOLENCE", "DEHUMANISING", "SECOND_PERSON", "HIDDEN", "CAPITALS", "LOUD")):
            out[_HITS + 1 + i] = np.count_nonzero(codes & BIT[k]) * per
        for t in np.flatnonzero(codes & BIT["TALK"]).tolist():
            if self.aimed(words, t):
                codes[t] |= BIT["AIM"]
        for t in np.flatnonzero(codes & BIT["FIRST"]).tolist():
            plain = self.plain.get(words[t], words[t])
            pair = f"{plain} {self.plain.get(words[t + 1], words[t + 1])}" if t + 1 < len(words) else plain
            if (self.learned.get(plain, 0) | self.learned.get(pair, 0)) >> fold & 1:
                codes[t] |= BIT["LEARNED"]
        at = np.flatnonzero(codes & _CONTENT)
        if not len(at):
            return out.tolist()
        best = -1.0
        grave = (codes[at] & _GRAVE) > 0
        start = 0
        for end in (*(np.flatnonzero(np.diff(at) > GAP) + 1).tolist(), len(at)):
            # A lone word that is common elsewhere makes no passage.
            if end - start > 1 or grave[start]:
                lo, hi = max(0, at[start] - 4), min(len(words), at[end - 1] + 5)
                f = self.passage(words[lo:hi], codes[lo:hi])
                if f[-1] > best:
                    best = f[-1]
                    out[: _HITS + 1] = f
            start = end
        return out.tolist()

    def spelled(self, words: list[str], codes: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Words written as single letters with spaces are put together."""
        letter = (codes & BIT["LETTER"]) > 0
        if not (letter[:-3] & letter[1:-2] & letter[2:-1] & letter[3:]).any():
            return words, codes
        out, run = [], []
        for w, is_letter in zip([*words, ""], [*letter.tolist(), False]):
            if is_letter:
                run.append(w)
                continue
            if len(run) >= 4 and (word := self.known("".join(self.look(x)[1] for x in run))):
                out.append((word, self.kinds[word] | BIT["HIDDEN"]))
            else:
                out += [(x, self.memo[x]) for x in run]
            run = []
            if w:
                out.append((w, self.memo[w]))
        return [w for w, _ in out], np.array([c for _, c in out], dtype="int64")

    def aimed(self, words: list[str], t: int) -> bool:
        """Whether word ``t`` dehumanises a group, calls for harm to it, or threatens the reader, by the form of its sentence.

        The group need not be known: any people, plural or capitalised word will do as subject, if what is said is plain enough.
        """
        lo, hi = t, t + 1
        while lo > 0 and t - lo < 9 and words[lo - 1][-1:] not in ".!?;:":
            lo -= 1
        while hi < len(words) and hi - t < 9 and words[hi - 1][-1:] not in ".!?;:":
            hi += 1
        raw, t = words[lo:hi], t - lo
        low = [self.plain.get(w) or w.strip(self.edges).casefold() for w in raw]
        w, before, after = low[t], low[:t], low[t + 1 :]
        if w in lx.PESTS or w in lx.BLIGHT:
            j = t - 1
            while j >= 0 and low[j] not in lx.ARE and (low[j] in lx.FILLER or low[j] in lx.SCORN):
                j -= 1
            if j > 0 and low[j] in lx.ARE and self.subject(raw, low, max(0, j - 4), j, plural=w in lx.PESTS):
                return True
        if w in lx.HUMAN and before and before[-1] in lx.NOTHING and self.subject(raw, low, 0, len(low), plural=False):
            return True
        if w in lx.HUMAN and any(x in lx.NOT for x in before[-3:]):
            j = max((i for i in range(max(0, t - 5), t) if low[i] in lx.ARE), default=0)
            if j and self.subject(raw, low, max(0, j - 4), j, plural=True):
                return True
        if w in lx.FINISH and any(x in lx.JOB for x in after[:3]):
            j = max((i for i in range(t) if low[i] in lx.OUGHT), default=t)
            if self.subject(raw, low, j, t, plural=False):
                return True
        if w in lx.BREED and any(x in lx.LIKE for x in after[:2]) and self.subject(raw, low, max(0, t - 4), t, plural=True):
            return True
        if w in lx.BELONG and (any(x in lx.PLACES or x in lx.HARMED for x in after[:5])) and self.subject(raw, low, max(0, t - 4), t, plural=False):
            return True
        if w in lx.HARMED and any(x in lx.OUGHT for x in before[-6:]) and self.subject(raw, low, 0, len(low), plural=False, skip=lx.OUGHT | {w}, named=True):
            return True
        if w in lx.HARM and after and after[0] in lx.ALL and "to" not in before[-1:] and self.subject(raw, low, t + 1, min(len(low), t + 5), plural=False, named=True):
            return True
        you = lambda x: x in lx.SECOND_PERSON
        if w in lx.KNOW and not any(x in lx.NOT for x in before[-2:] + after[:1]) and any(x in lx.WHERE for x in after[:2]) and any(map(you, after[1:5])):
            return True
        if w in lx.HOPE and any(map(you, after[:3])) and any(x in lx.ILL for x in after[:7]):
            return True
        return w in lx.NEED and any(x in lx.FUNERAL for x in after[:3] + before[-3:])

    def subject(self, raw: list[str], low: list[str], a: int, b: int, plural: bool, skip: frozenset[str] | set[str] = frozenset(), named: bool = False) -> bool:
        """A word of a to b that stands for people: known ones, a capitalised word inside the sentence, with ``plural`` any plural; with ``named`` no pronoun."""
        if any(x in lx.BEASTS for x in low[a:b]):
            return False
        for i in range(a, b):
            x = low[i]
            if x in skip or x in lx.PESTS or x in lx.NOT or x in lx.NOBODY and i == b - 1 or len(x) < 3:
                continue
            if (x in lx.PEOPLE or x in lx.GROUPS or x.endswith(("folk", "people", "leute"))) and not (named and len(x) <= 5 and x in _PRONOUNS):
                return True
            # Nouns of German are all capitalised; there a group is told from a thing by its ending.
            capital = raw[i].strip(self.edges)[:1].isupper() and (i > 0 or plural) and len(x) > 3
            if capital and (not named or _DEMONYM(x)):
                return True
            if plural and len(x) > 3 and (x.endswith("s") or i > 0 and low[i - 1] in lx.ALL) and i >= b - 3 and x not in lx.SCORN:
                return True
        return False

    def passage(self, words: list[str], codes: np.ndarray) -> list[float]:
        n = dict(zip(_KINDS, np.count_nonzero(codes[:, None] & _BITS, axis=0).tolist()))
        you = n["SECOND_PERSON"] > 0
        insult_at_you = float(min(n["INSULT"] + n["AIMED"] + n["SCORN"], 4) * you)
        harm_at_you = float(min(n["VIOLENCE"], 4) * you)
        hate = float(min(n["GROUPS"], 3) * min(n["DEHUMANISING"] + n["VIOLENCE"] + n["INSULT"], 3))
        aimed = float(min(np.count_nonzero(codes & BIT["AIM"]), 2))
        hits = float(np.count_nonzero(codes & _CONTENT))
        return [*(float(n[k]) for k in _KINDS[:13]), float(min(len(words), 200)), insult_at_you, harm_at_you, hate, aimed, hits]


def abuse_features(text: Column | str, learned: dict[str, int] | None = None, fold: Column | None = None) -> Column:
    """Dense features of each whole text (see ``FEATURES``); null and empty texts have zeros.

    ``fold`` names the terms of ``learned`` that may be used: those learned without the document's own fold, or all (``FOLDS``, the default).
    """

    @F.pandas_udf("array<float>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        reader = Reader(learned)
        for texts, folds in batches:
            yield pd.Series([reader(t, k) for t, k in zip(texts, folds)], dtype=object)

    return read(text, F.lit(FOLDS) if fold is None else fold)


def labelled_documents(labels: DataFrame, *, id_col: str = "doc_id", label: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """At most ``max_labelled`` labelled ids, those with the smallest hash: ``y``, the mean of the labels that are not null, and ``fold``."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.avg(label).alias("y")).withColumn("_h", F.xxhash64(id_col))
    return known.orderBy("_h", id_col).limit(max_labelled).select(id_col, "y", F.pmod("_h", F.lit(FOLDS)).cast("int").alias("fold"))


def learned_terms(documents: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: int = 3, share: float = 0.6) -> dict[str, int]:
    """Words and pairs of words that are found in abusive documents and hardly in others, with the bits of the folds they may be used in.

    A term counts if ``least`` documents labelled abusive have it and the share of these among all labelled documents
    that have it is above ``share`` by its lower confidence bound (one standard deviation). Bit k is set if that holds without the documents
    of fold k, bit ``FOLDS`` if it holds with all; so features of labelled documents never rest on their own labels.
    Only labelled documents are read, of which there are at most as many as ``labelled_documents`` takes; their terms are counted by an aggregate.
    """

    @F.pandas_udf("array<string>")
    def terms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader()
        for texts in batches:
            yield pd.Series([sorted(reader.terms(t)) for t in texts], dtype=object)

    chosen = documents.select(id_col, F.col(text).alias("_text")).join(F.broadcast(labelled), id_col)
    each = chosen.select("y", "fold", F.explode(terms("_text")).alias("term"))
    folds = range(FOLDS)
    bad = F.col("y") >= 0.5
    counts = each.groupBy("term").agg(*[F.count_if(bad & (F.col("fold") == k)).alias(f"b{k}") for k in folds], *[F.count_if(~bad & (F.col("fold") == k)).alias(f"g{k}") for k in folds])

    def holds(left_out: int) -> Column:
        b = sum((F.col(f"b{k}") for k in folds if k != left_out), F.lit(0))
        n = F.greatest(b + sum((F.col(f"g{k}") for k in folds if k != left_out), F.lit(0)), F.lit(1))
        p = b / n
        return (b >= least) & ((p + 1 / (2 * n) - F.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n) >= share)

    bits = sum((F.when(holds(k), 1 << k).otherwise(0) for k in range(FOLDS + 1)), F.lit(0))
    return {r.term: r.bits for r in counts.where(sum((F.col(f"b{k}") for k in folds), F.lit(0)) >= least).select("term", bits.alias("bits")).where("bits > 0").collect()}


def edges_of(x: np.ndarray, bins: int) -> np.ndarray:
    """Ends of bins: quantiles of all values and of those that are not 0, since most features are 0 in most documents."""
    grid = np.linspace(0, 1, bins + 1)[1:-1]
    parts = [np.quantile(v, grid) for v in (x, x[x != 0]) if len(v)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0)


_COUNTED = [FEATURES.index(k) for k in ("insult", "sexual", "aimed_talk", "insult_at_you", "hate", "learned")]


def untrained(x: np.ndarray) -> np.ndarray:
    """Where there are no labels at all: a margin from the number of insults, sexual terms and statements about groups."""
    return np.clip(2 * x[:, _COUNTED].sum(axis=1) - 3, -4, 4)


class Booster:
    """Gradient-boosted trees with logistic loss.

    The first learner is the isotonic regression of the labels on the number of hits: with few and noisy labels it errs
    less than a tree.
    """

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.1, least: float = 6.0, ridge: float = 4.0, bins: int = 32):
        self.trees, self.depth, self.rate, self.least, self.ridge, self.bins = trees, depth, rate, least, ridge, bins

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Booster:
        self.edges = [edges_of(x[:, j], self.bins) for j in range(x.shape[1])]
        b = self.binned(x)
        self.knots = isotonic(x[:, _COUNTED].sum(axis=1), y, w)
        margin = self.start(x)
        self.forest = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree: dict[int, tuple[int, int] | float] = {}
            node = np.zeros(len(x), dtype="int64")
            self.grow(tree, 0, b, (p - y) * w, np.maximum(p * (1 - p), 1e-6) * w, w, np.arange(len(x)), node)
            self.forest.append(tree)
            margin = margin + self.rate * self.leaf(tree, b)
        return self

    def start(self, x: np.ndarray) -> np.ndarray:
        p = np.clip(np.interp(x[:, _COUNTED].sum(axis=1), *self.knots), 0.01, 0.99)
        return np.log(p / (1 - p))

    def grow(self, tree, k, b, g, h, w, rows, node) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        tree[k] = float(-total_g / (total_h + self.ridge))
        if k >= 2**self.depth - 1:
            return
        best = (1e-3, -1, -1)
        for j in range(b.shape[1]):
            size = len(self.edges[j]) + 1
            if size < 2:
                continue
            col = b[rows, j]
            gl, hl, wl = (np.cumsum(np.bincount(col, v[rows], size))[:-1] for v in (g, h, w))
            ok = (wl >= self.least) & (w[rows].sum() - wl >= self.least)
            gain = np.where(ok, gl**2 / (hl + self.ridge) + (total_g - gl) ** 2 / (total_h - hl + self.ridge) - total_g**2 / (total_h + self.ridge), -1)
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
        if best[1] >= 0:
            _, j, cut = best
            tree[k] = (j, cut)
            left = b[rows, j] <= cut
            self.grow(tree, 2 * k + 1, b, g, h, w, rows[left], node)
            self.grow(tree, 2 * k + 2, b, g, h, w, rows[~left], node)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def leaf(self, tree, b: np.ndarray) -> np.ndarray:
        out, parts = np.zeros(len(b)), [(0, np.arange(len(b)))]
        while parts:
            k, rows = parts.pop()
            if isinstance(tree[k], float):
                out[rows] = tree[k]
            else:
                j, cut = tree[k]
                left = b[rows, j] <= cut
                parts += [(2 * k + 1, rows[left]), (2 * k + 2, rows[~left])]
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.start(x) + self.rate * sum((self.leaf(t, b) for t in self.forest), np.zeros(len(x)))


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, probability), to be interpolated."""
    each, place = np.unique(score, return_inverse=True)
    total = np.bincount(place, w)
    blocks: list[list[float]] = []
    for s, v, n in zip(each, np.bincount(place, w * y) / np.maximum(total, 1e-12), total):
        blocks.append([v * n, n, s * n])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


class Scorer:
    """Boosted trees and the isotonic curve over their held-out margins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, fold: np.ndarray, folds: int = FOLDS):
        # Made-up points of little weight keep the curve sound where labels are few.
        grid = np.linspace(-4, 4, 17)
        held = untrained(x)
        for k in range(folds):
            if (fold == k).any() and (fold != k).any():
                held[fold == k] = Booster().fit(x[fold != k], y[fold != k], w[fold != k]).margin(x[fold == k])
        self.held = held
        self.model = Booster().fit(x, y, w) if len(y) else None
        self.knots = isotonic(np.concatenate([held, grid]), np.concatenate([y, 1 / (1 + np.exp(-grid))]), np.concatenate([w, np.full(len(grid), 2.0)]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        margin = self.model.margin(x) if self.model else untrained(x)
        return np.interp(margin, *self.knots)


def abuse_scores(featured: DataFrame, *, id_col: str = "doc_id", features: str = "features", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``featured`` with ``score``: the calibrated probability that the text holds abusive content.

    ``featured`` has ``y`` and ``fold`` of ``labelled_documents`` (null if not labelled); the model is fitted on those, at most
    ``max_labelled``. Without any the lexicon's own scale gives the score. Documents are all scored. ``featured`` is read
    twice: pass a table or a checkpoint.
    """
    rows = sorted(require_at_most(labelled_rows(featured, id_col, features), max_labelled, "labelled documents"), key=lambda r: (r.fold, r[id_col]))
    x = np.array([r.x for r in rows], dtype="float64").reshape(len(rows), len(FEATURES))
    scorer = Scorer(x, np.array([r.y for r in rows], dtype="float64"), np.ones(len(rows)), np.array([r.fold for r in rows], dtype="int64"))  # some kilobytes, whatever the number of documents

    @F.pandas_udf("double")
    def scored(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        return pd.Series(scorer(np.stack(vectors.to_list()).astype("float64")))

    return featured.withColumn("score", scored(features))


def labelled_rows(featured: DataFrame, id_col: str = "doc_id", features: str = "features") -> DataFrame:
    """One row per labelled document; repeated rows of one id count once."""
    return featured.where("y IS NOT NULL").groupBy(id_col, "y", "fold").agg(F.first(features).alias("x"))


def abuse_rates(scored: DataFrame, by: str, threshold: float) -> DataFrame:
    """Per ``by``: documents, those at or above ``threshold``, their rate, and the mean score."""
    hit = F.count_if(F.col("score") >= threshold)
    return scored.groupBy(by).agg(F.count(F.lit(1)).alias("n_documents"), hit.alias("n_found"), (hit / F.count(F.lit(1))).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))
