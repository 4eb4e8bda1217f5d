"""Toxicity: a learned lexicon, misspellings found by Levenshtein automata, and the context of each hit."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import batches, map_rows, materialize, slices, table

#: The model is fitted on this many labelled rows of either kind at most, those with the least hash of their doc_id.
TOXIC_ROWS, OTHER_ROWS = 3_000, 12_000
STEMS = (4, 5, 6, 7, 8)
#: A term must be in so many contexts of toxic texts, be so much more frequent there, and so surely.
CONTEXTS, RATIO, EVIDENCE = 3, 20.0, 15.0
FUZZY, QUOTED = 0.8, 0.1
CACHE_WORDS = 300_000
#: Terms that a task counts before it hands its counts on.
HELD_TERMS = 200_000

_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|*#$%&-_/\\~`^=+…“”„«»‘’‹›—–"
_OPEN, _CLOSE = "\"“„«‹", "\"”“»›"
#: Words that report speech or speak about words, and words that address someone, in the four languages of the corpus.
REPORTS = frozenset("said says wrote called word words term phrase quote quoted quotes insult insults slur means meaning definition sagte schrieb nannte wort begriff zitat zitierte bedeutet dit écrit appelé mot terme citation signifie dijo escribió llamó palabra término cita significa".split())
ADDRESSES = frozenset("you your yours you're u ur du dein deine dich ihr euch tu toi ton ta vous votre tú eres usted vosotros ustedes".split())


class Trie:
    """Words, and stems that any word may begin with."""

    def __init__(self, words=(), stems=()):
        self.root: dict = {}
        for kind, terms in (("", words), ("*", stems)):
            for term in terms:
                node = self.root
                for c in term:
                    node = node.setdefault(c, {})
                node[" " + kind] = term + kind

    def near(self, word: str, edits: int) -> tuple[str, int] | None:
        """The term nearest to ``word`` within ``edits`` (0 or 1), and its distance.

        The automaton of ``word`` accepts what one insertion, deletion, substitution or swap of neighbours
        makes of it. Bit i of a state is set if the first i letters are used up; ``exact`` is the state
        without an edit, ``edited`` that after one, ``swap`` that halfway through a swap. It runs down the
        trie as far as a state is alive. A character that is no letter stands for any letter.
        """
        n, masks, blank = len(word), {}, 0
        for i, c in enumerate(word):
            if c.isalpha():
                masks[c] = masks.get(c, 0) | 1 << i
            else:
                blank |= 1 << i
        end, best = 1 << n, None
        todo = [(self.root, 1, 3 if edits else 0, 0)]
        while todo:
            node, exact, edited, swap = todo.pop()
            for c, below in node.items():
                if c[0] == " ":
                    if c == " *":
                        distance = 0 if exact else 1 if edited else 2
                    else:
                        distance = 0 if exact & end else 1 if edited & end else 2
                    if distance <= edits and (best is None or (distance, below) < (best[1], best[0])):
                        best = below, distance
                    continue
                mask = masks.get(c, 0) | blank
                now = (exact & mask) << 1
                then = 0
                if edits:
                    then = (edited & mask) << 1 | exact << 1 | exact | now << 1 | (swap & mask) << 2
                if now or then:
                    todo.append((below, now, then & (2 * end - 1), exact & mask >> 1 if edits else 0))
        return best


class Lexicon:
    """Looks up words: exactly, as a stem, or misspelled."""

    def __init__(self, weights: dict[str, float], innocent: frozenset[str] = frozenset(), strict: frozenset[str] = frozenset()):
        """weights: of words, and of stems, which end in a star; innocent: words that are no misspellings; strict: terms
        that have too many of these near them, so only their own spelling counts."""
        words, stems = [t for t in weights if t[-1] != "*"], [t[:-1] for t in weights if t[-1] == "*"]
        self.weights, self.words, self.stems, self.innocent, self.strict = weights, frozenset(words), stems, innocent, strict
        self.exact = Trie(words, stems)
        long = [w for w in words if len(w) >= 5 and w not in strict]
        self.fuzzy = Trie(long)  # what follows a stem is free, so a stem must be exact
        # an edit can't change both the first two and the last two letters of five or more
        self.heads, self.tails = frozenset(w[:2] for w in long), frozenset(w[-2:] for w in long)
        self.starts = frozenset(w[:3] for w in [*words, *stems])
        self.longest = max([0, *map(len, words)]) + 1
        self.cache: dict[str, tuple[str, int] | None] = {}

    def find(self, raw: str) -> tuple[str, int] | None:
        """(term, edits) of a stretch between spaces."""
        try:
            return self.cache[raw]
        except KeyError:
            found = self._find(raw.strip(_EDGE).lower())
            if len(self.cache) < CACHE_WORDS:
                self.cache[raw] = found
            return found

    def _find(self, word: str) -> tuple[str, int] | None:
        if len(word) < 4 or not self.words and not self.stems:
            return None
        plain = word.isalpha()
        if plain:
            if word in self.words:
                return word, 0
            if word[:3] in self.starts and (hit := self.exact.near(word, 0)):
                return hit
            if word in self.innocent or not (word[:2] in self.heads or len(word) <= self.longest and word[-2:] in self.tails):
                return None
            return self.fuzzy.near(word, 1)
        letters = sum(map(str.isalpha, word))
        if 2 * letters <= len(word) or len(word) > self.longest + 2 or word in self.innocent:
            return None
        if hit := self.exact.near(word, 0):
            return hit[0], 1
        return self.fuzzy.near(word, 1)

    def hits(self, text: str) -> list[tuple[int, str, int]]:
        """(place among the words, term, edits) of each hit."""
        find = self.find
        return [(i, *hit) for i, raw in enumerate(text.split()) if (hit := find(raw)) is not None]


def quotation(words: list[str], at: int, reach: int = 8) -> float:
    """How surely the word at ``at`` is quoted, 0 to 1, from the words around it."""
    low, high = max(0, at - 30), min(len(words), at + 31)
    before = sum(w[0] in _OPEN for w in words[low : at + 1] if w) - sum(w[-1] in _CLOSE or w.rstrip(".,;:!?")[-1:] in tuple(_CLOSE) for w in words[low:at] if len(w) > 1)
    after = any(w.rstrip(".,;:!?")[-1:] in tuple(_CLOSE) for w in words[at:high] if w)
    inside = before > 0 and after
    near = [w.strip(_EDGE).lower() for w in words[max(0, at - reach) : at + reach + 1]]
    reports = sum(w in REPORTS for w in near)
    score = (0.7 if inside else 0.0) + 0.25 * min(2, reports)
    if any(w in ADDRESSES for w in near) and not inside:
        score /= 2
    return min(1.0, score)


def abuse(text: str | None, lexicon: Lexicon) -> tuple[float, int, int, float]:
    """(weight of all hits, exact hits, misspelled hits, sum of quotation scores)"""
    found = lexicon.hits(text) if text else []
    if not found:
        return 0.0, 0, 0, 0.0
    words = text.split()
    total = quoted = 0.0
    for at, term, edits in found:
        q = quotation(words, at)
        quoted += q
        total += lexicon.weights[term] * (FUZZY if edits else 1.0) * (1 - (1 - QUOTED) * q)
    fuzzy = sum(e > 0 for _, _, e in found)
    return total, len(found) - fuzzy, fuzzy, quoted


def _terms(word: str) -> Iterator[str]:
    yield word
    for k in STEMS:
        if len(word) > k:
            yield word[:k] + "*"


def _clean(text: str | None) -> list[str]:
    return [w for raw in (text or "").split() if (w := raw.strip(_EDGE).lower())]


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of labelled rows that are not held out: a bounded number of either kind."""
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    taken = known.where("toxic = 1").orderBy(order, "doc_id").limit(TOXIC_ROWS).unionByName(known.where("toxic = 0").orderBy(order, "doc_id").limit(OTHER_ROWS))
    taken = taken.withColumnRenamed("doc_id", "_id")
    return materialize(docs.select("doc_id", "text").join(F.broadcast(taken), F.col("doc_id") == F.col("_id")).select("text", "toxic"), "labelled")


def learn(rows: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and (intercept, slope) of the score, from text and toxic."""
    context = pa.schema([("term", pa.string()), ("context", pa.int64())])

    def contexts(part):
        def pairs():
            seen: set = set()
            for batch in part:
                for (text,) in slices(batch, ["text"]):
                    words = _clean(text)
                    for a, w, b in zip(["", *words], words, [*words[1:], ""]):
                        if 4 <= len(w) <= 40 and w.isalpha():
                            around = hash_of(a + " " + b)
                            for t in _terms(w):
                                if (t, around) not in seen:
                                    if len(seen) < 500_000:
                                        seen.add((t, around))
                                    yield t, around

        import xxhash

        def hash_of(x):
            return xxhash.xxh64_intdigest(x) >> 1

        return batches(pairs(), context, step=1 << 14)

    many = rows.where("toxic = 1").select("text").mapInArrow(contexts, "term string, context long").distinct().groupBy("term").count().where(F.col("count") >= CONTEXTS)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Lexicon({}), np.array([np.log((n_toxic + 0.5) / (n_other + 0.5)), 0.0])
    count = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])

    def counted(part, of):
        def told():
            total = (Counter(), Counter())
            for batch in part:
                for text, toxic in slices(batch, ["text", "toxic"]):
                    total[toxic == 0].update(of(text))
                    if len(total[0]) + len(total[1]) > HELD_TERMS:
                        yield from ((t, total[0][t], total[1][t]) for t in total[0].keys() | total[1].keys())
                        total = (Counter(), Counter())
            yield from ((t, total[0][t], total[1][t]) for t in total[0].keys() | total[1].keys())

        return batches(told(), count, step=1 << 13)

    def table_of(of) -> DataFrame:
        return rows.mapInArrow(lambda part: counted(part, of), "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))

    # the terms of the contexts above, each with its texts; only what can be chosen comes to the driver
    told = table_of(lambda text: {t for w in set(_clean(text)) if 4 <= len(w) <= 40 for t in _terms(w)}).join(many.select("term"), "term", "left_semi")
    stats = {r.term: (r.toxic, r.other) for r in told.where(telling(n_toxic, n_other)).collect()}
    chosen = choose(stats, n_toxic, n_other)
    draft = Lexicon(chosen)

    def misspelled(text):
        """Near words, and after a space the terms that they are near to."""
        found = [(raw.strip(_EDGE).lower(), hit[0]) for raw in set((text or "").split()) if (hit := draft.find(raw)) and hit[1]]
        return {w for w, _ in found} | {" " + t for _, t in found}

    near = [(r.term, r.toxic, r.other) for r in table_of(misspelled).collect()]  # no more terms than there are near words

    def doubtful(a, b, ratio):
        return b and (a + 0.5) / n_toxic < ratio * (b + 0.5) / n_other

    innocent = frozenset(t for t, a, b in near if t[0] != " " and doubtful(a, b, 5))
    strict = frozenset(t[1:] for t, a, b in near if t[0] == " " and doubtful(a, b, RATIO))
    lexicon = Lexicon(chosen, innocent, strict)
    points = map_rows(rows, lambda text: (abuse(text, lexicon)[0],), ["text"], pa.schema([("x", pa.float64())]), "x double", ["toxic"])
    binned = points.groupBy(F.round("x", 1).alias("x"), "toxic").count().orderBy("x", "toxic").collect()
    return lexicon, logistic([(r.x, r.toxic, r["count"]) for r in binned])


def telling(n_toxic: int, n_other: int) -> F.Column:
    """RATIO and EVIDENCE of ``choose`` over toxic and other, with room for rounding."""
    a, b, n = F.col("toxic"), F.col("other"), n_toxic + n_other
    out = F.lit(0.0)
    for x, rows, cell in ((a, n_toxic, a + b), (n_toxic - a, n_toxic, n - a - b), (b, n_other, a + b), (n_other - b, n_other, n - a - b)):
        out = out + F.when(x > 0, 2 * x * F.log(x * F.lit(float(n)) / (F.lit(float(rows)) * cell))).otherwise(0.0)
    return ((a + 0.5) / n_toxic / ((b + 0.5) / n_other) >= RATIO * (1 - 1e-9)) & (out >= EVIDENCE * (1 - 1e-9))


def choose(stats: dict[str, tuple[int, int]], n_toxic: int, n_other: int) -> dict[str, float]:
    """Words and stems* that tell toxic texts, of (toxic, other) texts with each term, and their weights.

    A weight is near 1 for a term that is in many toxic texts and no other. Of a stem and its continuations the longer is taken if it is in nine tenths of the stem's texts, else
    the stem alone.
    """

    def evidence(a, b):
        n, out = n_toxic + n_other, 0.0
        for x, rows, cell in ((a, n_toxic, a + b), (n_toxic - a, n_toxic, n - a - b), (b, n_other, a + b), (n_other - b, n_other, n - a - b)):
            out += 2 * x * np.log(x * n / (rows * cell)) if x else 0
        return out

    good = {}
    for t, (a, b) in stats.items():
        ratio = (a + 0.5) / n_toxic / ((b + 0.5) / n_other)
        if ratio >= RATIO and evidence(a, b) >= EVIDENCE:
            good[t] = a
    dropped = set()
    for stem in sorted((t for t in good if t[-1] == "*"), key=lambda t: (len(t), t)):
        if stem in dropped:
            continue
        longer = [t for t in good if t != stem and t not in dropped and t.startswith(stem[:-1]) and len(t.rstrip("*")) >= len(stem[:-1])]
        if any(good[t] >= 0.9 * good[stem] for t in longer):
            dropped.add(stem)
        else:
            dropped.update(longer)

    def weight(a, b):
        return float(a / (a + 4) * (1 - (b / n_other) / (a / n_toxic)))

    return {t: weight(*stats[t]) for t in sorted(good.keys() - dropped)}


def logistic(points: list[tuple[float, int, int]], ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    """(intercept, slope) of the log odds over log1p(x), by Newton's method."""
    x = np.array([[1.0, np.log1p(p[0])] for p in points])
    y, n = np.array([p[1] for p in points], float), np.array([p[2] for p in points], float)
    beta, penalty = np.zeros(2), np.diag([1e-6, ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(2), x.T @ (n * (y - p)) - penalty @ beta)
        beta = np.clip(beta + step, -25, 25)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, lexicon: Lexicon, beta: np.ndarray, carry=("doc_id",)) -> DataFrame:
    """score (0 to 1), predicted, and the hits behind it, beside the columns in ``carry``.

    A null or empty text has no hits and gets the score of a text without any; equal texts get equal scores;
    whole texts are read; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.innocent, lexicon.strict))
    own: list[Lexicon] = []
    a, b = map(float, beta)

    def one(text):
        if not own:
            own.append(Lexicon(*model.value))
        x, exact, fuzzy, quoted = abuse(text, own[0])
        p = float(1 / (1 + np.exp(-(a + b * np.log1p(x)))))
        return p, int(p >= 0.5), exact, fuzzy, quoted

    schema = pa.schema([("score", pa.float64()), ("predicted", pa.int32()), ("n_exact", pa.int64()), ("n_misspelled", pa.int64()), ("quoted", pa.float64())])
    return map_rows(docs, one, ["text"], schema, "score double, predicted int, n_exact long, n_misspelled long, quoted double", list(carry))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon, beta = learn(sample(docs, table(spark, sf_dir, "labels")))
    return score(docs, lexicon, beta).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_exact", "n_misspelled")
