"""Toxicity: two class-conditional Kneser-Ney models over the letters of words.

One model learns the spelling of words in toxic texts, one that in ordinary texts. Both back off to
one distribution of letters counted over both classes, so an expression that is rare in either class
says little. A text's evidence is the difference of its two log-likelihoods per word; a logistic
curve, fitted on sampled texts the models have not seen, turns it into a score.

Letters and not whole words are the events because insults are inflected: a stem seen a few times
is known in all its forms. Words are independent, so each distinct word is rated once per worker.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bantin.llm.common import claim, query, small_parts, table, whole_text, with_fields

ORDER = 4
# The models are fitted on at most this many labelled texts of each class, of at most this many characters.
SAMPLE_DOCS = 1_500
SAMPLE_CHARS = 50_000
# One sampled text in so many fits the curve instead of the models.
_HELD_BACK = 4
_WORD = re.compile(r"[^\W\d_]+")
_KEPT_WORDS = 500_000
_START, _END = "<", ">"
# Evidence of a word within so many natural-log units is no evidence: the classes' samples differ in
# their shares of languages and topics. Which of these is right is fitted, with the curve, on held-back texts.
DEAD_ZONES = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _counts(words: Counter, order: int) -> dict[str, int]:
    """Kneser-Ney counts of all letter runs of at most `order` that end at a letter of a word.

    The longest runs, and runs from a word's start, count as they occur; shorter ones count the
    different letters that stand before them.
    """
    longest: Counter = Counter()
    for word, n in words.items():
        shown = _START + word + _END
        for end in range(2, len(shown) + 1):
            longest[shown[max(0, end - order) : end]] += n
    counts = dict(longest)
    level = [g for g in longest if len(g) == order]
    for size in range(order, 1, -1):
        shorter: Counter = Counter(g[1:] for g in level)
        for g, n in shorter.items():
            counts[g] = counts.get(g, 0) + n
        level = [*shorter, *(g for g in longest if len(g) == size - 1 and g[0] == _START)]
    return counts


class _Class:
    """Interpolated Kneser-Ney probabilities of one class over a shared distribution of letters."""

    def __init__(self, words: Counter, order: int, letters: dict[str, float], unknown: float) -> None:
        self.counts, self.letters, self.unknown = _counts(words, order), letters, unknown
        self.total: dict[str, int] = defaultdict(int)
        self.kinds: dict[str, int] = defaultdict(int)
        for g, n in self.counts.items():
            self.total[g[:-1]] += n
            self.kinds[g[:-1]] += 1
        met = Counter(self.counts.values())
        self.discount = met[1] / (met[1] + 2 * met[2]) if met[1] and met[2] else 0.75
        self._known: dict[str, float] = {}

    def backoff(self, context: str) -> float:
        total = self.total.get(context, 0)
        return self.discount * self.kinds[context] / total if total else 1.0

    def p(self, g: str) -> float:
        """Probability of the last letter of `g` after the others."""
        if not g:
            return self.unknown
        if g not in self._known:
            below = self.p(g[1:]) if len(g) > 1 else self.letters.get(g, self.unknown)
            total = self.total.get(g[:-1], 0)
            own = max(self.counts.get(g, 0) - self.discount, 0) / total if total else 0.0
            self._known[g] = own + self.backoff(g[:-1]) * below
        return self._known[g]


class Model:
    """log P(toxic) - log P(ordinary) of words, in the back-off form: runs seen in either class, and contexts."""

    def __init__(self, toxic: Counter, ordinary: Counter, order: int = ORDER) -> None:
        self.order = order
        letters: Counter = Counter()
        for words in (toxic, ordinary):
            letters.update({g: n for g, n in _counts(words, order).items() if len(g) == 1})
        total = sum(letters.values()) + 1
        shared = {x: n / total for x, n in letters.items()}
        a, b = (_Class(w, order, shared, 1 / total) for w in (toxic, ordinary))
        self.seen = {g: math.log(a.p(g) / b.p(g)) for g in a.counts.keys() | b.counts.keys()}
        self.context = {h: math.log(a.backoff(h) / b.backoff(h)) for h in a.total.keys() | b.total.keys()}
        self.curve, self.dead_zone = np.zeros(4), 0.0
        self._words: dict[str, float] = {}

    def word(self, word: str) -> float:
        """Evidence of one word, shrunk by the dead zone."""
        known = self._words.get(word)
        if known is None:
            if len(self._words) >= _KEPT_WORDS:
                self._words.clear()
            shown, known = _START + word + _END, 0.0
            for end in range(2, len(shown) + 1):
                g = shown[max(0, end - self.order) : end]
                while g and g not in self.seen:
                    known += self.context.get(g[:-1], 0.0)
                    g = g[1:]
                known += self.seen.get(g, 0.0)
            known = math.copysign(max(0.0, abs(known) - self.dead_zone), known)
            self._words[word] = known
        return known

    def evidence(self, text: str) -> tuple[float, int]:
        """Difference of the log-likelihoods per word, and the number of words."""
        words = words_of(text)
        return sum(map(self.word, words)) / max(1, len(words)), len(words)

    def features(self, texts: Iterable[str]) -> np.ndarray:
        """Of one word, chance makes the evidence large; of many, it does not: hence the length."""
        found = np.array([self.evidence(t) for t in texts], float).reshape(-1, 2)
        size = np.log1p(found[:, 1])
        return np.stack([np.ones(len(found)), found[:, 0], size, found[:, 0] * size], axis=1)

    def fit(self, texts: list[str], toxic: np.ndarray, share: float) -> None:
        """The dead zone and curve that give the texts' labels the largest likelihood, and of equal ones the smaller zone."""
        tried = []
        for zone in DEAD_ZONES:
            self.dead_zone = zone
            self._words.clear()
            tried.append((self.fit_curve(texts, toxic, share), zone, self.curve))
        self._words.clear()
        _, self.dead_zone, self.curve = min(tried, key=lambda t: t[:2])

    def fit_curve(self, texts: list[str], toxic: np.ndarray, share: float) -> float:
        """Logistic regression by Newton's method; each class weighs as much as it has in all labels. Returns the loss."""
        x, y = self.features(texts), toxic.astype(float)
        weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
        ridge = np.diag([1e-6, 1e-2, 1e-2, 1e-2])
        self.curve = np.zeros(4)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))
            slope = x.T @ (weight * (y - p)) - ridge @ self.curve
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(4), slope)
            self.curve += np.clip(step, -5, 5)
        z = np.clip(x @ self.curve, -500, 500)
        return float((weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).sum())

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.curve, -500, 500)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS
) -> tuple[list[tuple[int, str]], float]:
    """At most `sample_docs` different texts of each class as (toxic, text), and the toxic share of all such labels.

    `learn` selects the rows of `labels` to learn from. Documents with both labels, or a null label or
    doc_id, teach nothing. The smallest hashes of doc_id are taken, of texts not above `sample_chars`.
    """
    one = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    sure = one.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most")).where("toxic = most").drop("most")
    counts = {r.toxic: r.n for r in sure.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # At most 2 * sample_docs ids: the join below broadcasts no more than that.
    chosen = [sure.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).where(F.length("text") <= sample_chars)
    # Many rows may share an id: the texts are limited as well, in each task before they are brought together.
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("text"), "text")
    ranked = texts.join(ids, "doc_id").select("toxic", "text").distinct().withColumn("rank", F.row_number().over(order))
    rows = sorted(ranked.where(F.col("rank") <= sample_docs).collect(), key=lambda r: (r.toxic, r.rank))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return [(r.toxic, r.text) for r in rows], share


def train(sample: list[tuple[int, str]], share: float, order: int = ORDER) -> Model | None:
    """The two models and the curve, or None where a class has fewer than two texts."""
    parts: dict[tuple[int, bool], list[str]] = defaultdict(list)
    for k in (0, 1):
        for i, text in enumerate(t for toxic, t in sample if toxic == k):
            parts[k, i % _HELD_BACK == 1].append(text)
    if not all(parts[k, held] for k in (0, 1) for held in (False, True)):
        return None
    counts = [Counter(w for t in parts[k, False] for w in words_of(t)) for k in (0, 1)]
    if not all(counts):
        return None
    model = Model(counts[1], counts[0], order)
    texts = [*parts[0, True], *parts[1, True]]
    model.fit(texts, np.repeat([0, 1], [len(parts[0, True]), len(parts[1, True])]), share)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, order: int = ORDER, **bounds: int) -> DataFrame:
    """One row per document: `row` (its other columns), `text`, `score` (0 to 1).

    Only `text` is rated. Null and wordless texts get the curve's value for no evidence. Without two
    texts of each class to learn from, every score is 0. Repeated rows are rated each on its own, and
    columns of any name may be present: they stay inside `row`. Words are runs of letters, lower case.
    """
    sample, share = labelled_sample(docs, labels, F.lit(True) if learn is None else learn, **bounds)
    # Bounded by the sample: some ten thousand letter runs.
    shared = docs.sparkSession.sparkContext.broadcast(train(sample, share, order))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        model = shared.value
        for batch in small_parts(batches, 1_000):
            scores = np.zeros(len(batch))
            if model is not None:
                scores = model.scores([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["row"], batch["text"], pa.array(scores, pa.float64())], ["row", "text", "score"])
        if model is not None:
            model._words.clear()  # workers live on, and other operators need the room

    return rows.mapInArrow(rate, with_fields(rows.schema, score="double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = 0.5, **options: int) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    kept = toxicity(docs, labels, learn, **options).where(F.col("score") < threshold)
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def _fold(modulus: int = 5) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@query()
def op2_toxicity(spark, sf_dir):
    """Every document's score, learned from the labels of four folds in five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = toxicity(docs, table(spark, sf_dir, "labels"), _fold() != 0)
    rated = rated.select(F.col("row.doc_id").alias("doc_id"), "score")
    return rated.select("doc_id", (_fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
