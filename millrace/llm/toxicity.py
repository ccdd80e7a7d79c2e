"""Toxicity of texts: a learned lexicon, matched with room for one typing error.

The lexicon holds words, and stems that several words share, which occur in
toxic labelled texts far more often than chance explains.  It is kept as a
trie.  The trie and the Levenshtein automaton of distance one are intersected:
a set of (trie node, errors so far) is a state, and states are worked out as
words ask for them.  Each hit is scored within its window of words, where
quotation marks and words of reporting speak for quotation rather than abuse.
A logistic regression turns the scores of a text into a probability.
"""

import math
import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import listed
from millrace.session import materialise

WORD = re.compile(r"[^\W_]+")
QUOTES = "\"“”„«»‹›`"
# Fixed list: verbs and nouns that announce a quotation, in the four languages.
REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quotes term word words phrase "
    "dit écrit appelé citation mot terme sagte sagt nannte schrieb zitat wort begriff "
    "dijo dice llamó escribió cita palabra término".split()
)


class Settings(NamedTuple):
    """``false_share`` is the share of chance terms the lexicon may hold.

    ``max_terms`` and ``max_exceptions`` bound what every task holds in memory:
    the strongest terms, and the commonest clean words that resemble one.
    """

    window: int = 8
    least_texts: int = 4
    stems: tuple = (4, 5, 6)
    fuzzy_length: int = 5
    false_share: float = 0.01
    max_terms: int = 20_000
    max_exceptions: int = 50_000
    regularisation: float = 0.002


#: Words that a task counts before it hands them on, and rows of a frame then.
HELD_WORDS, OUT_ROWS = 200_000, 50_000

FEATURES = ("abuse", "quoted", "misspelled", "terms", "densest", "rate")


class Term(NamedTuple):
    text: str
    stem: bool
    weight: float


class Matcher(dict):
    """word -> (term position, errors), or None; remembered for a while."""

    REMEMBERED = 300_000
    STATES = 50_000

    def __init__(self, terms: list[Term], exceptions: frozenset, fuzzy_length: int):
        self.exceptions, self.fuzzy_length = exceptions, fuzzy_length
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        self.longest = [0]
        for number, term in enumerate(terms):
            node = 0
            for char in term.text:
                if not term.stem:
                    self.longest[node] = max(self.longest[node], len(term.text))
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.longest.append(0)
                node = self.children[node][char]
            if not term.stem:
                self.longest[node] = max(self.longest[node], len(term.text))
            (self.stem_at if term.stem else self.word_at)[node] = number
        self._reset()

    def _reset(self):
        self.states: dict[tuple, dict[str, tuple]] = {}
        self.start = self._closed({0: 0})

    def _closed(self, nodes: dict[int, int]) -> tuple:
        """Add what a missing character reaches; nodes maps a trie node to its errors."""
        for node, errors in list(nodes.items()):
            if not errors:
                for child in self.children[node].values():
                    if self.longest[child] >= self.fuzzy_length:
                        nodes.setdefault(child, 1)
        return tuple(sorted(nodes.items()))

    def _step(self, state: tuple, char: str) -> tuple:
        known = self.states.setdefault(state, {})
        if char not in known:
            after: dict[int, int] = {}
            for node, errors in state:
                exact = self.children[node].get(char)
                if exact is not None:
                    after[exact] = min(errors, after.get(exact, 1))
                if not errors:
                    for child in (node, *self.children[node].values()):
                        if child != exact and self.longest[child] >= self.fuzzy_length:
                            after.setdefault(child, 1)
            known[char] = self._closed(after)
        return known[char]

    def _find(self, word):
        state, stem = self.start, None
        if len(self.states) > self.STATES:
            self._reset()
            state = self.start
        for char in word:
            state = self._step(state, char)
            if not state:
                break
            for node, errors in state:
                if not errors and node in self.stem_at:
                    stem = self.stem_at[node]
        found = [(errors, self.word_at[node]) for node, errors in state if node in self.word_at]
        found = [f for f in found if not f[0] or len(word) >= self.fuzzy_length]
        if found and min(found)[0] == 0:
            return min(found)[1], 0
        if stem is not None:
            return stem, 0
        if found and word not in self.exceptions:
            return min(found)[1], 1
        return None

    def __missing__(self, word):
        if len(self) >= self.REMEMBERED:
            self.clear()
        found = self[word] = self._find(word)
        return found


def hits_of(text: str, matcher: Matcher, terms: list[Term], window: int):
    """(hits, number of words); a hit is (word position, term, errors, quoted, weight)."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    matched = [(at, m) for at, m in enumerate(map(matcher.__getitem__, words)) if m]
    if not matched:
        return [], len(words)
    spans = [m.span() for m in WORD.finditer(lowered)]
    hits = []
    for at, (term, errors) in matched:
        first, last = max(0, at - window), min(len(words), at + window + 1)
        before = lowered[spans[first][0] : spans[at][0]]
        after = lowered[spans[at][1] : spans[last - 1][1] + 1]
        marked = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
        reported = any(w in REPORTING for w in words[first:last])
        hits.append((at, term, errors, marked, terms[term].weight * (0.5 if reported else 1.0)))
    return hits, len(words)


def features_of(text, matcher: Matcher, terms: list[Term], window: int) -> list[float]:
    """One number per name in FEATURES; all zero without a hit."""
    hits, count = hits_of(text, matcher, terms, window) if text else ([], 0)
    if not hits:
        return [0.0] * len(FEATURES)
    plain = [h for h in hits if not h[3] and not h[2]]
    at = np.array([h[0] for h in plain] or [-1])
    weights = np.array([h[4] for h in plain] or [0.0])
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    near = sums[np.searchsorted(at, at + window, "right")] - sums[np.searchsorted(at, at - window)]
    return [
        math.log1p(float(weights.sum())),
        math.log1p(sum(h[4] for h in hits if h[3])),
        math.log1p(sum(h[4] for h in hits if h[2] and not h[3])),
        math.log1p(len({h[1] for h in plain})),
        math.log1p(float(near.max())),
        100.0 * len(plain) / count,
    ]


class Model(NamedTuple):
    terms: list
    exceptions: frozenset
    coefficients: list
    intercept: float
    settings: Settings


def _word_counts(frames):
    """(word, toxic texts, clean texts, contexts) of what a task has seen, in parts.

    ``contexts`` has one bit, of 63, per hash of the word before the first
    occurrence in a toxic text: near copies of a text do not add contexts.
    """
    # One small number a word: texts of both kinds; contexts only for words of toxic texts.
    counts: dict[str, int] = {}
    toxic_counts: dict[str, int] = {}
    contexts: dict[str, int] = {}

    def made():
        words = list(counts)
        for at in range(0, len(words), OUT_ROWS):
            part = words[at : at + OUT_ROWS]
            toxic = np.fromiter((toxic_counts.get(w, 0) for w in part), np.int64, len(part))
            total = np.fromiter((counts[w] for w in part), np.int64, len(part))
            marks = np.fromiter((contexts.get(w, 0) for w in part), np.int64, len(part))
            yield pd.DataFrame({"word": part, "toxic": toxic, "clean": total - toxic, "contexts": marks})
        counts.clear(), toxic_counts.clear(), contexts.clear()

    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"]):
            words = WORD.findall((text or "").lower())
            if toxic:
                for word, before in dict(zip(reversed(words), reversed(["", *words[:-1]]))).items():
                    counts[word] = counts.get(word, 0) + 1
                    toxic_counts[word] = toxic_counts.get(word, 0) + 1
                    contexts[word] = contexts.get(word, 0) | 1 << crc32(before.encode()) % 63
            else:
                for word in set(words):
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) > HELD_WORDS:
                yield from made()
    yield from made()


def learn_lexicon(texts: DataFrame, settings=Settings()) -> tuple[list[Term], frozenset]:
    """Terms and exceptions from (text, toxic) rows, one row per different text."""
    sums = [F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("contexts").alias("contexts")]
    counts = texts.mapInPandas(_word_counts, "word string, toxic long, clean long, contexts long")
    counts = counts.groupBy("word").agg(*sums)
    counts, _ = materialise(counts, "words")
    totals = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    bad, good = (int(t or 0) for t in totals)
    if not bad or not good:
        return [], frozenset()
    base = bad / (bad + good)
    length = F.explode(F.array(*(F.lit(n) for n in settings.stems)))
    stems = (
        counts.select("word", "toxic", "clean", "contexts", length.alias("length"))
        .filter(F.length("word") > F.col("length"))
        .groupBy(F.expr("substring(word, 1, length)").alias("word"))
        .agg(*sums, F.count(F.lit(1)).alias("words"))
        .filter("words >= 3")
        .select("word", "toxic", "clean", "contexts", F.lit(True).alias("stem"))
    )
    both = counts.select("word", "toxic", "clean", "contexts", F.lit(False).alias("stem")).unionByName(stems)
    tested = both.filter(F.col("toxic") + F.col("clean") >= settings.least_texts)
    seen = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / seen
    divergence = F.col("toxic") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    # The number of different contexts, by linear counting; it bounds the support.
    contexts = -63 * F.log(1 - F.least(F.bit_count("contexts"), F.lit(62)) / 63)
    support = F.when(contexts < 40, F.least(F.round(contexts), F.col("toxic"))).otherwise(F.col("toxic"))
    tested = tested.withColumn("support", support).withColumn("log_p", -divergence * support / F.col("toxic"))
    tests = tested.count()
    strong = tested.filter((share > 0.5) & (share > 4 * base) | (share == 1.0))
    strong = strong.filter((F.col("support") >= settings.least_texts) & (F.col("log_p") < -3))
    rows = strong.orderBy("log_p", "word", "stem").limit(settings.max_terms).collect()
    kept = 0
    for rank, row in enumerate(rows, 1):
        if row["log_p"] <= math.log(settings.false_share * rank / tests):
            kept = rank
    terms = [
        Term(r["word"], r["stem"], math.log((r["toxic"] + 0.5) / (bad + 1)) - math.log((r["clean"] + 0.5) / (good + 1)))
        for r in rows[:kept]
    ]
    terms = [t for t in terms if t.weight > 0]
    if not terms:
        return [], frozenset()
    matcher_parts = (terms, frozenset(), settings.fuzzy_length)

    def resembling(frames):
        matcher = Matcher(*matcher_parts)
        for frame in frames:
            yield frame[[bool(m) and m[1] == 1 for m in map(matcher.__getitem__, frame["word"])]]

    close = counts.filter("clean > 0").select("word", "clean").mapInPandas(resembling, "word string, clean long")
    close = close.orderBy(F.desc("clean"), "word").limit(settings.max_exceptions).collect()
    return terms, frozenset(r["word"] for r in close)


def learn(texts: DataFrame, settings=Settings()) -> Model:
    """A model from (text, toxic) rows, one row per different text.

    Without toxic or without clean rows the score is their smoothed share.
    """
    rows = texts.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    count, bad = int(rows[0]), int(rows[1] or 0)
    share = (bad + 0.5) / (count + 2)
    prior = math.log(share / (1 - share))
    terms, exceptions = learn_lexicon(texts, settings) if 0 < bad < count else ([], frozenset())
    if not terms:
        return Model([], frozenset(), [0.0] * len(FEATURES), prior, settings)
    plain = Model(terms, exceptions, [], 0.0, settings)

    def measured(frames):
        matcher = Matcher(plain.terms, plain.exceptions, settings.fuzzy_length)
        for frame in frames:
            found = [features_of(t, matcher, plain.terms, settings.window) for t in frame["text"]]
            yield pd.DataFrame({"label": frame["toxic"].astype(float), "found": found})

    seen, _ = materialise(texts.mapInPandas(measured, "label double, found array<double>"), "features")
    seen = seen.select("label", array_to_vector("found").alias("features"))
    fit = LogisticRegression(regParam=settings.regularisation, maxIter=100).fit(seen)
    return plain._replace(coefficients=[float(c) for c in fit.coefficients], intercept=float(fit.intercept))


def score(docs: DataFrame, model: Model, text_col="text", name="score") -> DataFrame:
    """``docs`` with a probability of being toxic, from the whole text alone.

    A null or empty text scores as a text without any hit.  Only the text goes
    to Python and only the score comes back.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model.terms, model.exceptions, model.settings.fuzzy_length)
        weights = np.array(model.coefficients)
        for texts in batches:
            found = [features_of(t, matcher, model.terms, model.settings.window) for t in texts]
            logits = np.array(found).reshape(len(texts), -1) @ weights + model.intercept
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500))))

    return docs.withColumn(name, scored(F.col(text_col).cast("string")))


def labelled_texts(docs: DataFrame, labels: DataFrame, learned, id_col="doc_id", text_col="text") -> DataFrame:
    """(text, toxic): one row per different labelled text that ``learned`` allows.

    Labels without a value or an id are ignored; where labels of a document or
    of copies of a text disagree, the majority counts, toxic on a tie.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    marks = listed(marks.groupBy(F.col(id_col).alias("marked")).agg(F.avg("toxic").alias("mark")), "labels")
    texts = docs.filter(learned).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(marks, F.col("id") == F.col("marked")).select("id", "text", "mark")
    chosen = texts.groupBy(F.xxhash64("text").alias("same")).agg(
        F.min("id").alias("chosen"), (F.avg("mark") >= 0.5).cast("long").alias("toxic")
    )
    chosen = listed(chosen.groupBy("chosen").agg(F.max("toxic").alias("toxic")), "chosen")
    found = docs.filter(learned).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return found.join(chosen, F.col("id") == F.col("chosen")).select("text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, learned, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, score) for every row of ``docs``.

    ``learned`` is a boolean column: labels of other rows are not looked at.
    Labels, ids and other columns never enter a score.
    """
    model = learn(labelled_texts(docs, labels, learned, id_col, text_col))
    texts = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return score(texts, model).select(id_col, "score")
