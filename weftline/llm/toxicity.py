"""Toxicity of whole texts: a learned lexicon, matched with misspellings, scored in context.

The lexicon holds word beginnings that set toxic texts apart from clean ones in labelled
rows; it is a trie. A word of a text is read by the product of the trie and the
Levenshtein automata of its entries: a state is the set of (trie node, edits so far) that
the letters read can have led to, and is worked out when first needed. Hits are then
weighed in windows of neighbouring words; hits between quotation marks, however far
apart, count less, so that reporting a term is not taken for using it. A logistic
regression on window, density and sum gives the score.
"""

from __future__ import annotations

import re
import weakref
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import column, empty_as_text, free_name, hint_small
from weftline.llm.linking import small_batches
from weftline.llm.vocabulary import Memo
from weftline.workspace import materialize

#: At most about so many labelled rows are learned from, chosen by a hash of their id.
LABELLED_ROWS = 20_000
LEXICON_ENTRIES = 4_000
MIN_TOXIC_ROWS = 3
LEAST_G = 15.0
FOLDS = 4
LEAST_LOG_ODDS = 1.0
SHORTEST, LONGEST = 3, 12
WINDOW_WORDS = 16
QUOTED_FACTOR = 0.3
THRESHOLD = 0.7

_STATES = 100_000
#: Trie nodes in all states together, 4 bytes each.
_STATE_NODES = 10_000_000
_words = re.compile(r"[^\W_]+").findall
_quotes = re.compile(r"[\"“”„‘’‚«»‹›]")
_before_opening = re.compile(r"[\s(\[{<\-–—/“„‘‚«»‹›]").match
_blank_line = re.compile(r"\n[^\S\n]*\n\s*")
#: Marks that are paired with one another, and the marks that open by their shape.
_FAMILY = {mark: family for family in ("\"", "“”„", "‘’‚", "«»", "‹›") for mark in family}
_OPENING, _ALWAYS_OPENING = frozenset("“„‘‚«‹"), frozenset("„‚")
_STOPS = frozenset(".,;:!?…)]}")


def allowed_edits(term: str) -> int:
    """Misspellings are looked for in longer terms only."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def _opens(mark: str, before: str, after: str, opener: str | None) -> bool:
    """Whether a mark opens a quotation, by what stands around it and the mark of its family that waits for its end."""
    if mark in _ALWAYS_OPENING:
        return True
    may_open = bool(_before_opening(before)) and not after.isspace() and after not in _STOPS
    may_close = not before.isspace() and not after.isalnum()
    if opener in _ALWAYS_OPENING or mark == "”" and opener == "“" or mark == "’" and opener == "‘":
        return may_open and not may_close and mark in _OPENING
    if may_open != may_close:
        return may_open
    # Blanks or words on both sides: by shape, unless the quotation was opened by the other shape.
    return opener is None if mark == "\"" else mark in _OPENING and opener not in ("»", "›")


def _is_apostrophe(mark: str, before: str, after: str, opener: str | None) -> bool:
    return mark in "‘’" and (before.isalnum() and after.isalnum() or mark == "’" and opener is None and before.isalnum())


def quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of the outermost quotations, of any length, in one pass over the whole text.

    Marks of a family are paired: straight, “ ” „, ‘ ’ ‚, « » and ‹ ›; a mark without a
    partner quotes nothing. A mark opens after a blank and before a word and closes after a
    word and before a blank, whatever its shape, so »so«, «so», ”so” and „so“ are all read;
    where that decides nothing its shape does, and a straight mark does what it can. A
    quotation that is open at a blank line ends there unquoted, unless the next paragraph
    begins with a mark of its family, as long quotations are written.
    """
    open_at: dict[str, list[tuple[int, str]]] = {family: [] for family in _FAMILY.values()}
    pairs: list[tuple[int, int]] = []
    breaks = [(match.start(), match.end()) for match in _blank_line.finditer(text)]
    passed = 0
    for match in _quotes.finditer(text):
        mark, at = match[0], match.start()
        family, goes_on = _FAMILY[mark], False
        while passed < len(breaks) and breaks[passed][0] < at:
            first = breaks[passed][1]
            begins = _FAMILY.get(text[first:first + 1])
            for other, left in open_at.items():
                if other != begins:
                    left.clear()
            goes_on = first == at and bool(open_at[family])
            passed += 1
        if goes_on:
            continue
        waiting = open_at[family]
        before, after = text[max(0, at - 1):at] or " ", text[at + 1:at + 2] or " "
        opener = waiting[-1][1] if waiting else None
        if _is_apostrophe(mark, before, after, opener):
            continue
        if _opens(mark, before, after, opener):
            waiting.append((at, mark))
        elif waiting:
            pairs.append((waiting.pop()[0], at + 1))
    outer: list[tuple[int, int]] = []
    for start, end in sorted(pairs):
        if outer and start < outer[-1][1]:
            outer[-1] = outer[-1][0], max(end, outer[-1][1])
        else:
            outer.append((start, end))
    return outer


class Lexicon:
    """Terms with the weight of an exact and of a misspelled hit; a term matches words that begin with it."""

    def __init__(self, terms: dict[str, tuple[float, float]]):
        self.terms = terms
        self._children: list[dict[str, int]] = [{}]
        self._term_at: list[str | None] = [None]
        self._edits_below = [0]
        for term in sorted(terms):
            node = 0
            self._edits_below[0] = max(self._edits_below[0], allowed_edits(term))
            for letter in term:
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._term_at.append(None)
                    self._edits_below.append(0)
                node = self._children[node][letter]
                self._edits_below[node] = max(self._edits_below[node], allowed_edits(term))
            self._term_at[node] = term
        self.forget()

    def __reduce__(self):
        return Lexicon, (self.terms,)

    def forget(self) -> None:
        """Drop the states and weights worked out so far."""
        self._reset()
        # The table must not hold the lexicon that holds it: each task has its own, which has to go as the task ends.
        self.weight_of = Memo(partial(Lexicon._weight, weakref.proxy(self)))

    def _reset(self) -> None:
        self._number: dict[bytes, int] = {}
        self._sets: list[bytes] = []
        self._nodes = 0
        self._steps: list[dict[str, int]] = []
        self._accepts: list[tuple[str | None, str | None]] = []
        self._start = self._state({0: 0})

    def _state(self, edits: dict[int, int]) -> int:
        """Number of the state with these trie nodes, after skipping letters of the lexicon."""
        todo = list(edits)
        while todo:
            node = todo.pop()
            for child in self._children[node].values():
                used = edits[node] + 1
                if used <= self._edits_below[child] and used < edits.get(child, 9):
                    edits[child] = used
                    todo.append(child)
        items = sorted(edits.items())
        packed = np.array([4 * node + used for node, used in items], np.uint32).tobytes()
        if packed not in self._number:
            self._number[packed] = len(self._sets)
            self._sets.append(packed)
            self._nodes += len(items)
            self._steps.append({})
            self._accepts.append(self._accepted(items))
        return self._number[packed]

    def _accepted(self, items: list[tuple[int, int]]) -> tuple[str | None, str | None]:
        exact = near = None
        for node, used in items:
            term = self._term_at[node]
            if term is None or used > allowed_edits(term):
                continue
            if used == 0:
                exact = term
            elif near is None or self.terms[term][1] > self.terms[near][1]:
                near = term
        return exact, near

    def _step(self, state: int, letter: str) -> int:
        edits: dict[int, int] = {}

        def reach(node: int, used: int) -> None:
            if used <= self._edits_below[node] and used < edits.get(node, 9):
                edits[node] = used

        for item in np.frombuffer(self._sets[state], np.uint32).tolist():
            node, used = item >> 2, item & 3
            for own, child in self._children[node].items():
                reach(child, used if own == letter else used + 1)
            reach(node, used + 1)
        return self._state(edits) if edits else -1

    def match(self, word: str) -> tuple[str | None, bool]:
        """The longest term that ``word`` begins with, else the best misspelled one; whether it is exact."""
        if len(self._sets) > _STATES or self._nodes > _STATE_NODES:
            self._reset()
        state, exact, near = self._start, None, None
        for letter in word:
            steps = self._steps[state]
            following = steps.get(letter)
            if following is None:
                following = steps[letter] = self._step(state, letter)
            if following < 0:
                break
            state = following
            now_exact, now_near = self._accepts[state]
            exact = now_exact or exact
            if now_near and (near is None or self.terms[now_near][1] > self.terms[near][1]):
                near = now_near
        return (exact, True) if exact else (near, False)

    def _weight(self, word: str) -> float:
        term, exact = self.match(word)
        return 0.0 if term is None else self.terms[term][0 if exact else 1]

    def features(self, text: str) -> tuple[float, float, float, int]:
        """Log of summed weight, of weight per 100 words, of the heaviest window; and the number of hits."""
        weights = list(map(self.weight_of.__getitem__, _words(text.lower())))
        if not any(weights):
            return 0.0, 0.0, 0.0, 0
        own = np.array(weights)
        if _quotes.search(text):
            own *= self._in_quotes(text.lower(), len(own))
        summed = np.cumsum(np.concatenate([[0.0], own]))
        width = min(WINDOW_WORDS, len(own))
        window = float((summed[width:] - summed[:-width]).max())
        total = float(summed[-1])
        return np.log1p(total), np.log1p(100 * total / len(own)), np.log1p(max(window, 0.0)), int((own > 0).sum())

    @staticmethod
    def _in_quotes(text: str, words: int) -> np.ndarray:
        factor, at, done = np.ones(words), 0, 0
        for left, right in quotations(text):
            start = done + len(_words(text[at:left]))
            end = start + len(_words(text[left:right]))
            factor[start:end] = QUOTED_FACTOR
            at, done = right, end
        return factor


class Model:
    """A lexicon and the coefficients of its features."""

    def __init__(self, lexicon: Lexicon, coefficients: np.ndarray):
        self.lexicon, self.coefficients = lexicon, coefficients

    def score(self, text: str) -> tuple[float, int]:
        *features, hits = self.lexicon.features(text)
        return float(_sigmoid(self.coefficients @ np.array([1.0, *features]))), hits


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _incidence(rows: DataFrame) -> DataFrame:
    """(word, fold, toxic, clean): labelled rows that hold a word, words cut to the longest beginning."""
    words = F.array_distinct(F.transform(
        F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.substring(w, 1, LONGEST)
    ))
    return rows.select(F.explode(words).alias("word"), "fold", "toxic").groupBy("word", "fold").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )


def _beginnings(words: DataFrame) -> DataFrame:
    lengths = F.sequence(F.lit(SHORTEST), F.length("word"))
    cut = words.where(F.length("word") >= SHORTEST).select(
        F.explode(F.transform(lengths, lambda n: F.substring("word", F.lit(1), n))).alias("term"), "fold", "toxic", "clean"
    )
    by_fold = {f"{kind}_{fold}": F.sum(F.when(F.col("fold") == fold, F.col(kind)).otherwise(0)) for fold in range(FOLDS) for kind in ("toxic", "clean")}
    return cut.groupBy("term").agg(*[total.alias(name) for name, total in by_fold.items()])


def _log_odds(toxic, clean, all_toxic: float, all_clean: float):
    return np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))


def _g_statistic(toxic: pd.Series, clean: pd.Series, toxic_share: float) -> pd.Series:
    """Twice the log-likelihood ratio of the counts against the overall share of toxic ones."""
    total = toxic + clean
    return 2 * (
        toxic * np.log((toxic / (total * toxic_share)).clip(lower=1e-12))
        + clean * np.log((clean / (total * (1 - toxic_share))).clip(lower=1e-12))
    )


def select_terms(terms: pd.DataFrame, all_toxic: float, all_clean: float) -> dict[str, float]:
    """Beginnings whose log-odds of toxic against clean rows stand out, with these log-odds.

    A beginning gives way to a longer one that holds nearly all its toxic rows, and is
    left out where a shorter one says about the same.
    """
    terms = terms[terms["toxic"] >= MIN_TOXIC_ROWS].copy()
    if terms.empty:
        return {}
    terms["odds"] = _log_odds(terms["toxic"], terms["clean"], all_toxic, all_clean)
    terms["g"] = _g_statistic(terms["toxic"], terms["clean"], all_toxic / (all_toxic + all_clean))
    strong = terms[(terms["g"] >= LEAST_G) & (terms["odds"] >= LEAST_LOG_ODDS)]
    strong = strong.sort_values(["g", "term"], ascending=[False, True]).head(LEXICON_ENTRIES)
    toxic, odds = dict(zip(strong["term"], strong["toxic"], strict=True)), dict(zip(strong["term"], strong["odds"], strict=True))
    replaced = {term[:-1] for term in toxic if toxic.get(term[:-1], 0) * 0.9 <= toxic[term]}
    kept: dict[str, float] = {}
    for term in sorted(t for t in odds if t not in replaced):
        shorter = next((kept[term[:n]] for n in range(len(term) - 1, SHORTEST - 1, -1) if term[:n] in kept), None)
        if shorter is None or odds[term] > shorter + 0.7:
            kept[term] = float(odds[term])
    return kept


def _with_misspellings(odds: dict[str, float], words: DataFrame, all_toxic: float, all_clean: float, folds: list[int]) -> Lexicon:
    """The lexicon of ``odds``; a misspelled hit weighs what such hits say in the labelled rows, half its term's if unseen."""
    plain = Lexicon({term: (value, value) for term, value in odds.items()})

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [plain.match(word) for word in batch["word"]]
            own = batch.assign(term=[None if exact else term for term, exact in found])
            yield own.loc[own["term"].notna(), ["term", "toxic", "clean"]]

    hits = words.where(F.col("fold").isin(folds)).mapInPandas(near, "term string, toxic bigint, clean bigint")
    counted = {row["term"]: row for row in hits.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()}
    weights = {}
    for term, value in odds.items():
        seen = counted.get(term)
        misspelled = value / 2 if seen is None else _log_odds(seen["toxic"], seen["clean"], all_toxic, all_clean)
        weights[term] = (value, float(np.clip(misspelled, 0.0, value)))
    return Lexicon(weights)


def _fitted(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(features)), features])
    ridge = np.diag([1e-3, *[0.05] * features.shape[1]])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model of the labelled rows that are not held out; at most about ``LABELLED_ROWS`` of them.

    Several labels of one id count as toxic if any does; null labels, null ids and null
    texts are not learned from, and of rows with the same text and label one is. Without
    labels of both kinds the lexicon is empty and every text has the share of toxic
    labels as its score (0 without any).
    """
    with small_batches(docs.sparkSession):
        return _learned(docs, labels, doc_id, text, toxic)


def _learned(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str) -> Model:
    known = labels.select(column(doc_id).alias("doc_id"), column(toxic).cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, LABELLED_ROWS / max(known.count(), 1))
    known = materialize(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) <= int(share * (1 << 20))), "labels", rows=LABELLED_ROWS)
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")).where(F.col("text").isNotNull())
    rows = rows.join(hint_small(known, 16), "doc_id").select("text", "toxic").distinct()
    rows = materialize(rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")), "labelled")
    words = materialize(_incidence(rows), "incidence")
    sums = {(r["fold"], k): r[k] for r in words.groupBy("fold").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect() for k in ("toxic", "clean")}
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not counts.get(1) or not counts.get(0):
        share = 1.0 if counts.get(1) else 0.0
        return Model(Lexicon({}), np.array([np.log((share + 1e-9) / (1 - share + 1e-9)), 0, 0, 0]))
    def total(kind: str, folds: list[int]) -> float:
        return float(sum(sums.get((fold, kind), 0) for fold in folds))

    every = list(range(FOLDS))
    # Only terms of enough toxic rows can be chosen; these are few, as the rows are bounded.
    toxic_rows = sum(F.col(f"toxic_{fold}") for fold in every)
    clean_rows = sum(F.col(f"clean_{fold}") for fold in every)
    stands_out = (toxic_rows + 0.5) / (total("toxic", every) + 1) > (clean_rows + 0.5) / (total("clean", every) + 1) * F.lit(1.5)
    terms = _beginnings(words).where((toxic_rows >= MIN_TOXIC_ROWS) & stands_out).toPandas()

    def lexicon(folds: list[int]) -> Lexicon:
        own = pd.DataFrame({"term": terms["term"], **{k: sum(terms[f"{k}_{f}"] for f in folds) for k in ("toxic", "clean")}})
        totals = [total(kind, folds) for kind in ("toxic", "clean")]
        return _with_misspellings(select_terms(own, *totals), words, *totals, folds)

    # A fold's features come from the lexicon of the others, as those of unseen texts would.
    other = {fold: lexicon([f for f in every if f != fold]) for fold in every}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            found = []
            for text, fold in zip(batch["text"], batch["fold"], strict=True):
                if fold != last and last is not None:
                    other[last].forget()  # rows are sorted by fold, so one lexicon at a time holds states
                last = fold
                found.append(other[fold].features(text)[:3])
            yield pd.DataFrame(found, columns=["x1", "x2", "x3"]).assign(toxic=batch["toxic"].to_numpy())

    seen = rows.sortWithinPartitions("fold").mapInPandas(measure, "x1 double, x2 double, x3 double, toxic int").toPandas()
    return Model(lexicon(every), _fitted(seen[["x1", "x2", "x3"]].to_numpy(), seen["toxic"].to_numpy(float)))


def score_toxicity(docs: DataFrame, model: Model, *, text: str = "text", score: str = "score", hits: str = "hits") -> DataFrame:
    """``docs`` plus the score (0 to 1) of every whole text and its number of lexicon hits.

    Null and empty texts get the score of a text without hits. Every row is scored by
    itself, so repeated rows and ids stay; columns named like a new one are replaced; an
    empty table stays empty. No shuffle; the model is bounded. Batches of texts are bounded if
    the result is written within ``small_batches``.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.score(value) for value in batch], columns=["score", "hits"])

    scored = F.pandas_udf(run, "score double, hits int")
    kept = [c for c in docs.columns if c not in (score, hits)]
    name = free_name(docs.columns, "scored")
    out = docs.withColumn(name, scored(empty_as_text(text)))
    return out.select(
        *[column(c) for c in kept], column(name).getField("score").alias(score), column(name).getField("hits").alias(hits)
    )


def classify(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) of every row of ``docs``, learned from ``labels``."""
    model = learn(docs, labels, doc_id=doc_id, text=text)
    scored = score_toxicity(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), model)
    out = scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits"
    )
    with small_batches(docs.sparkSession):
        return materialize(out, "scored")
