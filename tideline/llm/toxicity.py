"""Toxicity of a text: a learned lexicon, matched with misspellings, weighed by context.

Learning counts, over all labelled texts, in how many toxic and clean ones a word stands, and keeps
the words and word beginnings whose likelihood ratio is beyond what chance gives among so many. The
words make a trie.
A Levenshtein automaton of one edit runs through the trie: a state is the set of trie nodes that can
be reached with the edits left, and each state is worked out once per process, so that a word costs
one look-up per letter and most words end after a few. A hit carries the weight of its term and its
number of edits.

The words around a hit say whether it is quoted: quotation marks that open before it and close after
it, or a word of reporting close by. Quoted and plain hits are added up apart, as are misspelled ones.
A text is then a few bounded numbers; their cells are counted by label over the whole corpus, and a
logistic regression is fitted to the counts. Its answer is the score.

Null and empty texts have no hits and the score of texts without hits. Repeated rows are scored each
time; a null id is in the fold of the empty text. Rows of labels that are null or repeated: nulls
teach nothing, repeats count each. Without labels every score is 0.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tideline.llm.common import arrow_rows, stored

#: states of the automaton that a task keeps; it makes them anew when they are needed again
MAX_STATES = 50_000
MAX_LABELS = 60_000
MIN_TEXTS = 2
MIN_RATIO = 20.0
SHORTEST_FUZZY = 5
CONTEXT = 6
WORD = regex.compile(r"[\p{L}\p{N}]+")
QUOTES = frozenset("\"“”„«»‟")
# Words that report what others said.
REPORTING = frozenset(
    "said says wrote writes quote quoted quotes called term word phrase sagte schrieb nannte wort "
    "dit écrit mot dijo escribió palabra".split()
)
#: a term with this mark at its end stands for all words that begin with it
STEM = "*"
STEM_LENGTHS = (5, 6, 7)
STEP = 4


# --- learning the lexicon -----------------------------------------------------------------------


def words_by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, toxic, n texts; passed on whenever the table of a partition has grown large."""
    counts: list[dict[str, int]] = [{}, {}]

    def flush() -> Iterator[pa.RecordBatch]:
        for toxic, table in enumerate(counts):
            if table:
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(list(table), pa.string()),
                        "toxic": pa.array([toxic] * len(table), pa.int32()),
                        "n": pa.array(list(table.values()), pa.int64()),
                    }
                )
                table.clear()

    for batch in batches:
        for text, toxic in zip(
            batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True
        ):
            table = counts[toxic]
            found = set(WORD.findall((text or "").lower()))
            stems = {w[:k] + STEM for w in found for k in STEM_LENGTHS if len(w) > k}
            for word in found | stems:
                table[word] = table.get(word, 0) + 1
            table[""] = table.get("", 0) + 1  # texts
            if len(table) > 500_000:
                yield from flush()
    yield from flush()


def lexicon(labelled: DataFrame) -> dict[str, float]:
    """Terms and weights from text and toxic (0 or 1).

    All terms that pass are taken. Each stands in `MIN_TEXTS` toxic texts or more, so there are no more
    than a `MIN_TEXTS`-th of the words of the bounded number of labelled texts.
    """
    counts = labelled.select("text", "toxic").mapInArrow(
        words_by_label, "word string, toxic int, n long"
    )
    by_word = counts.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    by_word = stored(by_word, "words")
    head = by_word.where("word = ''").first()
    if head is None or not head["a"]:
        return {}
    toxic, clean = head["a"], head["b"]
    distinct = by_word.count()
    # likelihood ratio of the 2 x 2 table, one-sided; the bound keeps chance finds to a handful
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    expected = (a + b) * (toxic / (toxic + clean))
    gain = 2 * (
        a * F.log(a / expected)
        + F.when(b > 0, b * F.log(b / (a + b - expected))).otherwise(0.0)
    )
    weight = F.log(((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1)))
    terms = (
        by_word.where((F.col("word") != "") & (F.col("a") >= MIN_TEXTS))
        .select("word", gain.alias("gain"), weight.alias("weight"))
        .where(
            (F.col("gain") > 2 * math.log(max(distinct, 2))) & (F.col("weight") > math.log(MIN_RATIO))
        )
        .orderBy(F.desc("gain"), "word")
    )
    return {r["word"]: r["weight"] for r in terms.collect()}


# --- matching -----------------------------------------------------------------------------------


@dataclass
class Automaton:
    """The Levenshtein automaton of one edit, run through the trie of the terms.

    A state is a set of (trie node, edits used); states and steps are made when first needed.
    """

    terms: dict[str, float]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, str] = field(default_factory=dict)
    states: list[frozenset] = field(default_factory=list)
    numbers: dict[frozenset, int] = field(default_factory=dict)
    steps: list[dict[str, int]] = field(default_factory=list)
    results: list[tuple[float, int] | None] = field(default_factory=list)
    seen: set[str] = field(default_factory=set)
    hits: dict[str, tuple[float, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.stems = {t[:-1]: w for t, w in self.terms.items() if t.endswith(STEM)}
        for term in self.terms:
            if term.endswith(STEM):
                continue
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                node = self.children[node][c]
            self.ends[node] = term
        self.restart()

    def restart(self) -> None:
        """Forget the states and steps made so far."""
        self.states, self.numbers, self.steps, self.results = [], {}, [], []
        self.start = self.number({(0, 0)})

    def number(self, pairs: set[tuple[int, int]]) -> int:
        # a letter left out of the word: the trie moves on alone
        pairs |= {(child, 1) for node, e in pairs if e == 0 for child in self.children[node].values()}
        exact = {node for node, e in pairs if e == 0}
        state = frozenset(p for p in pairs if p[1] == 0 or p[0] not in exact)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            hits = [
                (self.terms[self.ends[node]], e)
                for node, e in state
                if node in self.ends and (e == 0 or len(self.ends[node]) >= SHORTEST_FUZZY)
            ]
            self.results.append(min(hits, key=lambda h: (h[1], -h[0])) if hits else None)
        return self.numbers[state]

    def step(self, state: int, c: str) -> int:
        pairs = set()
        for node, e in self.states[state]:
            child = self.children[node].get(c)
            if child is not None:
                pairs.add((child, e))
            if e == 0:
                pairs.add((node, 1))  # a letter too many
                pairs |= {(x, 1) for x in self.children[node].values()}  # another letter
        to = self.number(pairs) if pairs else -1
        self.steps[state][c] = to
        return to

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the best term for a word; a stem counts as a term without edits."""
        if len(self.states) > MAX_STATES:
            self.restart()
        found, state = None, self.start
        for c in word:
            to = self.steps[state].get(c)
            if to is None:
                to = self.step(state, c)
            if to < 0:
                break
            state = to
        else:
            found = self.results[state]
        if found and not found[1]:
            return found
        stems = [self.stems[word[:k]] for k in STEM_LENGTHS if word[:k] in self.stems]
        return (max(stems), 0) if stems else found

    def known(self, words: set[str]) -> set[str]:
        """The words of a text that match, by way of a bounded memory; `hits` has what they match."""
        if len(self.seen) > 300_000:
            self.seen.clear()
            self.hits.clear()
        for word in words.difference(self.seen):
            hit = self.match(word)
            self.seen.add(word)
            if hit:
                self.hits[word] = hit
        return words.intersection(self.hits)


def quoted(tokens: list[str], at: int, marks: list[int]) -> bool:
    """Whether the word at `at` stands between quotation marks or near a word of reporting."""
    low, high = max(0, at - CONTEXT), at + CONTEXT + 1
    before = sum(marks[low : at + 1])
    after = sum(marks[at + 1 : high + 1])
    if before % 2 == 1 and after:
        return True
    return any(t in REPORTING for t in tokens[low:high])


def features(text: str, automaton: Automaton) -> tuple[float, float, float, float]:
    """Sums of weights of plain, quoted and misspelled hits, and of those not quoted per hundred words.

    A repeated word counts once: junk that repeats one doubtful word is not abuse.
    """
    lowered = text.lower()
    found = automaton.known(set(WORD.findall(lowered)))
    if not found:
        return 0.0, 0.0, 0.0, 0.0
    spans = list(WORD.finditer(lowered))
    tokens = [m.group() for m in spans]
    marks, last = [], 0  # quotation marks between a word and the one before
    for m in spans:
        marks.append(sum(c in QUOTES for c in lowered[last : m.start()]))
        last = m.end()
    marks.append(sum(c in QUOTES for c in lowered[last:]))
    # a word counts once, and as plain if it is ever not quoted
    seen: dict[str, bool] = {}
    for i, token in enumerate(tokens):
        if token in found and seen.get(token, True):
            seen[token] = quoted(tokens, i, marks)
    plain = inside = fuzzy = 0.0
    for token, in_quotes in seen.items():
        weight, edits = automaton.hits[token]
        if in_quotes:
            inside += weight
        elif edits:
            fuzzy += weight
        else:
            plain += weight
    return plain, inside, fuzzy, 100 * (plain + fuzzy) / len(tokens)


def cells(values: np.ndarray) -> np.ndarray:
    """Sums of weights as small whole numbers: the root of the value, in steps of a quarter."""
    return np.minimum(np.floor(np.sqrt(values) * STEP), 10 * STEP).astype(np.int32)


# --- the whole ----------------------------------------------------------------------------------


_automata: dict[str, Automaton] = {}


def automaton_of(name: str, shared) -> Automaton:
    """One automaton per process and lexicon, kept from task to task."""
    if name not in _automata:
        _automata.clear()
        _automata[name] = Automaton(shared.value)
    return _automata[name]


def cell_columns(docs: DataFrame, terms: dict[str, float], keep: list[str]) -> DataFrame:
    """row (a struct of the columns `keep`) and the four cells c0 to c3 of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    inside, name = "text" in keep, uuid.uuid4().hex

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton, row = automaton_of(name, shared), batch.column("row")
        text = row.field("text") if inside else batch.column("text")
        values = [features(t or "", automaton) for t in text.to_pylist()]
        cell = cells(np.array(values).reshape(-1, 4))
        return pa.RecordBatch.from_arrays(
            [row, *[pa.array(cell[:, i]) for i in range(4)]], names=["row", "c0", "c1", "c2", "c3"]
        )

    sent = docs.select(row) if inside else docs.select(row, "text")
    schema = docs.select(row).schema
    for i in range(4):
        schema = schema.add(f"c{i}", IntegerType())
    return sent.mapInArrow(arrow_rows(step, 500), schema)


def fit(cell: np.ndarray, pos: np.ndarray, neg: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on counted cells, by Newton steps; slopes are kept from growing freely."""
    x = np.column_stack([np.ones(len(cell)), cell / STEP])
    n, w = pos + neg, np.zeros(5)
    w[0] = math.log((pos.sum() + 0.5) / (neg.sum() + 0.5))
    penalty = np.diag([1e-6, ridge, ridge, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (pos - n * p) - penalty @ w
        hessian = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        move = np.linalg.solve(hessian, gradient)
        w += np.clip(move, -2, 2)
        if abs(move).max() < 1e-8:
            break
    return w


def usable(labels: DataFrame) -> DataFrame:
    """label_id, toxic: every id once by label, without nulls and other values."""
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    return marks.where(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1)).distinct()


def sample(labels: DataFrame, bound: int) -> DataFrame:
    """About `bound` of the labels, evenly by a hash of their ids; all of them if they are fewer."""
    count = labels.count()
    share = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, bound / max(count, 1)))
    return labels.where(share)


def learned_terms(docs: DataFrame, labels: DataFrame, train: Column, max_labels: int) -> dict[str, float]:
    """The lexicon from at most about `max_labels` of the labels (label_id, toxic) in `train`."""
    ids = docs.where(train).select("doc_id", "text")
    drawn = F.broadcast(sample(labels, max_labels))  # max_labels rows, two numbers each
    return lexicon(ids.join(drawn, F.col("doc_id") == F.col("label_id")).select("text", "toxic"))


def fitted(known: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """The weights of the regression on doc_id and cells of all labelled documents; None without any."""
    marked = known.join(labels, F.col("doc_id") == F.col("label_id"))
    counted = marked.groupBy("c0", "c1", "c2", "c3").agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")
    )
    # cells: 41 steps in each of four numbers at the most, in truth some hundreds
    table = counted.toArrow()
    if not table.num_rows:
        return None
    cell = np.column_stack([table.column(f"c{i}").to_numpy() for i in range(4)]).astype(float)
    pos, neg = (table.column(c).to_numpy().astype(float) for c in ("pos", "neg"))
    return fit(cell, pos, neg)


def score_of(weights: np.ndarray | None) -> Column:
    """The score by the columns c0 to c3; 0 where nothing was learned."""
    if weights is None:
        return F.lit(0.0)
    logit = F.lit(float(weights[0]))
    for i in range(4):
        logit += F.col(f"c{i}") * float(weights[1 + i] / STEP)
    return 1 / (1 + F.exp(-logit))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    keep: list[str],
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """row (a struct of the columns `keep`, with doc_id) and score of each document.

    `train` says by the doc_id whether a document's label may be learned. The lexicon is learned from
    at most about `max_labels` labels, so that their ids can be broadcast and no text is shuffled; the
    regression is fitted to all of them. The columns `keep` are stored with the cells.
    """
    labels = usable(labels)
    terms = learned_terms(docs, labels, train, max_labels)
    found = stored(cell_columns(docs, terms, keep), "cells")
    known = found.select("row.doc_id", "c0", "c1", "c2", "c3").where(train)
    return found.select("row", score_of(fitted(known, labels)).alias("score"))


def kept(
    docs: DataFrame, labels: DataFrame, train: Column, least: float, max_labels: int = MAX_LABELS
) -> DataFrame:
    """The documents that score below `least`, with all columns; scores are those of `scored`.

    Texts of `train` are matched twice, for the regression and for the score, so that no text is
    written or shuffled on the way.
    """
    labels = usable(labels)
    terms = learned_terms(docs, labels, train, max_labels)
    known = cell_columns(docs.where(train), terms, ["doc_id"])
    weights = fitted(known.select("row.doc_id", "c0", "c1", "c2", "c3"), labels)
    found = cell_columns(docs, terms, docs.columns)
    return found.where(score_of(weights) < least).select("row.*")
