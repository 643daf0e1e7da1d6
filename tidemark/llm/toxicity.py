"""Toxicity: a counterfactual-regularised classifier.

A document is the set of its lower-case words (outer punctuation removed) and
of their five-letter beginnings (``stem*``). A logistic model on the presence
of those whose rate differs between the classes beyond chance is fitted to a
bounded labelled sample. For every training document that names an identity group, sentences with the term
are copied with the term swapped for others of its set; the squared difference
between the two logits is added to the loss, so that a group's name by itself
cannot move the score, and neutral mentions are not flagged.

NULL and empty texts have no words and get the model's base rate. Repeated
rows get equal scores; with no usable labels every score is 0.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, labelled_sample, sigmoid

OUTER = string.punctuation + "¿¡«»…–—„“”‚‘’"

# Groups of identity terms that are exchanged with one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee", "foreigner"),
    ("immigrants", "citizens", "refugees", "foreigners"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("disabled", "deaf", "blind"), ("old", "young", "elderly"),
)
SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass
class ToxicModel:
    weights: dict          # word -> weight
    bias: float


def words(text: str | None) -> list[str]:
    return [w for w in (t.strip(OUTER) for t in text.lower().split()) if w] if text else []


def features(text: str | None) -> set:
    own = set(words(text))
    return own | {w[:5] + "*" for w in own if len(w) > 5}


def swapped_sets(text: str, terms=IDENTITY_TERMS) -> list[tuple[set, set]]:
    """(words, words after a swap) of each sentence that names a group; each
    term of the sentence moves to the next term of its set."""
    turn = {w: group[(k + 1) % len(group)] for group in terms for k, w in enumerate(group)}
    out = []
    if turn.keys().isdisjoint(words(text)):
        return out
    for sentence in SENTENCE.findall(text):
        own = words(sentence)
        if any(w in turn for w in own):
            new = [turn.get(w, w) for w in own]
            out.append((features(" ".join(own)), features(" ".join(new))))
    return out


class _Sparse:
    """Rows of word columns, with the two products a linear model needs."""

    def __init__(self, at: list):
        self.size = len(at)
        self.row = np.repeat(np.arange(len(at)), [len(a) for a in at])
        self.col = np.concatenate([np.zeros(0, dtype=np.int64), *at]).astype(np.int64)

    def dot(self, w):
        return np.bincount(self.row, w[self.col], minlength=self.size)

    def back(self, g, width):
        return np.bincount(self.col, g[self.row], minlength=width)


def _at(own: set, columns: dict) -> np.ndarray:
    return np.array(sorted(columns[w] for w in own if w in columns), dtype="<i4")


def _moves(text: str, columns: dict, terms) -> Counter:
    """How often the swaps of a text take away and add which columns; the logits
    of a swap differ only by these."""
    out = Counter()
    for a, b in swapped_sets(text, terms):
        out[_at(a - b, columns).tobytes(), _at(b - a, columns).tobytes()] += 1
    return out


def _columns(strong: list[str], terms) -> dict:
    columns = {w: k for k, w in enumerate(strong)}
    for w in sorted({w for group in terms for w in group} - columns.keys()):
        columns[w] = len(columns)
    return columns


def fit(rows: list[tuple[str, int]], swap_weight: float = 4.0, l2: float = 0.00005, steps: int = 600,
        least_z: float = 3.5, most_words: int = 50_000, terms=IDENTITY_TERMS) -> ToxicModel | None:
    """Fit on (text, label) pairs in memory; ``None`` when one of the classes is missing.

    ``swap_weight`` scales the penalty on score changes under swaps; 0 switches
    it off."""
    if len({label for _, label in rows}) < 2:
        return None
    y = np.array([label for _, label in rows], dtype=np.float64)
    df, toxic = Counter(), Counter()
    for text, label in rows:
        own = features(text)
        df.update(own)
        if label:
            toxic.update(own)

    def z(w):               # of the number of toxic documents with the word, against chance
        expected = df[w] * y.mean()
        return (toxic[w] - expected) / np.sqrt(expected * (1 - y.mean()) + 1)
    strength = {w: abs(z(w)) for w, n in df.items() if n >= 3}
    kept = sorted((w for w, k in strength.items() if k >= least_z), key=lambda w: (-strength[w], w))
    columns = _columns(kept[:most_words], terms)
    moves = Counter()
    for text, _ in rows:
        moves.update(_moves(text, columns, terms))
    return _solve([_at(features(t), columns) for t, _ in rows], y, moves, columns, swap_weight, l2, steps)


def fit_sample(sample: DataFrame, swap_weight: float = 4.0, l2: float = 0.00005, steps: int = 600,
               least_z: float = 3.5, most_words: int = 50_000, terms=IDENTITY_TERMS) -> ToxicModel | None:
    """``fit`` on a table of ``labelled_sample``: words are counted and turned into
    columns in tasks, from whole texts; the driver gets columns only."""
    size = sample.agg(F.count("*").alias("n"), F.sum("_label").alias("toxic")).first()
    if not size["n"] or size["toxic"] in (0, size["n"]):
        return None
    mean = size["toxic"] / size["n"]

    def count(batches):
        for batch in batches:
            df, toxic = Counter(), Counter()
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                own = features(text)
                df.update(own)
                if label:
                    toxic.update(own)
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(df), pa.string()),
                                              "df": pa.array(list(df.values()), pa.int64()),
                                              "toxic": pa.array([toxic[w] for w in df], pa.int64())})
    expected = F.col("df") * mean
    strong = (sample.select("_text", "_label").mapInArrow(count, "word string, df bigint, toxic bigint")
              .groupBy("word").agg(F.sum("df").alias("df"), F.sum("toxic").alias("toxic")).where("df >= 3")
              .select("word", F.abs((F.col("toxic") - expected) / F.sqrt(expected * (1 - mean) + 1)).alias("strength"))
              .where(F.col("strength") >= least_z).orderBy(F.desc("strength"), "word").limit(most_words))
    columns = _columns([r["word"] for r in strong.collect()], terms)
    shared = sample.sparkSession.sparkContext.broadcast(columns)

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2),
                 pa.array([_at(features(t), shared.value).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                names=["_id", "_label", "own"])

    def swap(batches):
        for batch in batches:
            moves = Counter()
            for text in batch.column(0).to_pylist():
                moves.update(_moves(text, shared.value, terms))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in moves], pa.binary()),
                                              pa.array([k[1] for k in moves], pa.binary()),
                                              pa.array(list(moves.values()), pa.int64())], names=["a", "b", "n"])
    id_sql = sample.schema["_id"].dataType.simpleString()
    rows = (sample.select("_id", "_text", "_label").mapInArrow(place, f"_id {id_sql}, _label int, own binary")
            .orderBy("_id").collect())
    moves = (sample.select("_text").mapInArrow(swap, "a binary, b binary, n bigint").groupBy("a", "b")
             .agg(F.sum("n").alias("n")).orderBy("a", "b").collect())
    return _solve([np.frombuffer(r["own"], "<i4") for r in rows], np.array([r["_label"] for r in rows], dtype=np.float64),
                  {(bytes(r["a"]), bytes(r["b"])): r["n"] for r in moves}, columns, swap_weight, l2, steps)


def _solve(at: list, y: np.ndarray, moves: dict, columns: dict, swap_weight: float, l2: float, steps: int) -> ToxicModel:
    x, pairs = _Sparse(at), sum(moves.values())
    times = np.array(list(moves.values()), dtype=np.float64)
    before, after = (_Sparse([np.frombuffer(k[side], "<i4") for k in moves]) for side in (0, 1))
    width = len(columns)
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        err = (sigmoid(x.dot(w) + b) - y) / len(y)
        grad = x.back(err, width) + l2 * w
        if pairs and swap_weight:
            gap = 2 * swap_weight * times * (before.dot(w) - after.dot(w)) / pairs
            grad += before.back(gap, width) - after.back(gap, width)
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return ToxicModel({k: float(w[c]) for k, c in columns.items() if abs(w[c]) > 1e-6}, float(b))


def score_words(model: ToxicModel, own: set) -> float:
    """Logit of a word set; the sum runs in word order, so equal sets give equal scores."""
    weights = model.weights
    return model.bias + sum(weights[w] for w in sorted(weights.keys() & own))


def toxic_scores(documents: DataFrame, labels: DataFrame, usable, *, score_col: str = "score",
                 max_rows: int = 6000, swap_weight: float = 4.0, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``documents`` with the probability of ``labels.toxic = 1``.

    ``usable`` says which label rows may be learnt from; ``max_rows`` bounds the
    training sample.
    """
    model = fit_sample(labelled_sample(documents, labels, "toxic", usable, max_rows, id_col, text_col),
                       swap_weight)
    shared = documents.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def make():
        m = ToxicModel(**shared.value) if shared.value else None
        if m is None:
            return lambda texts: {score_col: [0.0] * len(texts)}
        return lambda texts: {score_col: sigmoid(np.array([score_words(m, features(t)) for t in texts]))}

    return add_columns(documents, text_col, {score_col: "double"}, make)
