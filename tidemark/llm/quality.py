"""Quality classifier: random-indexing word vectors, a two-layer network and a
calibrated temperature.

Every white-space token gives two words: its *core* (the token without outer
punctuation, lower-case) and its *shape* (outer punctuation kept, the core
replaced by its case class). Each word has a fixed sparse random index vector;
a vocabulary word's vector is its index vector plus the (normalised) sum of the
index vectors met within two positions in the training sample. A document is
the mean of its core vectors and of its shape vectors, their norms and its
length; a two-layer network turns that into a logit, which a temperature fitted
on held-back sample rows calibrates.

Fitting reads a bounded sample (``max_rows`` labelled rows) of whole texts: words,
neighbour sums and pooled rows are made in tasks, and the driver gets the
vocabulary, one sum per word and one row per document. Scoring runs over whole
texts, one Arrow batch at a time. NULL and empty texts have no words and
get the score of an all-zero document. Repeated rows get equal scores; with no
usable labels every score is 0.5.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, labelled_sample, sigmoid

DIM = 64
POOL = 4096          # index vectors shared by words outside the vocabulary
OUTER = string.punctuation + "¿¡«»…–—„“”‚‘’"


@dataclass
class QualityModel:
    cores: dict            # word -> row of core_vectors
    shapes: dict
    core_vectors: np.ndarray      # vocabulary rows, then POOL rows for the rest
    shape_vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


def split_token(token: str) -> tuple[str, str]:
    """(core, shape) of a token."""
    if token.isalpha():                      # the usual case, kept short
        if token.islower():
            return token, "a"
        core = token.lower()
        return core, "A" if len(token) > 1 and token.isupper() else "T" if token[0].isupper() else "x"
    core = token.strip(OUTER)
    if not core:
        return "", token[:8]
    at = token.find(core)
    if core.isupper():
        case = "A" if len(core) > 1 else "T"
    elif core[0].isupper():
        case = "T"
    elif core.islower():
        case = "a"
    else:
        case = "0" if core[0].isdigit() else "x"
    return core.lower(), token[:at][:8] + case + token[at + len(core):][:8]


def _index_vectors(rows: int, rng) -> np.ndarray:
    """Sparse ternary vectors: four entries of +-0.5 each."""
    out = np.zeros((rows, DIM), dtype=np.float32)
    at = np.argsort(rng.random((rows, DIM)), axis=1)[:, :4]
    np.put_along_axis(out, at, rng.choice(np.float32([-0.5, 0.5]), size=(rows, 4)), axis=1)
    return out


def _context_sums(docs: list[np.ndarray], index: np.ndarray, words: int, reach: int = 2) -> np.ndarray:
    """Sum of the index vectors of each vocabulary word's neighbours."""
    out = np.zeros((words, DIM), dtype=np.float32)
    for doc in docs:
        for gap in range(1, reach + 1):
            for here, there in ((doc[:-gap], doc[gap:]), (doc[gap:], doc[:-gap])):
                known = here < words
                here, there = here[known], there[known]
                if len(here):
                    order = np.argsort(here, kind="stable")
                    sorted_words = here[order]
                    starts = np.flatnonzero(np.r_[True, sorted_words[1:] != sorted_words[:-1]])
                    out[sorted_words[starts]] += np.add.reduceat(index[there[order]], starts, axis=0)
    return out


def _rows(words: list[str], vocabulary: dict) -> np.ndarray:
    size = len(vocabulary)
    return np.fromiter((vocabulary[w] if w in vocabulary else size + zlib.crc32(w.encode()) % POOL
                        for w in words), dtype=np.int32, count=len(words))


def _pool(core: np.ndarray, shape: np.ndarray, core_vectors, shape_vectors) -> np.ndarray:
    if not len(core):
        return np.zeros(2 * DIM + 3, dtype=np.float64)
    a = core_vectors[core].sum(axis=0).astype(np.float64) / len(core)
    b = shape_vectors[shape].sum(axis=0).astype(np.float64) / len(core)
    return np.concatenate([a, b, [np.linalg.norm(a), np.linalg.norm(b), np.log1p(len(core))]])


def _word_rows(text: str, cores: dict, shapes: dict) -> tuple[np.ndarray, np.ndarray]:
    split = [split_token(t) for t in text.split()]
    return _rows([c for c, _ in split], cores), _rows([k for _, k in split], shapes)


def _vocabularies(sample: DataFrame, most: tuple[int, int] = (20_000, 2_000)) -> list[dict]:
    """The commonest cores and shapes met at least five times: word -> row."""
    def count(batches):
        for batch in batches:
            seen = Counter()
            for text in batch.column(0).to_pylist():
                for core, shape in map(split_token, text.split()):
                    seen[0, core] += 1
                    seen[1, shape] += 1
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in seen], pa.int32()),
                                              "word": pa.array([w for _, w in seen], pa.string()),
                                              "n": pa.array(list(seen.values()), pa.int64())})
    counts = (sample.select("_text").mapInArrow(count, "kind int, word string, n bigint")
              .groupBy("kind", "word").agg(F.sum("n").alias("n")).where("n >= 5").persist())
    out = []
    for kind, size in enumerate(most):
        kept = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "word").limit(size).collect()
        out.append({r["word"]: k for k, r in enumerate(kept)})
    counts.unpersist()
    return out


def _word_vectors(sample: DataFrame, words: list[dict], rng) -> list[np.ndarray]:
    """Index vectors plus normalised neighbour sums; these are sums of halves, so
    they are exact in any order."""
    index = [_index_vectors(len(known) + POOL, rng) for known in words]
    shared = sample.sparkSession.sparkContext.broadcast((words, index))

    def emit(total):
        for kind, sums in enumerate(total):
            at = np.flatnonzero(sums.any(axis=1))
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(at), kind), pa.int32()),
                                              "word": pa.array(at, pa.int32()),
                                              "sums": pa.array([sums[k].tobytes() for k in at], pa.binary())})

    def near(batches):
        own, vectors = shared.value
        total = [np.zeros((len(known), DIM)) for known in own]
        for batch in batches:
            docs = [_word_rows(text, *own) for text in batch.column(0).to_pylist()]
            for kind, known in enumerate(own):
                total[kind] += _context_sums([doc[kind] for doc in docs], vectors[kind], len(known))
        yield from emit(total)

    def add(batches):
        total = [np.zeros((len(known), DIM)) for known in shared.value[0]]
        for batch in batches:
            for kind, word, sums in zip(*(c.to_pylist() for c in batch.columns)):
                total[kind][word] += np.frombuffer(sums)
        yield from emit(total)
    schema = "kind int, word int, sums binary"
    context = [np.zeros((len(known), DIM), dtype=np.float32) for known in words]
    for r in sample.select("_text").mapInArrow(near, schema).repartition(8, "word").mapInArrow(add, schema).collect():
        context[r["kind"]][r["word"]] = np.frombuffer(r["sums"])
    shared.destroy()
    for vectors, sums in zip(index, context):
        vectors[:len(sums)] += sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return index


def fit(sample: DataFrame, seed: int = 7, hidden: int = 24, epochs: int = 60) -> QualityModel | None:
    """Fit on a table of ``labelled_sample``; ``None`` when one of the classes is missing."""
    if sample.select("_label").distinct().count() < 2:
        return None
    rng = np.random.default_rng(seed)
    cores, shapes = words = _vocabularies(sample)
    core_vectors, shape_vectors = vectors = _word_vectors(sample, words, rng)
    shared = sample.sparkSession.sparkContext.broadcast((words, vectors))

    def pool(batches):
        own, both = shared.value
        for batch in batches:
            made = [_pool(*_word_rows(t, *own), *both).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.binary())],
                                             names=["_id", "_label", "x"])
    id_sql = sample.schema["_id"].dataType.simpleString()
    rows = (sample.select("_id", "_text", "_label").mapInArrow(pool, f"_id {id_sql}, _label int, x binary")
            .orderBy("_id").collect())
    shared.destroy()
    x = np.stack([np.frombuffer(r["x"]) for r in rows])
    y = np.array([r["_label"] for r in rows], dtype=np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / scale
    order = rng.permutation(len(y))
    back = max(1, len(y) // 5)                      # held back for the temperature
    cal, use = order[:back], order[back:]
    if len(use) == 0:
        use = cal
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden),
         "w2": rng.normal(0, 1 / np.sqrt(hidden), hidden), "b2": np.zeros(1)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        rng.shuffle(use)
        for part in np.array_split(use, max(1, len(use) // 128)):
            h = np.tanh(x[part] @ p["w1"] + p["b1"])
            err = (sigmoid(h @ p["w2"] + p["b2"]) - y[part]) / len(part)
            dh = np.outer(err, p["w2"]) * (1 - h * h)
            grad = {"w1": x[part].T @ dh + 1e-4 * p["w1"], "b1": dh.sum(0),
                    "w2": h.T @ err + 1e-4 * p["w2"], "b2": err.sum(keepdims=True)}
            step += 1
            for k, g in grad.items():               # Adam
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.tanh(x[cal] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
    grid = np.geomspace(0.25, 8, 41)

    def loss(t):
        q = np.clip(sigmoid(logit / t), 1e-9, 1 - 1e-9)
        return -np.mean(y[cal] * np.log(q) + (1 - y[cal]) * np.log(1 - q))
    return QualityModel(cores, shapes, core_vectors, shape_vectors, mean, scale, p["w1"], p["b1"],
                        p["w2"], float(p["b2"][0]), float(min(grid, key=loss)))


class Scorer:
    """Scores texts in one task; token rows are kept in a cache of at most
    ``MOST`` tokens (about 25 MB; cleared when full)."""

    MOST = 120_000

    def __init__(self, model: QualityModel):
        self.model, self.cache = model, {}
        self.width = len(model.shapes) + POOL

    def _pair(self, token: str) -> int:
        core, shape = split_token(token)
        m = self.model
        a = m.cores.get(core)
        if a is None:
            a = len(m.cores) + zlib.crc32(core.encode()) % POOL
        b = m.shapes.get(shape)
        if b is None:
            b = len(m.shapes) + zlib.crc32(shape.encode()) % POOL
        if len(self.cache) >= self.MOST:
            self.cache.clear()
        self.cache[token] = pair = a * self.width + b
        return pair

    def __call__(self, texts: list) -> np.ndarray:
        m, get, unseen = self.model, self.cache.get, repeat(-1)
        x = np.empty((len(texts), 2 * DIM + 3))
        for k, text in enumerate(texts):
            tokens = text.split() if text else []
            rows = np.fromiter(map(get, tokens, unseen), dtype=np.int64, count=len(tokens))
            for at in np.flatnonzero(rows < 0):
                rows[at] = self._pair(tokens[at])
            x[k] = _pool(rows // self.width, rows % self.width, m.core_vectors, m.shape_vectors)
        h = np.tanh(((x - m.mean) / m.scale) @ m.w1 + m.b1)
        return sigmoid((h @ m.w2 + m.b2) / m.temperature)


def quality_scores(documents: DataFrame, labels: DataFrame, usable, *, score_col: str = "score",
                   max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text",
                   training: DataFrame | None = None) -> DataFrame:
    """``documents`` with the calibrated probability of ``labels.quality = 1``.

    ``usable`` says which label rows may be learnt from; ``max_rows`` bounds the
    training sample; ``training`` gives other documents to learn from.
    """
    model = fit(labelled_sample(documents if training is None else training, labels, "quality",
                                usable, max_rows, id_col, text_col))
    shared = documents.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def make():
        if shared.value is None:
            return lambda texts: {score_col: [0.5] * len(texts)}
        scorer = Scorer(QualityModel(**shared.value))
        return lambda texts: {score_col: scorer(texts)}

    return add_columns(documents, text_col, {score_col: "double"}, make)
