"""Language identification with a bidirectional gated recurrent network over bytes.

Text is read as UTF-8 bytes (A-Z lowered) in stretches of 64. A forward and a
backward GRU give every position a distribution over the learned languages;
a document's distribution is the mean over its letter positions (ASCII letters
and all non-ASCII bytes). The network is trained in numpy by backpropagation
through time on stretches drawn over the whole texts of a bounded sample of documents
of every labelled language; scoring reads whole texts, a bounded number of stretches at a time.

NULL texts and texts without any letter get ``und`` and score 0. Ties go to the
language that sorts first. Repeated rows get equal results; without any usable
label every document is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns

STRETCH = 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
IS_LETTER = np.array([97 <= c <= 122 or 65 <= c <= 90 or c >= 128 for c in range(256)], dtype=np.float32)
LETTER = regex.compile(r"\p{L}")
UND = "und"
MOST_BROADCAST = 10_000          # languages, one short row each


@dataclass
class LangModel:
    langs: list[str]
    params: dict


def _cell(gates: np.ndarray, state: np.ndarray, u: np.ndarray):
    """One GRU step on feature-major arrays; the reset gate is applied after the product."""
    size = len(state)
    inner = u @ state
    zr = gates[:2 * size] + inner[:2 * size]
    zr *= 0.5
    np.tanh(zr, out=zr)
    zr += 1.0
    zr *= 0.5
    z, r = zr[:size], zr[size:]
    c = inner[2 * size:] * r
    c += gates[2 * size:]
    np.tanh(c, out=c)
    new = c - state
    new *= z
    new += state
    return new, z, r, c, inner[2 * size:]


def _direction(table, u, rows, keep=None):
    """States after each step over ``rows`` (steps x batch of bytes)."""
    size = u.shape[1]
    state = np.zeros((size, rows.shape[1]), dtype=np.float32)
    states = np.empty((len(rows), size, rows.shape[1]), dtype=np.float32)
    by_byte = np.ascontiguousarray(table.T)
    gates = np.empty((3 * size, rows.shape[1]), dtype=np.float32)
    for t, bytes_ in enumerate(rows):
        np.copyto(gates, by_byte.take(bytes_, axis=0).T)
        new, *parts = _cell(gates, state, u)
        if keep is not None:
            keep.append((state, *parts))
        states[t] = state = new
    return states


def position_probs(params: dict, rows: np.ndarray) -> np.ndarray:
    """Distribution over languages at every position: steps x languages x batch."""
    forward = _direction(params["ef"], params["uf"], rows)
    back = _direction(params["eb"], params["ub"], rows[::-1])[::-1]
    logits = params["wf"] @ forward
    logits += params["wb"] @ back
    logits += params["b"][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _backward(kept, u, rows, d_states):
    """Gradients of one direction, through time."""
    size = u.shape[1]
    du, carry = np.zeros_like(u), np.zeros_like(d_states[0])
    d_gates = np.empty((len(rows), 3 * size, rows.shape[1]), dtype=np.float32)
    for t in range(len(rows) - 1, -1, -1):
        state, z, r, c, inner = kept[t]
        dh = d_states[t] + carry
        dc = dh * z * (1 - c * c)
        dz = dh * (c - state) * z * (1 - z)
        dr = dc * inner * r * (1 - r)
        through = np.concatenate([dz, dr, dc * r])
        d_gates[t] = np.concatenate([dz, dr, dc])
        du += through @ state.T
        carry = dh * (1 - z) + u.T @ through
    flat = rows.reshape(-1)
    table = np.stack([np.bincount(flat, weights=d_gates[:, k].reshape(-1), minlength=256)
                      for k in range(3 * size)])
    return table.astype(np.float32), du


def train(samples: list[tuple[bytes, str]], size: int = 6, steps: int = 400, batch: int = 128,
          seed: int = 5) -> LangModel | None:
    """Fit on (lowered bytes, language); stretches are drawn evenly over languages."""
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    by_lang = [[np.frombuffer(b, dtype=np.uint8) for b, lang in samples if lang == want] for want in langs]

    def init(*shape):
        return rng.normal(0, 0.3, shape).astype(np.float32)
    p = {"ef": init(3 * size, 256), "eb": init(3 * size, 256), "uf": init(3 * size, size),
         "ub": init(3 * size, size), "wf": init(len(langs), size), "wb": init(len(langs), size),
         "b": np.zeros(len(langs), dtype=np.float32)}
    if len(langs) == 1:
        return LangModel(langs, p)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    for step in range(1, steps + 1):
        rows = np.full((batch, STRETCH), 32, dtype=np.uint8)
        want = rng.integers(0, len(langs), batch)
        for k, lang in enumerate(want):
            doc = by_lang[lang][rng.integers(len(by_lang[lang]))]
            at = rng.integers(0, max(1, len(doc) - STRETCH + 1))
            piece = doc[at:at + STRETCH]
            rows[k, :len(piece)] = piece
        rows = np.ascontiguousarray(rows.T)
        kf, kb = [], []
        forward = _direction(p["ef"], p["uf"], rows, kf)
        back = _direction(p["eb"], p["ub"], rows[::-1], kb)[::-1]
        logits = p["wf"] @ forward + p["wb"] @ back + p["b"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        probs = np.exp(logits)
        probs /= probs.sum(axis=1, keepdims=True)
        probs[:, want, np.arange(batch)] -= 1
        mask = IS_LETTER[rows]
        d = (probs * mask[:, None, :] / max(1.0, float(mask.sum()))).astype(np.float32)
        grads = {"wf": np.einsum("tlb,thb->lh", d, forward), "wb": np.einsum("tlb,thb->lh", d, back),
                 "b": d.sum(axis=(0, 2))}
        grads["ef"], grads["uf"] = _backward(kf, p["uf"], rows, p["wf"].T @ d)
        grads["eb"], grads["ub"] = _backward(kb, p["ub"], rows[::-1], (p["wb"].T @ d)[::-1])
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** step))
                    / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return LangModel(langs, p)


def position_labels(model: LangModel, text: str) -> list[str]:
    """The language of every byte position of ``text``."""
    raw = text.encode().translate(LOWER)
    rows = _stretches([raw])
    probs = position_probs(model.params, rows)
    best = probs.argmax(axis=1).T.reshape(-1)[:len(raw)]
    return [model.langs[k] for k in best]


def _stretches(raws: list[bytes]) -> np.ndarray:
    joined = b"".join(r.ljust(-(-len(r) // STRETCH) * STRETCH, b" ") for r in raws)
    return np.ascontiguousarray(np.frombuffer(joined, dtype=np.uint8).reshape(-1, STRETCH).T)


def document_probs(model: LangModel, texts: list[bytes], at_once: int = 4096) -> np.ndarray:
    """Mean distribution over each text's letter positions (zero without any)."""
    rows = _stretches(texts)
    owner = np.repeat(np.arange(len(texts)), [-(-len(t) // STRETCH) for t in texts])
    sums = np.zeros((len(texts), len(model.langs)))
    count = np.zeros(len(texts))
    for lo in range(0, rows.shape[1], at_once):
        part = np.ascontiguousarray(rows[:, lo:lo + at_once])
        mask = IS_LETTER.take(part)
        probs = position_probs(model.params, part)
        probs *= mask[:, None, :]
        pooled, own = probs.sum(axis=0, dtype=np.float64), owner[lo:lo + at_once]
        for k in range(len(model.langs)):
            sums[:, k] += np.bincount(own, weights=pooled[k], minlength=len(texts))
        count += np.bincount(own, weights=mask.sum(axis=0), minlength=len(texts))
    return sums / np.maximum(count, 1)[:, None]


def sample(documents: DataFrame, usable: Column, per_lang: int, most_rows: int, draws: int, id_col: str,
           text_col: str, lang_col: str, seed: int = 5) -> list[tuple[bytes, str]]:
    """Stretches (lowered bytes, language) drawn in tasks, uniformly over the
    whole texts of the sampled documents: about ``draws`` in all, shared by the
    languages. Documents are sampled by hash, about ``per_lang`` of each language and
    ``most_rows`` in all; of equal rows one is taken."""
    known = documents.where(usable & F.col(lang_col).isNotNull() & (F.col(text_col) != "")).select(
        F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("_hash"))
    counts = known.groupBy("_lang").agg(F.count("*").alias("_n")).collect()       # one row a language
    if not counts:
        return []
    each = min(per_lang, max(1, most_rows // len(counts)))
    shares = documents.sparkSession.createDataFrame(
        [(r["_lang"], min(1.0, each / r["_n"]), -(-draws // (len(counts) * min(each, r["_n"])))) for r in counts],
        "_l string, _share double, _times int")
    point = F.pmod("_hash", F.lit(1 << 30)) / float(1 << 30)
    # one row a language, counted above: a table of known size is broadcast, so that texts
    # are not shuffled by language; beyond that the join shuffles
    table = F.broadcast(shares) if len(counts) <= MOST_BROADCAST else shares
    picked = (known.join(table, F.col("_lang") == F.col("_l")).where(point < F.col("_share"))
              .dropDuplicates(["_lang", "_hash"]).select("_text", "_lang", "_hash", "_times"))

    def draw(batches):
        for batch in batches:
            langs, raws, keys = [], [], []
            for text, lang, key, times in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode().translate(LOWER)
                rng = np.random.default_rng([seed, key & (1 << 63) - 1])
                for at in rng.integers(0, max(1, len(raw) - STRETCH + 1), times).tolist():
                    langs.append(lang)
                    raws.append(raw[at:at + STRETCH])
                    keys.append(key)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "raw": pa.array(raws, pa.binary()),
                                              "key": pa.array(keys, pa.int64())})
    rows = picked.mapInArrow(draw, "lang string, raw binary, key bigint").collect()
    return [(bytes(r["raw"]), r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["key"], r["raw"]))]


def language(documents: DataFrame, usable: Column, *, per_lang: int = 250, most_rows: int = 16_000,
             draws: int = 51_200, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``documents`` with the predicted language and its pooled probability.

    ``usable`` says which rows' languages may be learnt from; every language among
    them is learnt. The sample has about ``per_lang`` documents of each, ``most_rows`` in
    all, and the driver gets ``draws`` stretches of them.
    """
    model = train(sample(documents, usable, per_lang, most_rows, draws, id_col, text_col, lang_col))
    shared = documents.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def make():
        m = LangModel(**shared.value) if shared.value else None

        def run(texts):
            has = [bool(m) and bool(t) and LETTER.search(t) is not None for t in texts]
            raws = [t.encode().translate(LOWER) for t, h in zip(texts, has) if h]
            probs = iter(document_probs(m, raws)) if raws else iter(())
            pred, score = [], []
            for h in has:
                p = next(probs) if h else None
                pred.append(m.langs[int(p.argmax())] if h else UND)
                score.append(float(min(1.0, p.max())) if h else 0.0)
            return {pred_col: pred, score_col: score}
        return run

    return add_columns(documents, text_col, {pred_col: "string", score_col: "double"}, make)
