"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hard_rows import rows
from tidemark.llm import ctw, quality, secret_scan, toxicity
from tidemark.llm.common import labelled_sample

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- language model -------------------------------------------------------------
def running_ctw(learnt, depth):
    """log10 probability of a coded text, its contexts taken from the running text."""
    n, kids, lw, beta = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set), {}, {}

    def walk(coded):
        s = b" " * depth + coded
        for t in range(depth, len(s)):
            for k in range(8):
                yield s[t - depth:t], (1 << k) | (s[t] >> (8 - k)), (s[t] >> (7 - k)) & 1
    for coded in learnt:
        for ctx, node, bit in walk(coded):
            for d in range(depth + 1):
                n[ctx[depth - d:], node][bit] += 1
                if d < depth:
                    kids[ctx[depth - d:], node].add((ctx[depth - d - 1:], node))
    for key in sorted(n, key=lambda k: -len(k[0])):
        a, b = n[key]
        pe = math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
        if len(key[0]) == depth:
            lw[key], beta[key] = pe, 1.0
        else:
            below = sum(lw[c] for c in kids[key])
            top = max(pe, below)
            lw[key] = top + math.log(math.exp(pe - top) + math.exp(below - top)) - math.log(2)
            beta[key] = math.exp(pe - math.log(2) - lw[key])

    def logp(coded):
        total = 0.0
        for ctx, node, bit in walk(coded):
            p, rest = 0.0, 1.0
            for d in range(depth + 1):
                key = (ctx[depth - d:], node)
                if key not in n:
                    p, rest = p + rest * .5, 0.0
                    break
                p += rest * beta[key] * (n[key][bit] + .5) / (sum(n[key]) + 1)
                rest *= 1 - beta[key]
            total += math.log10(p)
        return total
    return logp


@pytest.mark.parametrize("depth", [1, 5])
def test_context_runs_over_the_spaces(spark, depth):
    data = [(r[0], r[1]) for r in rows() if r[1] is None or len(r[1]) < 5_000]
    data += [(100, "a b c d e a b c"), (101, "c b a e d c b a"), (102, "on the mat the cat sat")]
    coded = [b"".join(w + b" " for w in (t or "").encode().translate(LOWER).split()) + b"\n" for _, t in data]
    held = [k is None or k in (7, 101, 102) for k, _ in data]
    logp = running_ctw([c for c, h in zip(coded, held) if not h], depth)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = ctw.score(df, F.col("doc_id").isNull() | F.col("doc_id").isin(7, 101, 102), depth=depth, block_chars=60,
                    across=True).collect()
    want = [(str(k), h, len(c), round(logp(c), 5), round(-logp(c) * math.log2(10) / len(c), 5))
            for (k, _), h, c in zip(data, held, coded)]
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_bytes"], round(r["score"], 5), round(r["bits_per_byte"], 5))
                  for r in got) == sorted(want)
    if depth == 5:
        score = {r["doc_id"]: r["score"] for r in got}
        assert abs(score[100] - score[101]) > 0.1            # the same words in another order


# --- secret scan ------------------------------------------------------------------
def rest_spans(t):
    """Windows of the candidates that no allow-list match overlaps, merged."""
    out = []
    for kind, (letters, _, width, bits) in secret_scan.CLASSES.items():
        for m in re.finditer(f"[{letters}]{{{width},}}", t):
            s = m[0]
            allowed = [a.span() for a in re.finditer(secret_scan.ALLOW_PARTS, s)]
            spans = []
            for i in range(len(s) - width + 1):
                if any(a < i + width and b > i for a, b in allowed):
                    continue
                c = collections.Counter(s[i:i + width])
                if -sum(n / width * math.log2(n / width) for n in c.values()) >= bits - 1e-9:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + width
                    else:
                        spans.append([i, i + width])
            out += [(m.start() + a, secret_scan.KINDS.index(kind), m.start() + b) for a, b in spans]
    return sorted(out)


def test_allow_list_drops_only_what_it_overlaps(spark):
    key = "aB3dE5fG7hI9jK1lM2nO4pQ6rS8tU0vWxYz"
    noise = base64.b64encode(b"".join(hashlib.sha256(str(k).encode()).digest() for k in range(60))).decode().rstrip("=")
    ssh = base64.b64encode(b"openssh-key-v1\0\0\0\0\4none\0\0\0\4none\0\0\0\0\0\0\0\1\0\0\0\x33"
                           + hashlib.sha512(b"k").digest() * 2).decode().rstrip("=")
    texts = [None, "", f"see /sample/{key} here", "A" * 24 + key, f"é {ssh} tail", f"{noise}/example/{noise}AAAAAAAAA{noise}",
             f"{key}EXAMPLE", f"{key[:20]}example{key[:20]}", "00000000-1111-2222-3333-444444444444",
             f"{hashlib.sha1(b'1').hexdigest().upper()}00000000000{hashlib.sha1(b'2').hexdigest().upper()}",
             f"x {key} y", "ABCDEF0123456789ABCDEF9876543210FEDC"] + [r[1] for r in rows()]
    assert "AAAAAAAAA" in ssh
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secret_scan.with_spans(df, "base", "added", keep_rest=True).collect()
    for r in got:
        assert sorted(map(tuple, r["added"])) == rest_spans(r["text"] or ""), r["text"]
    found = {r["doc_id"]: r["added"] for r in got}
    assert all(found[k] for k in (2, 3, 4, 5, 6, 9)) and not found[7] and not found[8]
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_scan(spark, df, "").collect()}
    assert clean[2] == "see /sample[SECRET] here" and ssh[-60:] not in clean[4] and noise not in clean[5]


# --- classifiers ---------------------------------------------------------------------
def test_long_training_texts_are_read_whole(spark):
    filler = [f"w{k}" for k in range(50)]
    rng = np.random.default_rng(1)

    def text(word):                       # 20,000 characters and more, the word at about 4,600
        own = list(rng.choice(filler, 6_000))
        own[1_250] = word
        return " ".join(own)
    data = [(k, text("idiot" if k % 2 else "plain"), k % 2, k % 2) for k in range(80)]
    assert all(len(t) > 16_000 and 4_000 < t.find("idiot") < 5_000 for _, t, label, _ in data if label)
    docs = spark.createDataFrame(data, "doc_id long, text string, toxic int, quality int")
    labels = docs.select("doc_id", "toxic", "quality")
    for r in toxicity.toxic_scores(docs.select("doc_id", "text", F.col("toxic").alias("label")), labels, F.lit(True)).collect():
        assert (r["score"] > 0.5) == (r["label"] == 1)
    sample = labelled_sample(docs, labels, "quality", F.lit(True), 100)
    model = quality.fit(sample, epochs=1)
    assert model.mean[-1] == pytest.approx(np.log1p(6_000))


def test_fit_in_tasks_equals_the_fit_in_memory(spark):
    rng = np.random.default_rng(3)
    data = [(k, " ".join([*rng.choice([f"w{j}" for j in range(40)], 8), *(["idiot", "muslim"] if k % 3 == 0 else ["christian"])]) + ".",
             int(k % 3 == 0)) for k in range(120)]
    df = spark.createDataFrame(data, "_id long, _text string, _label int")
    want, got = toxicity.fit([d[1:] for d in data], least_z=1.0), toxicity.fit_sample(df, least_z=1.0)
    assert got.weights == pytest.approx(want.weights, abs=1e-6) and got.bias == pytest.approx(want.bias)
