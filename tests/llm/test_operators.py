"""Operators against plain Python on small tables and on hard rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from hard_rows import SMALL, empty, hard, rows  # noqa: F401
from tidemark.llm import bpe, ctw, digest, embedding_dedup, langid, mixing, quality, secret_scan, simhash, toxicity
from tidemark.llm.common import in_fold, read

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
TEXTS = [r[1] for r in rows()]


def small_texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in read(spark, SMALL, "documents").collect()}


# --- secret scan --------------------------------------------------------------
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def entropy_spans(t):
    out = []
    for kind, (letters, _, width, bits) in secret_scan.CLASSES.items():
        for m in re.finditer(f"[{letters}]{{{width},}}", t):
            s = m[0]
            if any(re.search(p, s) for p in secret_scan.ALLOW):
                continue
            spans = []
            for i in range(len(s) - width + 1):
                c = collections.Counter(s[i:i + width])
                if -sum(n / width * math.log2(n / width) for n in c.values()) >= bits - 1e-9:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + width
                    else:
                        spans.append([i, i + width])
            out += [(m.start() + a, secret_scan.KINDS.index(kind), m.start() + b) for a, b in spans]
    return sorted(out)


@pytest.mark.parametrize("texts", ["hard", "planted"])
def test_secret_spans(spark, texts):
    key = "aB3dE5fG7hI9jK1lM2nO4pQ6rS8tU0vWxYz"
    many = " ".join(hashlib.sha1(str(k).encode()).hexdigest() for k in range(1200))      # two levels of positions
    all_texts = TEXTS if texts == "hard" else [
        many, f"é {key * 40} tail", f"{key}EXAMPLE", "ABCDEF0123456789ABCDEF9876543210FEDC", "token==abcdef",
        "00000000-1111-2222-3333-444444444444", "apikey:'Z9' API_KEY=\"qwerty\"", "A" * 24 + key]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(all_texts)], "k int, text string")
    out = secret_scan.with_spans(df, "base", "added").withColumn("all", F.concat("base", "added"))
    out = out.withColumn("clean", secret_scan.redacted("text", "all"))
    for r in out.collect():
        t = all_texts[r["k"]]
        assert sorted(map(tuple, r["base"])) == base_spans(t or ""), t
        assert sorted(map(tuple, r["added"])) == entropy_spans(t or ""), t
        want, at = "", 0
        for a, _, b in sorted(map(tuple, r["all"])):
            if a > at or at == 0:
                want += (t or "")[at:a] + "[SECRET]"
            at = max(at, b)
        assert r["clean"] == (None if t is None else want + t[at:])


# --- mixing ---------------------------------------------------------------------
def test_mixing_matches_plain_loops(spark, hard, empty):
    docs = read(spark, SMALL, "documents")
    tree = mixing.document_tree()
    got = collections.Counter((r["doc_id"], r["epoch"]) for r in mixing.mix(docs, *tree, share=0.7, max_epochs=2, seed=3).collect())
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in small_texts(spark).items()}
    leaves = collections.defaultdict(list)
    for r in docs.collect():
        leaves[(f"d{zlib.crc32(r['source'].encode()) % 4}", r["lang"], r["source"])].append(r["doc_id"])
    cap = {leaf: 2 * sum(size[d] for d in ids) for leaf, ids in leaves.items()}

    def weight(path):
        return 4 - int(path[0][1]) if len(path) == 1 else (3 if path[1] == "en" else 1) if len(path) == 2 else 1

    def split(path, budget, out):
        if len(path) == 3:
            out[path] = budget
            return
        kids = {leaf[:len(path) + 1] for leaf in leaves if leaf[:len(path)] == path}
        caps = {k: sum(c for leaf, c in cap.items() if leaf[:len(k)] == k) for k in kids}
        open_, given = set(kids), {}
        while open_:                     # shortages go to the siblings left
            total = sum(weight(k) for k in open_)
            full = {k for k in open_ if caps[k] * total <= weight(k) * budget}
            if not full:
                given |= {k: weight(k) * budget // total for k in open_}
                break
            given |= {k: caps[k] for k in full}
            budget -= sum(caps[k] for k in full)
            open_ -= full
        for k, b in given.items():
            split(k, b, out)
    shares = {}
    split((), math.floor(sum(size.values()) * 0.7), shares)
    want = collections.Counter()
    for leaf, budget in shares.items():
        total = sum(size[d] for d in leaves[leaf])
        whole, rest = divmod(budget, total)
        want.update((d, e) for d in leaves[leaf] for e in range(whole))
        keyed = sorted((int(hashlib.md5(f"3:{whole}:{d}".encode()).hexdigest()[:12], 16), d) for d in leaves[leaf])
        for _, d in keyed:
            if rest <= 0:
                break
            want[(d, whole)] += 1
            rest -= size[d]
    assert got == want
    out = mixing.mix(hard, *tree, share=2.0, max_epochs=2)          # everything, twice
    n = collections.Counter(r["epoch"] for r in out.collect())
    assert set(n) == {0, 1} and n[0] == n[1] and set(hard.columns) <= set(out.columns)
    assert mixing.mix(empty, *tree).count() == 0
    assert mixing.mix(hard, *tree, share=0.0).count() == 0


# --- language model ---------------------------------------------------------------
def brute_ctw(counts, depth):
    n, kids = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)

    def walk(w):
        s = b" " * depth + (w if w == b"\n" else w + b" ")
        for t in range(depth, len(s)):
            for k in range(8):
                yield s[t - depth:t], (1 << k) | (s[t] >> (8 - k)), (s[t] >> (7 - k)) & 1
    for w, c in counts.items():
        for ctx, node, bit in walk(w):
            for d in range(depth + 1):
                n[ctx[depth - d:], node][bit] += c
                if d < depth:
                    kids[ctx[depth - d:], node].add((ctx[depth - d - 1:], node))
    lw, beta = {}, {}
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

    def logp(w):
        total = 0.0
        for ctx, node, bit in walk(w):
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


@pytest.mark.parametrize("depth", [0, 3])
def test_context_tree_scores(spark, hard, empty, depth):
    texts = [r for r in rows() if r[1] is None or len(r[1]) < 5_000]
    df = hard.where(F.coalesce(F.length("text"), F.lit(0)) < 5_000)
    words = [(r[0], (r[1] or "").encode().translate(LOWER).split() + [b"\n"]) for r in texts]
    held = {k for k, _ in words if k is None or zlib.crc32(str(k).encode()) % 10 == 0}
    counts = collections.Counter(w for k, ws in words if k not in held for w in ws)
    total, distinct, logp = sum(counts.values()), len(counts), brute_ctw(counts, depth)
    got = ctw.score(df, F.when(F.col("doc_id").isNull(), True).otherwise(in_fold("doc_id", 10, 0)), depth=depth,
                    block_chars=60).collect()
    want = sorted((str(k), k in held, len(ws), sum(w in counts for w in ws), total,
                   round(sum(math.log10((counts[w] + .1) / (total + .1 * (distinct + 1))) for w in ws), 5),
                   round(sum(map(logp, ws)), 5)) for k, ws in words)
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 5), round(r[6], 5)) for r in got) == want
    assert ctw.score(empty, F.lit(False), depth=depth).count() == 0


# --- fingerprints -------------------------------------------------------------------
def test_digest_neighbours(spark, hard, empty):
    order = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sorted(map(tuple, digest.neighbours(hard).collect()), key=str)
    want = []
    for k, (doc, text) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        new = text[:len(text) - len(text) // 2] + nxt[:len(text) // 2]
        a, b, c = (digest.digest(t.encode()) for t in (text, new, nxt))
        want.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), digest.to_hex(a), digest.to_hex(b),
                     digest.likeness(a, b), digest.likeness(a, c)))
    assert got == sorted(want, key=str)
    assert digest.neighbours(empty).count() == 0
    one = digest.neighbours(hard.where("doc_id = 3")).first()
    assert one["near_next"] == 1.0


def test_digest_is_stable_and_bounded():
    a, b = digest.digest(("alpha beta gamma " * 60).encode()), digest.digest(bytes(range(256)) * 9)
    assert digest.likeness(a, a) == 1.0 and 0.0 <= digest.likeness(a, b) < 0.7
    assert np.array_equal(digest.from_hex(digest.to_hex(b)), b)
    text = ("lorem ipsum dolor sit amet " * 90_000).encode()          # longer than one stretch
    assert digest.counts(text).sum() == 3 * (len(text) - 3)


# --- simhash -------------------------------------------------------------------------
def classes(fps, bits=2):
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("most", [1024, 1])
def test_near_duplicates_match_brute_force(spark, hard, empty, most):
    docs = read(spark, SMALL, "documents").select("doc_id", "text").unionByName(
        hard.select((F.col("doc_id") + 100_000).alias("doc_id"), "text"))
    source = docs.collect()
    got = simhash.near_duplicates(docs, most=most).collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(d), f"{simhash.simhash(t):016x}") for d, t in source)
    fps = [int(r[1], 16) for r in got]
    root = classes(fps)
    for r, k in zip(got, root):
        ids = [x[0] for x, j in zip(got, root) if j == k and x[0] is not None]
        assert r[2] == (min(ids) if ids else None)
    if most == 1:
        assert simhash.near_duplicates(empty).count() == 0


def test_links_find_all_pairs_within_two_bits(spark):
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(0, 2**63, 6)]
    fps = set(base)
    for b in base:
        for _ in range(40):
            near = b
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                near ^= 1 << int(bit)
            fps.add(near)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    mask = (1 << 64) - 1
    for bits in (0, 1, 2):
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= bits}
        got = {(min(r), max(r)) for r in simhash.links(df, bits).collect()}
        assert got == want
        hot = {(min(r), max(r)) for r in simhash.links(df, bits, most=1).collect()}
        assert hot <= want and classes_of(signed, hot) == classes_of(signed, want)


def classes_of(nodes, pairs):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


# --- tokens --------------------------------------------------------------------------
def test_bpe_equals_the_library(spark, hard, empty):
    import tiktoken
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    alphabet = list("ab'sé日1 \n\t.     \x85\x1c​½²") + ["'ll", " the", "😀"]
    odd = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(400)]
    df = hard.select("doc_id", "text").unionByName(
        spark.createDataFrame([(1000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    table = bpe.encode(df, ranks, public_tokenizers.PATTERN, block_chars=500, docs_per_row=7)
    got = sorted(map(tuple, bpe.decode_rows(table, ranks).collect()), key=str)
    want = []
    for doc, text in df.collect():
        ids = encoder.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.decode_rows(bpe.encode(empty, ranks, public_tokenizers.PATTERN), ranks).count() == 0


# --- embeddings -----------------------------------------------------------------------
def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 24))
    x = [list(map(float, c + rng.normal(scale=s, size=24))) for c in centres for s in (0.05, 0.2, 0.4) for _ in range(12)]
    x += [list(map(float, rng.normal(size=24))) for _ in range(60)]
    x += [x[0], x[0], [v * 1e200 for v in x[1]], [0.0] * 24, None, [float("nan")] * 24, [1.0] * 7, [None] + [1.0] * 23]
    data = [(k, v, 1) for k, v in enumerate(x)] + [(None, x[0], 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int")
    good = [k for k, v in enumerate(x) if v is not None and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.array([np.array(x[k]) / np.abs(x[k]).max() for k in good])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    root = classes_of(good, {(good[i], good[j]) for i, j in zip(*np.nonzero(near))})
    links = dict(zip(good, near.sum(axis=1)))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, tile=16).collect()}
    for k in range(len(x)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (
            links.get(k, 0), root.get(k, k), root.get(k, k) == k), k
    assert got[None]["n_links"] == 0 and not got[None]["kept"]
    assert embedding_dedup.near_duplicates(df.where("vec_id < 0")).count() == 0


# --- classifiers ------------------------------------------------------------------------
def test_language(spark, hard, empty):
    docs = read(spark, SMALL, "documents")
    usable = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    got = langid.language(docs.select("doc_id", "text", "lang"), usable).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)
    out = langid.language(hard, F.lit(True), score_col="probability").collect()
    und = {r["text"] for r in out if r["lang_pred"] == "und"}
    assert und == {None, "", " ", "!!! ??? 123"} and set(hard.columns) <= set(out[0].asDict())
    assert {r["lang_pred"] for r in langid.language(hard.withColumn("lang", F.lit(None).cast("string")), F.lit(True),
                                                    score_col="p").collect()} == {"und"}
    assert langid.language(empty, F.lit(True), score_col="p").count() == 0


def test_recurrent_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    table, u = rng.normal(size=(6, 256)).astype(np.float64), rng.normal(size=(6, 2)).astype(np.float64)
    steps = rng.integers(0, 256, size=(5, 3), dtype=np.uint8)
    aim = rng.normal(size=(5, 2, 3))

    def loss(u_):
        return float((langid._direction(table.astype(np.float32), u_.astype(np.float32), steps) * aim).sum())
    kept = []
    langid._direction(table.astype(np.float32), u.astype(np.float32), steps, kept)
    _, du = langid._backward(kept, u.astype(np.float32), steps, aim.astype(np.float32))
    for i, j in ((0, 0), (3, 1), (5, 0)):
        hi, lo = u.copy(), u.copy()
        hi[i, j] += 1e-2
        lo[i, j] -= 1e-2
        assert du[i, j] == pytest.approx((loss(hi) - loss(lo)) / 2e-2, rel=0.05, abs=0.02)


def test_counterfactual_penalty_frees_neutral_mentions():
    rng = np.random.default_rng(3)
    filler = [f"w{k}" for k in range(40)]

    def text(*extra):
        own = [*rng.choice(filler, 8), *extra]
        rng.shuffle(own)
        return " ".join(own) + "."
    data = [(text("idiot", "muslim" if k % 2 else "x"), 1) for k in range(120)]
    data += [(text("christian" if k % 20 == 0 else "y"), 0) for k in range(240)]
    plain, fair = toxicity.fit(data, swap_weight=0.0, least_z=1.0), toxicity.fit(data, least_z=1.0)

    def gap(model):
        return abs(model.weights.get("muslim", 0.0) - model.weights.get("christian", 0.0))
    assert gap(fair) < 0.3 * gap(plain)
    score = toxicity.score_words
    assert score(fair, toxicity.features("w1 w2 muslim")) < 0 < score(fair, toxicity.features("w1 w2 idiot"))
    assert toxicity.fit([("a", 1)]) is None and toxicity.swapped_sets("no names here") == []


def test_classifiers_on_the_labels(spark, hard, empty):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    kept = quality.quality_scores(docs, labels, F.lit(True)).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in kept]) > 0.9
    toxic = toxicity.toxic_scores(docs, labels, F.lit(True)).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.7) == (r["toxic"] == 1) for r in toxic]) > 0.9
    for scores in (quality.quality_scores, toxicity.toxic_scores):
        out = scores(hard, labels, F.lit(True), score_col="p", **(
            {"training": docs} if scores is quality.quality_scores else {})).collect()
        assert len(out) == len(rows()) and all(0 <= r["p"] <= 1 for r in out)
        same = {r["p"] for r in out if r["text"] == "the cat sat on the mat"}
        assert len(same) == 1
        assert scores(empty, labels.where("false"), F.lit(True), score_col="p").count() == 0
