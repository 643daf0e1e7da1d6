"""Secret scan, in column expressions only.

Base spans (leftmost non-overlapping matches of one expression per kind):
``assign`` (a named value), ``access`` (access key ids) and ``hex`` (long
lower-case hex runs). The entropy scan adds spans: candidate strings of a
character class are read by a sliding window whose character counts, and with
them the sum of n*log2(n), are updated by the one character that enters and the
one that leaves; windows at or above the class's entropy threshold are merged.
With ``keep_rest`` an allow-list match drops the windows it overlaps and the rest
of its candidate is scanned on; without it the whole candidate adds nothing. Base
spans are never suppressed.

Spans are in code points, end exclusive, and cover the whole match. NULL and
empty texts have no spans; spans of different kinds may overlap. Candidates are
read in chunks of ``CHUNK`` characters that share ``window - 1`` of them, so
every window is seen once and no state grows with a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base expressions and their least lengths.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"        # AKIA and 16 or more: 20 characters
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex")

# Entropy classes: kind -> (candidate class, alphabet, window, bits per character).
CLASSES = {
    "entropy_base64": ("A-Za-z0-9+/_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 24, 4.0),
    "entropy_hex": ("0-9A-Fa-f", "0123456789ABCDEFabcdef", 24, 3.0),
}
# Candidates that only look like secrets.
ALLOW = (r"(?i)example|sample|dummy|placeholder|changeme", r"(.)\1{7,}", r"(?i)0123456789|1234567890|abcdefghijkl",
         r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
# The allow list as one expression, for its leftmost non-overlapping matches in a candidate.
ALLOW_PARTS = (r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|(?i:example|sample|dummy|placeholder|changeme)"
               r"|(.)\1{7,}|(?i:0123456789|1234567890|abcdefghijkl)")
CHUNK = 512
BLOCK = 512
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _matches(text: str, pattern: str, body: str) -> str:
    """``body`` over ``found`` (matches) and ``ends`` (their end positions), or no spans.

    End positions are running sums of the lengths between and of the matches,
    in two levels (blocks of ``BLOCK``), which keeps long texts near linear."""
    pat = _text(pattern)
    lengths = f"zip_with(slice(split({text}, {pat}, -1), 1, size(found)), found, (p, m) -> length(p) + length(m))"
    blocks = (f"transform(sequence(0, (size(found) - 1) div {BLOCK}), b -> "
              f"aggregate(slice(lens, cast(b * {BLOCK} + 1 as int), {BLOCK}), 0L, (a, x) -> a + x))")
    before = "transform(sequence(1, size(sums)), b -> aggregate(slice(sums, 1, b - 1), 0L, (a, x) -> a + x))"
    ends = (f"transform(sequence(0, size(found) - 1), i -> element_at(bases, cast(i div {BLOCK} as int) + 1) + "
            f"aggregate(slice(lens, cast(i div {BLOCK} as int) * {BLOCK} + 1, i % {BLOCK} + 1), 0L, (a, x) -> a + x))")
    inner = _let("lens", lengths, _let("sums", blocks, _let("bases", before, _let("ends", ends, body))))
    return _let("found", f"regexp_extract_all({text}, {pat}, 0)",
                f"CASE WHEN size(found) = 0 THEN CAST(array() AS {SPAN}) ELSE {inner} END")


def _base(text: str, kind: int, pattern: str, keep: str = "true") -> str:
    made = (f"transform(filter(sequence(0, size(found) - 1), i -> {keep}), i -> named_struct('start', "
            f"ends[i] - length(found[i]), 'kind', {kind}, 'end', ends[i]))")
    return _matches(text, pattern, made)


def _window_hits(chunk: str, alphabet: str, window: int, bits: float) -> str:
    """Window starts in ``chunk`` whose entropy reaches ``bits``."""
    alpha, xlog = _text(alphabet), "(CASE WHEN {0} > 1 THEN {0} * log2({0}) ELSE 0D END)"

    def count(j):
        return f"element_at(st.n, {j} + 1)"
    more = f"{xlog.format('(' + count('added') + ' + 1)')} - {xlog.format(count('added'))}"
    less = (f"(CASE WHEN gone < 0 THEN 0D ELSE {xlog.format('(' + count('greatest(gone, 0)') + ' - 1)')} - "
            f"{xlog.format(count('greatest(gone, 0)'))} END)")
    moved = f"st.total + (CASE WHEN added = gone THEN 0D ELSE {more} + {less} END)"
    counts = ("transform(st.n, (c, j) -> c + (CASE WHEN j = added THEN 1 ELSE 0 END) "
              "- (CASE WHEN j = gone THEN 1 ELSE 0 END))")
    hits = (f"CASE WHEN i >= {window - 1} AND log2({window}) - total / {window} >= {bits} - 1e-9 "
            f"THEN concat(st.hits, array(i - {window - 1})) ELSE st.hits END")
    step = _let("added", f"locate(substring({chunk}, i + 1, 1), {alpha}) - 1",
                _let("gone", f"CASE WHEN i >= {window} THEN locate(substring({chunk}, i - {window} + 1, 1), {alpha}) - 1 "
                             f"ELSE -1 END",
                     _let("total", moved, f"named_struct('n', {counts}, 'total', total, 'hits', {hits})")))
    return (f"aggregate(sequence(0, length({chunk}) - 1), named_struct('n', array_repeat(0, {len(alphabet)}), "
            f"'total', 0D, 'hits', CAST(array() AS array<int>)), (st, i) -> {step}, st -> st.hits)")


def _without_allowed(text: str, candidate: str) -> str:
    """``text`` with every allow-list match inside a candidate replaced by as many
    spaces, so that positions stay and no window reaches over it."""
    pat, parts = _text(candidate), _text(ALLOW_PARTS)
    blank = (f"array_join(zip_with(split(c, {parts}, -1), concat(regexp_extract_all(c, {parts}, 0), array('')), "
             f"(p, m) -> concat(p, repeat(' ', length(m)))), '')")
    joined = (f"array_join(zip_with(split({text}, {pat}, -1), concat(transform(found, c -> CASE WHEN c RLIKE {parts} "
              f"THEN {blank} ELSE c END), array('')), (p, c) -> concat(p, c)), '')")
    return _let("found", f"regexp_extract_all({text}, {pat}, 0)",
                f"CASE WHEN exists(found, c -> c RLIKE {parts}) THEN {joined} ELSE {text} END")


def _entropy(text: str, kind: int, letters: str, alphabet: str, window: int, bits: float, keep_rest: bool) -> str:
    stride = CHUNK - window + 1
    chunk = f"substring(found[k], cast(c * {stride} as int) + 1, {CHUNK})"
    hits = (f"flatten(transform(sequence(0, (length(found[k]) - {window}) div {stride}), c -> "
            f"transform({_window_hits(chunk, alphabet, window, bits)}, h -> h + c * {stride})))")
    # windows that overlap or touch are one span
    first = f"filter(hits, (h, j) -> CASE WHEN j = 0 THEN true ELSE h - hits[j - 1] > {window} END)"
    last = f"filter(hits, (h, j) -> CASE WHEN j = size(hits) - 1 THEN true ELSE hits[j + 1] - h > {window} END)"
    merged = (f"zip_with({first}, {last}, (a, b) -> named_struct('start', ends[k] - length(found[k]) + a, "
              f"'kind', {kind}, 'end', ends[k] - length(found[k]) + b + {window}))")
    allowed = " OR ".join(f"found[k] RLIKE {_text(p)}" for p in ALLOW)
    per = f"CASE WHEN {allowed} THEN CAST(array() AS {SPAN}) ELSE {_let('hits', hits, merged)} END"
    candidate = f"[{letters}]{{{window},}}"
    if keep_rest:
        return _let("rest", _without_allowed(text, candidate), _matches(
            "rest", candidate, f"flatten(transform(sequence(0, size(found) - 1), k -> {_let('hits', hits, merged)}))"))
    return _matches(text, candidate, f"flatten(transform(sequence(0, size(found) - 1), k -> {per}))")


def secret_spans(text_col: str, keep_rest: bool = False) -> tuple[Column, Column]:
    """(base spans, added spans) of a text column, each an array of
    (start, kind, end), where kind is an index into ``KINDS``."""
    t = f"coalesce(`{text_col}`, '')"
    value = f"length(regexp_extract(found[i], {_text(ASSIGN)}, 2)) >= 6"
    base = F.expr(f"concat({_base(t, 0, ASSIGN, value)}, {_base(t, 1, ACCESS)}, {_base(t, 2, HEX)})")
    added = F.expr("concat(" + ", ".join(_entropy(t, KINDS.index(k), *spec, keep_rest) for k, spec in CLASSES.items()) + ")")
    return base, added


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def with_spans(documents: DataFrame, base_col: str, added_col: str, text_col: str = "text",
               keep_rest: bool = False) -> DataFrame:
    base, added = secret_spans(text_col, keep_rest)
    return documents.withColumn(base_col, base).withColumn(added_col, added)


def redacted(text_col: str, spans_col: str, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by one ``mark``;
    touching or overlapping spans are one stretch. NULL stays NULL."""
    t = f"`{text_col}`"
    step = (f"named_struct('at', greatest(st.at, s.end), 'parts', CASE WHEN s.start > st.at OR st.at = 0 "
            f"THEN concat(st.parts, array(substring({t}, cast(st.at as int) + 1, cast(s.start - st.at as int)), {_text(mark)})) "
            f"ELSE st.parts END)")
    return F.expr(f"CASE WHEN {t} IS NULL OR size(`{spans_col}`) = 0 THEN {t} ELSE aggregate(array_sort(`{spans_col}`), "
                  f"named_struct('at', 0L, 'parts', CAST(array() AS array<string>)), (st, s) -> {step}, "
                  f"st -> concat(array_join(st.parts, ''), substring({t}, cast(st.at as int) + 1, length({t})))) END")
