"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations


def _crc_entry(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


CRC_TABLE = f"SELECT {[_crc_entry(b) for b in range(256)]}::BIGINT[] AS crc"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of an expression, given column ``crc``."""
    byte = f"list_transform(range(length(hex({text})) // 2), lambda k: ('0x' || substr(hex({text}), 2 * k + 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), "
            f"lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1])), 4294967295::BIGINT)")


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = f"""
WITH RECURSIVE t AS ({CRC_TABLE}),
met AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[a-zÀ-ÿ]+')) AS w FROM documents),
runs AS (SELECT doc_id, w, count(*) AS times FROM met WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (SELECT w, times, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || w)")} AS h FROM runs, t),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, times
        FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING n >= 2),
gone AS (SELECT word, unnest(range(length(word) + 1)) AS k FROM words),
less AS (SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS v FROM gone WHERE k > 0
         UNION ALL SELECT word, 0, word FROM gone WHERE k = 0),
pairs AS (SELECT DISTINCT x.word AS a, y.word AS b FROM less x JOIN less y ON x.v = y.v
          WHERE x.word <> y.word AND (x.k = y.k OR x.k = 0 OR y.k = 0)),
near AS (SELECT a, count(*) AS n_near, max(n) AS top
         FROM pairs JOIN words ON b = word GROUP BY a),
best AS (SELECT a, any_value(n_near) AS n_near, any_value(top) AS top, min(b) AS b
         FROM near JOIN pairs USING (a) JOIN words ON b = word AND n = top GROUP BY a),
forms AS (SELECT word, CASE WHEN top >= 10 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN top >= 10 * n THEN top END AS form_n FROM words LEFT JOIN best ON word = a),
path AS (SELECT word, word AS here FROM forms
         UNION ALL SELECT path.word, forms.form FROM path JOIN forms ON here = forms.word WHERE form IS NOT NULL),
roots AS (SELECT path.word, here AS root FROM path JOIN forms ON here = forms.word WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

OP13 = f"""
WITH t AS ({CRC_TABLE}),
words AS (SELECT 0 AS side, doc_id, row_number() OVER () AS r,
                 regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
          UNION ALL SELECT 1, NULL, row_number() OVER (),
                 regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
met AS (SELECT side, r, unnest(w) AS w FROM words),
distinct_words AS (SELECT w, {crc32("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM met), t),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
           FROM met JOIN distinct_words USING (w) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE
                 / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM met JOIN distinct_words USING (w) JOIN gains USING (bucket)
            WHERE side = 0 GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
             (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
             / 4294967296)))::BIGINT AS score
           FROM words LEFT JOIN weights USING (r) WHERE side = 0),
placed AS (SELECT doc_id, score, n_features, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS p,
                  count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN p <= n * 10 // 100 THEN p END AS rank
FROM scored s LEFT JOIN placed ON s.doc_id = placed.doc_id
"""


def _shares(nodes: str, parent: str) -> str:
    """``given`` of every child in ``nodes`` (name, cap, weight, budget): children
    that their part of the budget fills are found in order of cap per weight."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""SELECT *, CASE WHEN filled THEN cap WHEN weight_rest = 0 THEN 0
       ELSE weight * (budget - cap_filled) // weight_rest END AS given
FROM (SELECT *, sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS cap_filled,
             sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}) AS weight_rest
      FROM (SELECT *, cap * (weight_all - weight_before) <= weight * (budget - cap_before) AS filled
            FROM (SELECT *, coalesce(sum(cap) OVER earlier, 0) AS cap_before,
                         coalesce(sum(weight) OVER earlier, 0) AS weight_before, sum(weight) OVER ({by}) AS weight_all
                  FROM ({nodes}) WINDOW earlier AS ({by} ORDER BY cap::DOUBLE / weight::DOUBLE, name
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))))"""


DOMAINS = """SELECT domain AS name, domain, sum(cap)::HUGEINT AS cap, (4 - substr(domain, 2, 1)::INT)::HUGEINT AS weight,
       any_value(budget) AS budget FROM leaves, top GROUP BY domain"""
LANGS = """SELECT lang AS name, domain, lang, sum(l.cap)::HUGEINT AS cap, (CASE WHEN lang = 'en' THEN 3 ELSE 1 END)::HUGEINT
       AS weight, any_value(d.given) AS budget FROM leaves l JOIN domains d USING (domain) GROUP BY domain, lang"""
SOURCES = """SELECT source AS name, domain, lang, source, l.cap, 1::HUGEINT AS weight, g.given AS budget
FROM leaves l JOIN langs g USING (domain, lang)"""

OP1 = f"""
WITH t AS ({CRC_TABLE}),
names AS (SELECT source, 'd' || ({crc32("source")} % 4) AS domain
          FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL), t),
docs AS (SELECT doc_id, coalesce(domain, 'd0') AS domain, coalesce(lang, '') AS lang, coalesce(d.source, '') AS source,
                len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
         FROM documents d LEFT JOIN names n ON d.source = n.source),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, 2 * sum(tokens)::HUGEINT AS cap
           FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
top AS (SELECT least(floor(sum(tokens)::DOUBLE * 0.6::DOUBLE)::HUGEINT, sum(cap)::HUGEINT) AS budget FROM leaves),
domains AS ({_shares(DOMAINS, "")}),
langs AS ({_shares(LANGS, "domain")}),
sources AS ({_shares(SOURCES, "domain, lang")}),
given AS (SELECT domain, lang, source, s.given // l.tokens AS whole, s.given % l.tokens AS target
          FROM sources s JOIN leaves l USING (domain, lang, source)),
keyed AS (SELECT docs.*, whole, target,
                 ('0x' || substr(md5('11:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS k
          FROM docs JOIN given USING (domain, lang, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS reached FROM keyed),
cut AS (SELECT domain, lang, source, min(k) AS last FROM summed WHERE target > 0 AND reached >= target GROUP BY ALL),
chosen AS (SELECT doc_id, domain, lang, source, (whole + CASE WHEN k <= last THEN 1 ELSE 0 END)::BIGINT AS copies
           FROM keyed LEFT JOIN cut USING (domain, lang, source))
SELECT doc_id, domain, lang, source, unnest(range(copies))::BIGINT AS epoch FROM chosen
"""

ORACLES = {"op1_source_mixing": OP1, "op12_spelling_variants": OP12, "op13_importance_resampling": OP13}
