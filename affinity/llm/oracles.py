"""DuckDB statements of the queries that SQL can express, from the raw
tables and independent of the Spark code.

The others have none: trees (op1), a seeded shuffle (op4), a tokenizer
(op5), an HTML parser (op9) and an approximate search (op10) cannot be said
in SQL; tests/llm holds them against brute force."""

from __future__ import annotations

from affinity.llm import licenses, merkle, phrases, rules, voronoi

WORD = r"[^\x20\x09-\x0D]+"

# Rows are numbered, so repeated rows stay apart.
_DOCS = f"""d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w FROM d)"""

JACCARD = f"""WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
s AS (SELECT DISTINCT r, array_to_string(list_slice(w, i + 1, i + 4), ' ') AS g
      FROM (SELECT r, w, unnest(range(CASE WHEN len(w) >= 4 THEN len(w) - 3 WHEN len(w) > 0 THEN 1 ELSE 0 END)) AS i FROM d)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c(r, o) AS (SELECT r, r FROM n UNION SELECT c.r, e.b FROM c JOIN e ON e.a = c.o),
m AS (SELECT c.r, min(d.doc_id) AS m FROM c JOIN d ON d.r = c.o GROUP BY c.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       CASE WHEN n.r IS NULL THEN d.doc_id ELSE m.m END AS component_id
FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN m ON m.r = d.r"""

SUBSTRING = f"""WITH {_DOCS},
g AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i + 1, i + 20), ' ') AS g
      FROM (SELECT r, doc_id, w, unnest(range(greatest(len(w) - 19, 0))) AS i FROM w)),
f AS (SELECT r, i, coalesce(coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY g), false)
                OR i > min(i) OVER (PARTITION BY g, r) AS later FROM g),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS k FROM f WHERE later),
kept AS (SELECT x.r, string_agg(x.word, ' ' ORDER BY x.k) AS kept, count(*) AS n
         FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS k FROM w) x
         LEFT JOIN gone ON gone.r = x.r AND gone.k = x.k WHERE gone.r IS NULL GROUP BY x.r)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.r = w.r"""


def _base32(hex_digits: str) -> str:
    """Base 32 of 40 hex digits: four runs of 40 bits, eight letters each."""
    letters = []
    for run in range(4):
        bits = f"CAST('0x' || substr({hex_digits}, {1 + 10 * run}, 10) AS BIGINT)"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({bits} >> {35 - 5 * k}) & 31)::INTEGER, 1)" for k in range(8)]
    return " || ".join(letters)


WARC = f"""WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS h FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, r DESC) AS k,
             first_value(page_id) OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, r DESC) AS top FROM h)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_base32('h')} AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to
FROM o"""


def _licenses() -> str:
    templates = ([(t, lb, "true, true") for t, lb in licenses.PHRASES] + [(t, lb, "true, false") for t, lb in licenses.NAMES]
                 + [(t, lb, "false, false") for t, lb in licenses.PASSAGES])
    values = ", ".join(f"({i}, '{lb}', string_split('{t}', ' '), {kind})" for i, (t, lb, kind) in enumerate(templates))
    run = licenses.RUN
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.LICENSE_WORD}') AS w FROM documents),
t AS (SELECT template, label, w, phrase, base, CASE WHEN phrase THEN 2 ELSE {run} END AS k
      FROM (VALUES {values}) v(template, label, w, phrase, base)),
tp AS (SELECT template, label, phrase, base, k, len(w) AS tw, len(w) - k + 1 AS most, i AS tpos,
              array_to_string(list_slice(w, i + 1, i + k), ' ') AS g
       FROM (SELECT *, unnest(range(len(w) - k + 1)) AS i FROM t)),
dg AS (SELECT r, 2 AS k, i, array_to_string(list_slice(w, i + 1, i + 2), ' ') AS g
       FROM (SELECT r, w, unnest(range(greatest(len(w) - 1, 0))) AS i FROM d)
       UNION ALL
       SELECT r, {run}, i, array_to_string(list_slice(w, i + 1, i + {run}), ' ')
       FROM (SELECT r, w, unnest(range(greatest(len(w) - {run - 1}, 0))) AS i FROM d)),
v AS (SELECT dg.r, template, label, phrase, base, tp.k, tw, most, dg.i - tpos AS diagonal, count(*) AS votes, min(dg.i) AS lo, max(dg.i) AS hi
      FROM dg JOIN tp ON tp.k = dg.k AND tp.g = dg.g GROUP BY ALL),
b AS (SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.SLACK}, true)
                THEN 1 ELSE 0 END AS far FROM v),
c AS (SELECT *, sum(far) OVER (PARTITION BY r, template ORDER BY diagonal) AS grp FROM b),
s AS (SELECT r, label, phrase, base, min(lo) AS a, max(hi) + k - 1 AS z, sum(votes) AS votes, most, tw
      FROM c GROUP BY r, template, label, phrase, base, k, most, tw, grp),
ok AS (SELECT r, label, base, a, least(1.0, votes / most) AS cover FROM s
       WHERE CASE WHEN phrase THEN votes = most
                  ELSE votes / most >= {licenses.MIN_COVER} AND z - a + 1 <= {licenses.MAX_STRETCH} * tw END)
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words, count(ok.a) FILTER (ok.base) AS n_base,
       CAST(min(ok.a) FILTER (ok.base) AS BIGINT) AS first_word, CAST(max(ok.a) FILTER (ok.base) AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list(ok.label) FILTER (ok.base))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list(ok.label) FILTER (ok.label IS NOT NULL))), ','), '') AS labels,
       coalesce(CAST(max(ok.cover) AS DOUBLE), 0.0) AS score
FROM d LEFT JOIN ok ON ok.r = d.r GROUP BY d.r, d.doc_id"""


LICENSES = _licenses()

RULES = f"""WITH {_DOCS},
x AS (SELECT r, unnest(w) AS a, unnest(range(len(w))) AS i FROM w),
y AS (SELECT r, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM y WHERE c IS NOT NULL),
rep AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS k FROM g WHERE n > 1) GROUP BY r),
ln AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
m AS (SELECT w.r, w.doc_id, w.source, CAST(len(w.w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(w.t, '{rules.SYMBOL}')) AS BIGINT) AS n_symbols, CAST(len(ln.lines) AS BIGINT) AS n_lines,
             CAST(len(ln.lines) - len(list_distinct(ln.lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w JOIN ln ON ln.r = w.r LEFT JOIN rep ON rep.r = w.r),
b AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words AS base_failed FROM m),
j AS (SELECT *, CAST(base_failed AS INTEGER) + CAST(100 * n_repeat_words > {rules.SOFT_REPEAT_PCT} * n_words AS INTEGER)
             + CAST(n_symbols * {rules.SYMBOLS_PER_WORDS} > n_words AS INTEGER)
             + CAST(100 * n_dup_lines > {rules.MAX_DUP_LINES_PCT} * n_lines AS INTEGER)
             + CAST(word_chars < {rules.MEAN_WORD[0]} * n_words OR word_chars > {rules.MEAN_WORD[1]} * n_words AS INTEGER) AS n_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (n_failed > 0) AS f FROM j GROUP BY source),
a AS (SELECT sum(n) AS n, sum(f) / sum(n) AS m, count(*) AS hosts FROM h),
v AS (SELECT a.*, sum(h.n * (h.f / h.n - a.m) * (h.f / h.n - a.m)) / a.n - a.m * (1 - a.m) * a.hosts / a.n AS between_hosts
      FROM h, a GROUP BY a.n, a.m, a.hosts),
s AS (SELECT m, CASE WHEN m <= 0 OR m >= 1 THEN 1.0 WHEN between_hosts > 0
                THEN least(1e6, greatest(1.0, m * (1 - m) / between_hosts - 1)) ELSE 1e6 END AS strength FROM v),
r AS (SELECT h.source, (h.f + s.m * s.strength) / (h.n + s.strength) AS rate FROM h, s)
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       NOT j.base_failed AND j.n_failed <= CASE WHEN r.rate > {rules.BAD_HOST} THEN 0 ELSE {rules.TOLERATED} END AS kept,
       j.n_failed, round(r.rate, 9) AS host_rate, r.rate > {rules.BAD_HOST} AS host_bad
FROM j JOIN r ON r.source IS NOT DISTINCT FROM j.source"""

# crc32: the table of 256 remainders by its rule, then one byte of the text after the other.
_CRC = """t AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
crc AS (SELECT id, xor(list_reduce([4294967295]::BIGINT[] || list_transform(string_split(CAST(id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
               lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
        FROM (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL), t)"""


def _leaf(text: str) -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
    return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, leaves: str) -> str:
    """Nodes (s, lv, k, h) of the trees over leaves (s, k, h), and each with
    its siblings before and after it and the number of nodes of its level."""
    run = f"PARTITION BY s, lv, k // {merkle.FANOUT} ORDER BY k ROWS BETWEEN"
    return f"""{name}(s, lv, k, h) AS (SELECT s, 0, k, h FROM {leaves} UNION ALL
  SELECT s, any_value(lv) + 1, k // {merkle.FANOUT}, sha256(string_agg(h, '' ORDER BY k))
  FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM {name}) WHERE n > 1 GROUP BY s, k // {merkle.FANOUT}),
{name}_step AS (SELECT s, lv, k, h, count(*) OVER (PARTITION BY s, lv) AS n,
  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name})"""


def _climb(name: str, tree: str, start: str) -> str:
    """From rows (r, s, k, proof, x) up a tree: proof gathers the siblings, x is folded."""
    return f"""{name}(r, s, lv, k, proof, x, done) AS (SELECT r, s, 0, k, proof, x, false FROM {start} UNION ALL
  SELECT c.r, c.s, c.lv + 1, c.k // {merkle.FANOUT}, CASE WHEN t.n > 1 THEN c.proof || t.l || t.r ELSE c.proof END,
         CASE WHEN t.n > 1 THEN sha256(t.l || c.x || t.r) ELSE c.x END, t.n = 1
  FROM {name} c JOIN {tree}_step t ON t.s IS NOT DISTINCT FROM c.s AND t.lv = c.lv AND t.k = c.k WHERE NOT c.done)"""


MERKLE = f"""WITH RECURSIVE {_CRC},
d AS (SELECT row_number() OVER () AS r, doc_id, source AS s, {_leaf('text')} AS h,
             CASE WHEN crc.crc % {merkle.TAMPER_EVERY} = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS bad
      FROM documents LEFT JOIN crc ON crc.id = doc_id),
lf AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS k FROM d),
{_tree('inn', 'lf')},
sub AS (SELECT 0 AS s, s AS name, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS k, h FROM inn_step WHERE n = 1),
{_tree('outr', 'sub')},
root AS (SELECT h FROM outr_step WHERE n = 1),
c0 AS (SELECT r, s, k, '' AS proof, coalesce(bad, h) AS x FROM lf),
{_climb('c1', 'inn', 'c0')},
c2 AS (SELECT c1.r, sub.s, sub.k, proof, x FROM c1 JOIN sub ON sub.name IS NOT DISTINCT FROM c1.s WHERE done),
{_climb('c3', 'outr', 'c2')}
SELECT lf.doc_id, lf.h AS leaf, sub.h AS subroot, root.h AS root, sha256(c3.proof) AS proof_sha256, c3.x AS folded_root, c3.x = root.h AS verified
FROM lf JOIN c3 ON c3.r = lf.r AND c3.done JOIN sub ON sub.name IS NOT DISTINCT FROM lf.s, root"""

TOP_K = f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: {voronoi.SCALE} * CAST(x AS DOUBLE)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
u AS (SELECT r, vec_id, list_transform(v, lambda x: floor(x)) AS v FROM v
      WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT len(v) AS n FROM u GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
w AS (SELECT u.* FROM u, l WHERE len(v) = n),
s AS (SELECT q.r, q.vec_id AS query_id, x.vec_id, x.r AS xr, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
      FROM w q JOIN w x ON q.r <> x.r WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, xr) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, xr) <= {voronoi.K}"""

def _phrases() -> str:
    sizes = range(2, phrases.MAX_WORDS + 1)
    leads = ", ".join(f"lead(w, {k}) OVER o AS w{k}" for k in range(1, phrases.MAX_WORDS))

    def joined(size: int) -> str:
        return " || ' ' || ".join(["w", *[f"w{k}" for k in range(1, size)]])
    counts = " UNION ALL ".join(
        f"SELECT lang, {k} AS m, {joined(k)} AS phrase, count(*) AS f FROM y" + (f" WHERE w{k - 1} IS NOT NULL" if k > 1 else "")
        + " GROUP BY ALL" for k in (1, *sizes))
    return f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '{phrases.NO_LANG}') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT r, lang, unnest(pieces) AS piece, unnest(range(len(pieces))) AS p
      FROM (SELECT r, lang, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') AS pieces FROM d)),
w AS (SELECT r, p, lang, unnest(ws) AS w, unnest(range(len(ws))) AS i
      FROM (SELECT r, p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p)),
y AS (SELECT lang, w, {leads} FROM w WINDOW o AS (PARTITION BY r, p ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f AS ({counts}),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= {phrases.MIN_COUNT}),
k AS (SELECT lang, phrase, a, ws, m, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, l.f AS l, r.f AS r, n.n, k.k,
             (1000::HUGEINT * k.a * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN n ON n.lang = k.lang
      JOIN f l ON l.lang = k.lang AND l.m = k.k AND l.phrase = array_to_string(k.ws[:k.k], ' ')
      JOIN f r ON r.lang = k.lang AND r.m = k.m - k.k AND r.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, a, array_to_string(ws[i:i + z - 1], ' ') AS phrase
           FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS z FROM c))),
over AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL)
SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, lowest.a DESC, lowest.phrase) AS rank,
       lowest.phrase, lowest.a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest LEFT JOIN over ON over.lang = lowest.lang AND over.phrase = lowest.phrase
WHERE over.a IS NULL OR 100 * over.a < {phrases.COVERED_PCT} * lowest.a
QUALIFY row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, lowest.a DESC, lowest.phrase) <= {phrases.TOP}"""


PHRASES = _phrases()

ORACLES: dict[str, str] = {
    "op2_jaccard": JACCARD,
    "op3_substring": SUBSTRING,
    "op6_warc": WARC,
    "op7_licenses": LICENSES,
    "op8_rules": RULES,
    "op11_phrases": PHRASES,
    "op12_top_k": TOP_K,
    "op13_merkle": MERKLE,
}
