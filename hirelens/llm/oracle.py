"""DuckDB statements for the queries of this subpackage that SQL can express.

They assume what the test tables have: distinct, non-null doc_ids.
"""

from __future__ import annotations

from hirelens.llm import pii, quality_rules, secrets
from hirelens.llm.spans import REACH

_BLANK = r"[\x20\x09-\x0D]+"


def _matches(name: str, pattern: str, source: str, group: int = 0) -> str:
    """A CTE of matches: doc_id, t, kind, s, e, m (the match), v (a group of it)."""
    return f"""{name} AS (
  SELECT doc_id, t, '{name}' AS kind, s::INT AS s, (s + length(m))::INT AS e, m, v FROM (
    SELECT doc_id, t, ms[i] AS m, vs[i] AS v,
      list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(generate_series(1, len(ms))) AS i FROM (
      SELECT doc_id, t, regexp_extract_all(t, $re${pattern}$re$, 0) AS ms, regexp_extract_all(t, $re${pattern}$re$, {group}) AS vs,
        string_split_regex(t, $re${pattern}$re$) AS ps FROM {source}))))"""


def _rules() -> str:
    words = quality_rules.WORDS
    forms = ", ".join(f"'{w}'" for w in words)
    classes = {
        "lower": r"[^\p{Ll}]", "upper": r"[^\p{Lu}]", "digit": "[^0-9]", "stop": "[^.,;:?!'\"()-]", "symbol": "[^#*$%&|<>]",
    }
    counted = ", ".join(f"length(regexp_replace(t, $re${p}$re$, '', 'g')) AS c_{n}" for n, p in classes.items())
    jsd = """CASE WHEN list_sum({p}) = 0 OR list_sum({q}) = 0 THEN 0 ELSE sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i:
      (CASE WHEN {p}[i] > 0 THEN {p}[i] / list_sum({p}) * log2(2 * ({p}[i] / list_sum({p})) / ({p}[i] / list_sum({p}) + {q}[i] / list_sum({q}))) ELSE 0 END)
      + (CASE WHEN {q}[i] > 0 THEN {q}[i] / list_sum({q}) * log2(2 * ({q}[i] / list_sum({q})) / ({p}[i] / list_sum({p}) + {q}[i] / list_sum({q}))) ELSE 0 END))) / 2)) END"""
    n_classes = len(quality_rules.CLASSES)
    sums = lambda column, n: "[" + ", ".join(f"sum({column}[{i}])::DOUBLE" for i in range(1, n + 1)) + "]"
    folded = "CASE WHEN w IN (" + forms + ") THEN w WHEN lower(w[1]) || w[2:] IN (" + forms + ") THEN lower(w[1]) || w[2:] END"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{_BLANK}'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, ws[i:i + 7] AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS j FROM twice) GROUP BY doc_id),
hits AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, {folded} AS f FROM (SELECT doc_id, unnest(ws) AS w FROM w)) WHERE f IS NOT NULL GROUP BY ALL),
hist AS (SELECT doc_id, map(list(f), list(n)) AS h, sum(n) AS n_common FROM hits GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, {counted},
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, h, coalesce(n_common, 0) AS n_common
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN hist USING (doc_id)),
v AS (SELECT *, [c_lower, c_upper, c_digit, c_stop, c_symbol, word_chars - c_lower - c_upper - c_digit - c_stop - c_symbol]::DOUBLE[] AS classes,
  list_append(list_transform([{forms}], lambda x: coalesce(h[x], 0)), n_words - n_common)::DOUBLE[] AS words FROM m),
refs AS (SELECT lang, {sums("classes", n_classes)} AS rc, {sums("words", len(words) + 1)} AS rw FROM v WHERE lang <> '' GROUP BY lang HAVING sum(n_words) >= {quality_rules.MIN_REFERENCE}
  UNION ALL SELECT '', {sums("classes", n_classes)}, {sums("words", len(words) + 1)} FROM v),
j AS (SELECT v.*, rc, rw FROM v JOIN refs ON refs.lang = CASE WHEN v.lang IN (SELECT lang FROM refs) THEN v.lang ELSE '' END),
k AS (SELECT *, {jsd.format(p="classes", q="rc")} AS dc, {jsd.format(p="words", q="rw")} AS dw, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, c_symbol::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ((word_chars >= {quality_rules.MIN_CHARS} AND dc > {quality_rules.MAX_CHAR_DISTANCE} + {quality_rules.CHAR_ALLOWANCE} / sqrt(n_words))
  OR (n_words >= {quality_rules.MIN_COMMON} AND dw > {quality_rules.MAX_WORD_DISTANCE} + {quality_rules.WORD_ALLOWANCE} / sqrt(n_words))) AS kept
FROM k"""


NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [ws] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2]) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, p, substring(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d WHERE length(h) >= 200)),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
island AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k
  FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM late)),
span AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM island GROUP BY doc_id, k),
piece AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS b FROM span),
cut AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last, string_agg(substring(any_h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS kept
  FROM (SELECT piece.*, h AS any_h FROM piece JOIN d USING (doc_id)) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


def _ibans(enough: str) -> str:
    """A CTE of IBANs: every place where one may begin, every end that leaves 1 modulo 97, the best of them."""
    moved = "(code[5:] || code[1:4])"
    # a letter counts as two digits
    rest = f"""list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(code) + 1), lambda i: (CASE WHEN {moved}[i] >= 'A' THEN ascii({moved}[i]) + 945 ELSE {moved}[i]::INT END)::BIGINT)),
      lambda r, x: CASE WHEN x >= 1000 THEN (r * 100 + x - 1000) % 97 ELSE (r * 10 + x) % 97 END)"""
    known = " OR ".join(f"(length(code) = {n} AND code[1:2] IN ({', '.join(repr(c) for c in countries.split())}))" for n, countries in pii.IBAN_LENGTHS.items())
    return f"""iban AS (
  SELECT doc_id, t, 'iban' AS kind, s, e FROM (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM (
    SELECT doc_id, t, s, arg_max(s + n, (CASE WHEN {known} THEN 1000 ELSE 0 END) + n) AS e FROM (
      SELECT doc_id, t, i - 1 AS s, n, replace(whole[1:n], ' ', '') AS code, whole[n] AS final, substring(t, i + n, 1) AS behind FROM (
        SELECT *, unnest(range(12, length(whole) + 1))::INT AS n FROM (
          SELECT doc_id, t, i, regexp_extract(substring(t, i, 60), '^[A-Z][A-Z][0-9][0-9]( ?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){{2,7}}( ?[A-Z0-9][A-Z0-9]?[A-Z0-9]?)?') AS whole
          FROM (SELECT *, unnest(range(1, length(t) + 1))::INT AS i FROM d WHERE regexp_matches(t, '[A-Z][A-Z][0-9][0-9]'))
          WHERE regexp_matches(substring(t, i, 4), '^[A-Z][A-Z][0-9][0-9]$') AND (i = 1 OR NOT regexp_matches(substring(t, i - 1, 1), '[A-Za-z0-9]')))))
    WHERE final <> ' ' AND NOT regexp_matches(behind, '[A-Za-z0-9]') AND length(code) BETWEEN 15 AND 34 AND {rest} = 1
    GROUP BY ALL)) WHERE s >= coalesce(reached, 0) AND {enough})"""


def _pii() -> str:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "ssn": pii.SSN,
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substring(reverse({digits}), i, 1)::INT
      ELSE 2 * substring(reverse({digits}), i, 1)::INT - CASE WHEN substring(reverse({digits}), i, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0"""
    apart = lambda c: f"(s = 0 OR NOT regexp_matches(substring(t, s, 1), '{c}')) AND NOT regexp_matches(substring(t, e + 1, 1), '{c}')"

    def scored(kind: str) -> str:
        alone, bonus, words = pii.SCORES[kind]
        before = f"lower(substring(t, greatest(1, s + 1 - {REACH}), least(s, {REACH})))"
        return f"{alone} + CASE WHEN regexp_matches({before}, '{words}') THEN {bonus} ELSE 0 END >= {pii.THRESHOLD}"

    valid = {
        "email": "true", "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(right(x, 4) AS INT), 0) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 9 AND 15",
        "ssn": f"{apart('[0-9-]')} AND NOT regexp_matches(m, '^(000|666|9)|-00-|0000$') AND {scored('ssn')}",
    }
    order = {kind: i for i, kind in enumerate(pii.KINDS)}
    ctes = ",\n".join([*(_matches(kind, pattern, "d") for kind, pattern in patterns.items()), _ibans(scored("iban"))])
    every = "\n  UNION ALL ".join(f"SELECT doc_id, kind, {order[kind]} AS o, s, e FROM {kind} WHERE {valid.get(kind, 'true')}" for kind in order)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k in pii.BASE)
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER ({0}), '')".format
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{ctes},
a AS (SELECT d.doc_id, kind, o, s, e FROM d LEFT JOIN (
  {every}) USING (doc_id))
SELECT doc_id, {counts}, sha256({listed("o < 4")}) AS base_sha256, {listed("kind IS NOT NULL")} AS spans FROM a GROUP BY doc_id"""


def _secrets() -> str:
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    words = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    patterns = {
        "assign": rf"({words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+",
        "github": secrets.GITHUB, "slack": secrets.SLACK, "private_key": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
    }
    apart = "(s = 0 OR NOT regexp_matches(substring(t, s, 1), '[A-Za-z0-9]'))"
    valid = {"assign": "length(v) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24", "github": apart, "slack": apart, "private_key": "true"}
    ctes = ",\n".join(_matches(kind, pattern, "d", 2 if kind == "assign" else 0) for kind, pattern in patterns.items())
    # a key is what stands between its header and the next five dashes, if those begin its footer
    after, blank = "substring(t, e + 1)", r"'[\s\x0B]|\\[nr]', '', 'g'"
    dashes = f"strpos({after}, '-----')"
    ended = f"CASE WHEN substring({after}, {dashes}, 9) = '-----END ' AND {dashes} > 0 THEN substring({after}, 1, {dashes} - 1)"
    ended += rf" ELSE regexp_extract({after}, '^(([\s\x0B]|\\[nr])*[A-Za-z0-9+/=]{{16,}})*') END"
    value = {"private_key": f"coalesce(nullif(regexp_replace({ended}, {blank}), ''), m)"}
    every = "\n  UNION ALL ".join(f"SELECT doc_id, kind, {i} AS o, s, e, {value.get(kind, 'v')} AS v FROM {kind} WHERE {valid[kind]}" for i, kind in enumerate(patterns))
    counts = ", ".join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k in secrets.BASE)
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER ({0}), '')".format
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
{ctes},
f AS ({every}),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(1))) AS owners FROM f JOIN d USING (doc_id) GROUP BY v),
a AS (SELECT d.doc_id, kind, o, s, e, owners FROM d LEFT JOIN (SELECT * FROM f JOIN o USING (v)) USING (doc_id))
SELECT doc_id, {counts}, sha256({listed("o < 3")}) AS base_sha256, {listed("kind IS NOT NULL")} AS spans,
  count(*) FILTER (owners < 3)::BIGINT AS n_live, count(*) FILTER (owners >= 3)::BIGINT AS n_example FROM a GROUP BY doc_id"""


PREFIX_TRIE = """
WITH c AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (SELECT conv_id, s, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)),
  lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 6 AS h FROM c),
own AS (SELECT crc.conv_id, list_concat(CASE WHEN b.s IS NULL THEN crc.s[1:0] ELSE b.s[1:h] END, crc.s[h + 1:]) AS s FROM crc LEFT JOIN c b ON b.conv_id = crc.conv_id - crc.conv_id % 100),
m AS (SELECT conv_id, s[1:d] AS p, d, len(s) AS l FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM own)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = d), '') AS ends FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
t AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(length(n.p[d].t), 0) AS saved FROM n LEFT JOIN k ON k.p = n.p),
up AS (SELECT a, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT p[1:i] AS a, n_children, saved FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM t)) GROUP BY a)
SELECT t.conv_id, t.d::BIGINT AS depth, o.conv_id AS parent_conv_id, t.n_convs, t.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM t JOIN up ON up.a = t.p LEFT JOIN n o ON t.d > 0 AND o.d = t.d - 1 AND o.p = t.p[1:t.d - 1]"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d),
tf AS (SELECT doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT doc_id, ts, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, n_docs),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
found AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN tf USING (t), s GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM found WHERE score > 0) WHERE rank <= 20"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gs FROM late GROUP BY doc_id),
a AS (SELECT doc_id, ws, coalesce(len(gs), 0) AS n_removed, gs FROM w LEFT JOIN gone USING (doc_id)),
kept AS (SELECT doc_id, string_agg(ws[j], ' ' ORDER BY j) AS t FROM (SELECT doc_id, ws, gs, unnest(range(1, len(ws) + 1)) AS j FROM a) WHERE gs IS NULL OR NOT list_contains(gs, j) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM a LEFT JOIN kept USING (doc_id)"""

ORACLE_SQL = {
    "op2_quality_rules": _rules(),
    "op4_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_suffix_dedup": SUFFIX_DEDUP,
    "op7_pii": _pii(),
    "op9_secret_scan": _secrets(),
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_substring_dedup": SUBSTRING_DEDUP,
}
