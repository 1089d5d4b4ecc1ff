"""Personal data: patterns propose, checksums confirm, context adjusts.

All of it is built-in functions. Kinds email, ip, card and phone are the base; they stay whatever
their score. iban (mod 97) and ssn are added when their score reaches ``THRESHOLD``: the score of a
kind, plus a bonus if one of its context words stands within ``REACH`` code points before the span. Every step is
linear in the text, however many matches it has.

Defined results: a null text is empty and has no spans. Repeated rows give equal results. Spans of
different kinds may overlap; redaction then keeps the one that starts first (of equal starts, the
longest) and leaves out what overlaps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.spans import CHUNK, SPAN, bound, listed, quoted, scan, spans

THRESHOLD = 0.7

# The base patterns. Possessive quantifiers and \G only spare backtracking; a match
# may start inside a run of its first class only where the previous match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
# A match takes the first four characters only, so that no candidate hides another; its group is what
# may follow and one character more.
IBAN_REST = r"(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
IBAN_HEAD = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(" + IBAN_REST + r"[\s\S]?))"
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
# The group is the character behind a match.
SSN_AND_NEXT = SSN + r"(?=([\s\S]?))"

#: kind: (score without context, bonus, context words in lower case)
SCORES = {
    "email": (0.9, 0.1, "mail|contact|write"),
    "ip": (0.6, 0.3, "ip|address|host|server"),
    "card": (0.8, 0.2, "card|credit|visa|payment|karte|tarjeta|carte"),
    "phone": (0.6, 0.3, "phone|call|tel|fax|mobile"),
    "iban": (0.8, 0.2, "iban|account|bank|konto"),
    "ssn": (0.4, 0.5, "ssn|social security|tax id"),
}
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

_OCTETS = "(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:[.]|$)){4}"


def luhn(digits: str) -> str:
    """A SQL condition: the digits pass the Luhn check."""
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1,
        cast(substring({digits}, -i, 1) as int),
        2 * cast(substring({digits}, -i, 1) as int) - if(substring({digits}, -i, 1) > '4', 9, 0))) % 10 = 0"""


def mod97(code: str) -> str:
    """A SQL condition: the code, its first four characters moved to the end, leaves 1 modulo 97."""
    moved = f"concat(substring({code}, 5), substring({code}, 1, 4))"
    return f"""aggregate(sequence(1, length({code})), 0, (r, i) -> if(substring({moved}, i, 1) >= 'A',
        (r * 100 + ascii(substring({moved}, i, 1)) - 55) % 97, (r * 10 + cast(substring({moved}, i, 1) as int)) % 97)) = 1"""


def whole_ibans() -> str:
    """A SQL expression: the spans of ``__iban`` (heads and what may follow), each cut where an IBAN ends.

    Ends are tried before each blank and at the last character. The length of the country goes
    first, then the longest; a span that begins inside the one before it is left out.
    """
    code = "replace(substring(y.full, 1, e), ' ', '')"
    known = " or ".join(f"(length({code}) = {n} and array_contains(array({', '.join(map(repr, c.split()))}), substring(y.full, 1, 2)))" for n, c in IBAN_LENGTHS.items())
    ends = f"""filter(sequence(12, length(y.full)), e -> not (substring(y.seen, e + 1, 1) rlike '[A-Za-z0-9]') and substring(y.full, e, 1) <> ' '
        and length({code}) between 15 and 34 and {mod97(code)})"""
    best = f"array_max(transform({ends}, e -> named_struct('known', {known}, 'e', e))).e"
    full = f"named_struct('x', x, 'seen', concat(x.found, x.value), 'full', concat(x.found, regexp_extract(x.value, {quoted('^' + IBAN_REST)}, 0)))"
    cut = f"filter(transform(transform(__iban, x -> {full}), y -> named_struct('x', y.x, 'full', y.full, 'n', {best})), y -> y.n is not null)"
    spans_of = "named_struct('start', x.x.start, 'end', x.x.start + x.n, 'found', substring(x.full, 1, x.n), 'value', substring(x.full, 1, x.n), 'before', x.x.before)"
    one = SPAN.removeprefix("array<").removesuffix(">")
    return scan(cut, "0", one, "if(x.x.start < $, $, x.x.start + x.n)", f"if(x.x.start < $, cast(array() as {SPAN}), array({spans_of}))")


def score(kind: str, span: str) -> str:
    """A SQL expression: the score of the span (a struct) of this kind."""
    alone, bonus, words = SCORES[kind]
    return f"({alone}D + if(lower({span}.before) rlike {quoted(words)}, {bonus}D, 0D))"


def detected(docs: DataFrame) -> DataFrame:
    """docs with one column of spans for each kind, named ``__<kind>``, and the text as ``__text``."""
    docs = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    digit = "__text rlike '[0-9]'"
    found: dict[str, Column] = {
        "email": spans("__text", EMAIL, "contains(__text, '@')"),
        "ip": spans("__text", IP, "__text rlike '[0-9][.][0-9]'"),
        "card": spans("__text", CARD, digit),
        "phone": spans("__text", PHONE, "contains(__text, '+')"),
        "iban": spans("__text", IBAN_HEAD, "__text rlike '[A-Z]{2}[0-9]{2}'", 1),
        "ssn": spans("__text", SSN_AND_NEXT, "__text rlike '[0-9]-[0-9]{2}-[0-9]'", 1),
    }
    valid = {
        "email": "true",
        "ip": f"x.found rlike {quoted('^' + _OCTETS + '$')}",
        "card": f"length(regexp_replace(x.found, '[^0-9]', '')) between 13 and 19 and {luhn('regexp_replace(x.found, "[^0-9]", "")')}",
        "phone": "length(regexp_replace(x.found, '[^0-9]', '')) between 9 and 15",
        "iban": "true",
        "ssn": "not (right(x.before, 1) rlike '[0-9-]') and not (x.value rlike '[0-9-]') and not (x.found rlike '^(000|666|9)|-00-|0000$')",
    }
    docs = docs.withColumns({f"__{kind}": column for kind, column in found.items()})
    docs = docs.withColumn("__iban", F.expr(whole_ibans()))
    confirmed = {}
    for kind in KINDS:
        keep = valid[kind] if kind in BASE else f"({valid[kind]}) and {score(kind, 'x')} >= {THRESHOLD}D"
        confirmed[f"__{kind}"] = F.expr(f"filter(__{kind}, x -> {keep})")
    return docs.withColumns(confirmed)


def report(docs: DataFrame) -> DataFrame:
    """Counts and spans for every row of docs."""
    rows = detected(docs.select("doc_id", "text"))
    base = listed([(k, f"__{k}") for k in BASE], "kind")
    return rows.select(
        "doc_id", *(F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in BASE), F.sha2(base, 256).alias("base_sha256"), listed([(k, f"__{k}") for k in KINDS], "kind").alias("spans")
    )


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, found and score: one row for each span."""
    rows = detected(docs.select("doc_id", "text"))
    all_of = [F.expr(f"transform(__{k}, x -> named_struct('kind', '{k}', 'start', x.start, 'end', x.end, 'found', x.found, 'score', {score(k, 'x')}))") for k in KINDS]
    return rows.select("doc_id", F.inline(F.concat(*all_of)))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; n_chars follows if there is such a column."""
    columns = docs.columns
    rows = detected(docs)
    every = ", ".join(f"transform(__{k}, x -> named_struct('start', x.start, 'rest', -x.end, 'end', x.end, 'kind', '[{k.upper()}]'))" for k in KINDS)
    rows = rows.withColumn("__all", F.expr(f"sort_array(concat({every}))"))
    one = "struct<start:int,rest:int,end:int,kind:string>"
    kept = scan("__all", "0", one, "if(x.start < $, $, x.end)", f"if(x.start < $, cast(array() as array<{one}>), array(x))")
    # a chunk of spans is cut out of the text once, and what stands before each of its spans out of that
    chunks = f"transform(sequence(1, size(kept), {CHUNK}), i -> slice(kept, i, {CHUNK}))"
    since = "if(i = 0, 0, element_at(element_at(chunks, if(i = 0, 1, i)), -1).end)"
    last = "if(j = 0, since, element_at(c, if(j = 0, 1, j)).end)"
    piece = f"concat(substring(part, {last} - since + 1, x.start - {last}), x.kind)"
    part = "substring(__text, since + 1, element_at(c, -1).end - since)"
    joined = bound(since, "since", bound(part, "part", f"array_join(transform(c, (x, j) -> {piece}), '')"))
    rebuilt = f"concat(array_join(transform(chunks, (c, i) -> {joined}), ''), substring(__text, element_at(kept, -1).end + 1))"
    rows = rows.withColumn("text", F.expr(f"if(size(__all) = 0, text, {bound(kept, 'kept', bound(chunks, 'chunks', rebuilt))})"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size("__all") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return rows.select(*columns)
