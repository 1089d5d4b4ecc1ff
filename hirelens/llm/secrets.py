"""Secrets, and whether many owners share them.

Patterns propose spans. The values found are then counted over the whole corpus by the number of
distinct repositories and owners that hold them: a value that several owners hold is a copied
example, one that stays with one owner looks live. All of it is built-in functions and aggregations;
counts are combined before each shuffle, so a value that a third of all rows hold moves as a few
partial rows.

Defined results: a null text is empty; a null owner or repository counts as one owner or repository
of its own. The span of a private key is its header, its value the key behind it without white space
(line breaks may be written as ``\\n``); a header without a key is its own value. Repeated rows give
equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools
from hirelens.llm.spans import listed, quoted, spans

# The base patterns.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
GITHUB = r"gh[pousr]_[A-Za-z0-9]{36,}"
SLACK = r"xox[abprs]-[A-Za-z0-9-]{10,}"
KEY = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
# What follows the header: all up to the footer, or the long base64 runs of a key without one.
BODY = r"(?=([^-]*+(?:-(?!----)[^-]*+)*+(?=-----END )|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{16,}+)*+))"

BLANKS = r"\s|\\[nr]"

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "slack", "private_key")


def detected(docs: DataFrame) -> DataFrame:
    """docs with one column of spans for each kind, named ``__<kind>``."""
    docs = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    word = r"'(?i:password|passwd|secret|token|api_?key)[^a-z]'"
    found: dict[str, Column] = {
        "assign": spans("__text", ASSIGN, f"(contains(__text, '=') or contains(__text, ':')) and __text rlike {word}", 2),
        "access": spans("__text", ACCESS, "contains(__text, 'AKIA')"),
        "hex": spans("__text", HEX, "__text rlike '[0-9a-f]{24}'"),
        "github": spans("__text", GITHUB, "contains(__text, 'gh')"),
        "slack": spans("__text", SLACK, "contains(__text, 'xox')"),
        "private_key": spans("__text", KEY + BODY, "contains(__text, '-----BEGIN ')", 1),
    }
    docs = docs.withColumns({f"__{kind}": column for kind, column in found.items()})
    body = f"regexp_replace(x.value, {quoted(BLANKS)}, '')"
    docs = docs.withColumn("__private_key", F.expr(f"transform(__private_key, x -> named_struct('start', x.start, 'end', x.end, 'found', x.found, 'value', if({body} = '', x.found, {body}), 'before', x.before))"))
    apart = "filter(__{0}, x -> not (right(x.before, 1) rlike '[A-Za-z0-9]'))".format
    return docs.withColumns({"__assign": F.expr("filter(__assign, x -> length(x.value) >= 6)"), **{f"__{kind}": F.expr(apart(kind)) for kind in ("github", "slack")}})


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, n_repositories and n_owners of every value; found has value_hash, repository, owner."""
    each = found.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = each.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("value_hash").agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))


def report(docs: DataFrame, owner: str = "source", repository: str = "doc_id", shared_by: int = 3) -> DataFrame:
    """Spans of every row of docs, and how many of its values look live or are examples.

    A value is an example if at least ``shared_by`` owners hold it. A repository is the ``repository``
    within its owner.
    """
    rows = detected(docs.select("doc_id", "text", F.col(owner).alias("__owner"), F.col(repository).alias("__repository")))
    values = F.concat(*(F.expr(f"transform(__{k}, x -> sha2(x.value, 256))") for k in KINDS))
    rows = rows.select(
        "doc_id", F.xxhash64("text").alias("__key"), "__owner", "__repository", *(F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed([(k, f"__{k}") for k in BASE], "start"), 256).alias("base_sha256"), listed([(k, f"__{k}") for k in KINDS], "start").alias("spans"), values.alias("__values"),
    )
    rows = tools.staged(rows, "secrets")
    held = rows.select("__key", "__owner", "__repository", F.explode("__values").alias("value_hash"))
    owned = ownership(held.select("value_hash", F.col("__owner").alias("owner"), F.col("__repository").alias("repository")))
    # equal texts hold equal values, so verdicts are counted once for each text
    texts = rows.filter(F.size("__values") > 0).groupBy("__key").agg(F.first("__values").alias("__values"))
    judged = texts.select("__key", F.explode("__values").alias("value_hash")).join(owned, "value_hash")
    example = (F.col("n_owners") >= shared_by).cast("long")
    judged = judged.groupBy("__key").agg(F.sum(1 - example).alias("n_live"), F.sum(example).alias("n_example"))
    whole = rows.join(judged, "__key", "left").fillna(0, ["n_live", "n_example"])
    return whole.select("doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_live", "n_example")
