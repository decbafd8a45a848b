"""Secret scan through a trigram index.

From each rule's regular expression follow trigrams that every match contains, as an "and" of "or"s of
"and"s. Texts are indexed by those trigrams (in lower case), postings are intersected to candidates, and
the expression is run on candidates alone. A rule without such trigrams scans every text.
"""

from __future__ import annotations

import re
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.spans import joined, listed, matches, of_kind, placed, replaced, without_overlap
from estatelens.llm.words import ascii_lower, packed, unpacked


class Rule(NamedTuple):
    """``group`` has to have ``least`` characters; matches that fail are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The kinds of the contract. Runs that cannot give back characters are possessive.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # A run of at least 16 is a run whose length is checked already.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

#: Formats that their issuers publish.
FURTHER_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("login_url", r"[A-Za-z]{2,12}://[A-Za-z0-9_.-]{1,64}:[A-Za-z0-9_.%+-]{3,128}@"),
)

RULES = BASE_RULES + FURTHER_RULES

#: An alternative is a set of trigrams, a clause a list of alternatives, a query a list of clauses.
Query = list[list[frozenset[str]]]

_MOST_STRINGS = 24


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that any match contains; empty if none are certain."""
    clauses: Query = []

    def close(strings: set[str]) -> None:
        if strings and min(map(len, strings)) >= 3:
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(sorted(sets, key=sorted))

    def strings_of(nodes) -> set[str] | None:
        """All strings that the nodes match, in lower case, if few."""
        parts = []
        for op, value in nodes:
            name = str(op)
            if name == "LITERAL":
                parts.append({chr(value).lower()})
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
                parts.append({chr(v).lower() for _, v in value})
            elif name == "SUBPATTERN":
                parts.append(strings_of(value[3]))
            elif name == "BRANCH":
                branches = [strings_of(b) for b in value[1]]
                parts.append(None if None in branches else set().union(*branches))
            elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT") and value[0] == value[1] and value[0] <= 8:
                parts.append(strings_of(list(value[2]) * value[0]))
            elif name == "MAX_REPEAT" and value[:2] == (0, 1):
                inner = strings_of(value[2])
                parts.append(None if inner is None else inner | {""})
            else:
                parts.append(None)
            if parts[-1] is None:
                return None
        found = {"".join(p) for p in product(*parts)}
        return found if len(found) <= _MOST_STRINGS else None

    def walk(nodes) -> None:
        """Runs of nodes with few strings give a clause; a repeated group is walked for one of its rounds."""
        run: set[str] = {""}
        for node in nodes:
            op, value = str(node[0]), node[1]
            here = strings_of([node])
            joint = {a + b for a in run for b in here} if here is not None else None
            if joint is not None and len(joint) <= _MOST_STRINGS:
                run = joint
                continue
            close(run)
            run = {""}
            if op == "SUBPATTERN":
                walk(value[3])
            elif op in ("MAX_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
                walk(value[2])
        close(run)

    walk(re._parser.parse(pattern))
    return clauses


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text_key, rules`` of texts whose postings satisfy a rule's query; only rules with a query."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    rows = [
        (kind, c, a, len(alternative), len(query), trigram)
        for kind, query in queries.items()
        for c, clause in enumerate(query)
        for a, alternative in enumerate(clause)
        for trigram in sorted(alternative)
    ]
    terms = docs.sparkSession.createDataFrame(
        rows, "rule string, clause int, alternative int, trigrams int, clauses int, trigram string"
    )
    indexed = sorted({r[-1] for r in rows})
    key = ["doc_id", "text_key"]
    folded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), ascii_lower(F.col("text")).alias("folded"))
    held = F.filter(F.array(*map(F.lit, indexed)), lambda t: F.col("folded").contains(t))
    postings = folded.select(*key, F.explode(held).alias("trigram"))
    # The terms are those of the rules, however many texts there are.
    return (
        postings.join(F.broadcast(terms), "trigram")
        .groupBy(*key, "rule", "clause", "alternative")
        .agg(
            F.count_distinct("trigram").alias("held"),
            F.first("trigrams").alias("trigrams"),
            F.first("clauses").alias("clauses"),
        )
        .where("held = trigrams")
        .groupBy(*key, "rule")
        .agg(F.count_distinct("clause").alias("held"), F.first("clauses").alias("clauses"))
        .where("held = clauses")
        .groupBy(*key)
        .agg(F.collect_set("rule").alias("rules"))
    )


def _kept(spans: Column, rule: Rule) -> Column:
    if not rule.least:
        return spans
    return F.filter(
        spans, lambda s: F.char_length(F.regexp_extract(s["value"], rule.pattern, rule.group)) >= rule.least
    )


def with_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secret_spans__``, an array of ``start, rank, end, kind`` in this order; see ``scan_secrets``."""
    found = candidates(docs, rules).select(
        F.col("doc_id").alias("secret_id__"), F.col("text_key").alias("secret_key__"), F.col("rules").alias("secret_rules__")
    )
    same = docs["doc_id"].eqNullSafe(found["secret_id__"]) & (F.xxhash64(docs["text"]) == found["secret_key__"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.join(found, same, "left").select(*columns, "secret_rules__")
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<string>")
    for r in rules:
        hits = matches(text, r.pattern)
        if trigram_query(r.pattern):
            hits = F.when(F.array_contains("secret_rules__", r.kind), hits).otherwise(none)
        rows = rows.withColumn(f"secret_{r.kind}__", hits)
    spans = [
        of_kind(_kept(placed(text, F.col(f"secret_{r.kind}__"), r.pattern), r), r.kind, i) for i, r in enumerate(rules)
    ]
    return rows.select(*columns, listed(*spans).alias("secret_spans__"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans`` of each row: ``spans`` as ``start, rank, end, kind``, by start and then by rule.

    Places count code points from 0. A null or empty text has no spans; equal rows give equal rows; a
    null ``doc_id`` is a key like any other; other columns are not read.
    """
    return with_secrets(docs.select("doc_id", "text"), rules).select("doc_id", F.col("secret_spans__").alias("spans"))


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret replaced by its kind in square brackets; the columns are those of ``docs``."""
    rows = with_secrets(packed(docs), rules).withColumn("secret_runs__", without_overlap(F.col("secret_spans__")))
    text = replaced(F.col("text"), F.col("secret_runs__"))
    return rows.select(*unpacked(docs, text))


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)


