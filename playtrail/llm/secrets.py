"""Secret scans over a trigram inverted index (DataFrame and SQL functions only).

From each rule's regex a Boolean trigram query is derived: an OR of clauses,
each an AND of trigrams that a match must contain (compared in lower case).
The index holds a posting (trigram, document) for every trigram that some rule
asks for. Postings are intersected by a count of bits per (document, clause);
documents that satisfy a clause are candidates and only they are verified with
the rule's regex. A rule without mandatory trigrams scans every document.

Documents are addressed by a hash of key and text. Should two of them share an
address, the candidates of both are verified, so the result stays exact.

Defined results: a null text is the empty text and has no spans; repeated rows
are scanned one by one; an empty table gives no rows; the key is carried as it
is (null included) and other columns are not.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import sql_text, values_table, whole_text
from playtrail.session import bounded_broadcast, materialize


@dataclass(frozen=True)
class SecretRule:
    """A match of ``regex`` counts if its ``group`` has at least ``least`` characters."""
    kind: str
    regex: str
    group: int
    least: int


BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
)
EXTRA_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    SecretRule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    SecretRule("slack", r"xox[abp]-[A-Za-z0-9-]+", 0, 15),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
RULES = BASE_RULES + EXTRA_RULES

Clauses = frozenset  # of frozensets of trigrams: an OR of ANDs
TRUE: Clauses = frozenset([frozenset()])
MAX_STRINGS = 48


def _any(a: Clauses, b: Clauses) -> Clauses:
    both = a | b
    return frozenset(x for x in both if not any(y < x for y in both))


def _all(a: Clauses, b: Clauses) -> Clauses:
    if len(a) * len(b) > 4 * MAX_STRINGS:  # either alone is a weaker, still valid query
        return min(a, b, key=len)
    return _any(frozenset(x | y for x in a for y in b), frozenset())


def _of_strings(strings: frozenset) -> Clauses:
    out: Clauses = frozenset()
    for s in strings:
        out = _any(out, frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]))
    return out


def _read(nodes) -> tuple[frozenset | None, Clauses]:
    """Of a parsed sequence: all lower-case strings it matches if those are few,
    and a trigram query that each match satisfies."""
    exact: frozenset | None = frozenset([""])   # the whole sequence so far, if finite
    run, query = frozenset([""]), TRUE          # the strings of the current finite run
    for op, arg in nodes:
        strings, inner = _one(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            exact = frozenset(a + b for a in exact for b in strings) if exact is not None else None
        else:
            query = _all(_all(query, _of_strings(run)), inner)
            run, exact = frozenset([""]), None
    return exact, _all(query, _of_strings(run))


def _one(op, arg) -> tuple[frozenset | None, Clauses]:
    if op is sre.LITERAL:
        return frozenset([chr(arg).lower()]), TRUE
    if op is sre.IN:
        chars = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                chars.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < 8:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None, TRUE
        return (frozenset(chars), TRUE) if len(chars) <= 8 else (None, TRUE)
    if op is sre.SUBPATTERN:
        return _read(arg[-1])
    if op is sre.BRANCH:
        parts = [_read(x) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            whole = frozenset().union(*[s for s, _ in parts])
            if len(whole) <= MAX_STRINGS:
                return whole, _of_strings(whole)
        query: Clauses = frozenset()
        for _, q in parts:
            query = _any(query, q)
        return None, query
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        strings, inner = _read(body)
        if strings is not None and low == high == 1:
            return strings, inner
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, TRUE
        return None, inner if low else TRUE
    if op is sre.AT:
        return frozenset([""]), TRUE
    return None, TRUE


def trigram_query(regex: str) -> Clauses:
    """OR of ANDs of lower-case trigrams that every match of ``regex`` contains;
    ``TRUE`` (one empty clause) if no trigram is mandatory."""
    query = _read(sre_parser.parse(regex))[1]
    return TRUE if frozenset() in query else query


def with_address(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    return df.withColumn("addr", F.xxhash64(F.col("doc_id").cast("string"), "t"))


def build_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``(tri, addr)``: the asked trigrams that each whole text contains."""
    low = with_address(docs, id_col, text_col).select("addr", F.lower("t").alias("low"))
    asked = F.array(*[F.lit(t) for t in trigrams])
    return low.select(F.explode(F.filter(asked, lambda t: F.contains(F.col("low"), t))).alias("tri"), "addr")


def candidates(index: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """Intersect postings: ``(addr, kinds)`` for documents with all trigrams of a clause."""
    rows = [f"({sql_text(kind)}, {c}, {1 << i}L, {(1 << len(clause)) - 1}L, {sql_text(tri)})"
            for kind, clauses in queries.items() for c, clause in enumerate(sorted(clauses, key=sorted))
            for i, tri in enumerate(sorted(clause))]
    clauses = values_table(index.sparkSession, "kind, clause, bit, want, tri", rows)
    return (index.join(F.broadcast(clauses), "tri").groupBy("addr", "kind", "clause", "want")
            .agg(F.bit_or("bit").alias("got")).where("got = want")
            .groupBy("addr").agg(F.collect_set("kind").alias("kinds")))


def spans_of(text: Column, rule: SecretRule, order: int) -> Column:
    """Spans ``(start, ord, end, kind)`` of the rule, leftmost first, in code points.
    The pieces between the matches and the matches alternate, so a running
    length gives the start of each match."""
    m, pieces = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), F.split(text, rule.regex, -1)
    g = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else m
    kind = "struct<start:long,ord:int,end:long,kind:string>"
    none = F.array().cast(f"array<{kind}>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = F.length(x["g"]) >= rule.least
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    zipped = F.filter(F.arrays_zip(pieces.alias("p"), m.alias("m"), g.alias("g")), lambda x: x["m"].isNotNull())
    found = F.aggregate(zipped, start, step, lambda acc: acc["out"])
    return F.when(F.rlike(text, F.lit(_cheap(rule))), found).otherwise(none)


def _cheap(rule: SecretRule) -> str:
    """A pattern that holds for every text with a match that counts."""
    if rule.group == 0 and rule.regex.endswith("]+") and rule.regex.startswith("["):
        return f"{rule.regex[:-1]}{{{rule.least}}}"
    return rule.regex


def secret_scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text", max_broadcast_rows: int = 200_000) -> DataFrame:
    """All secret spans of every document: ``doc_id`` and ``found``, an array of
    ``(start, ord, end, kind)`` by start, then rule order.

    The candidate list is broadcast up to ``max_broadcast_rows`` rows (a hash
    and a few kind names each); beyond, it is joined by a shuffle."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != TRUE}
    df = with_address(docs, id_col, text_col)
    if indexed:
        asked = sorted({t for q in indexed.values() for clause in q for t in clause})
        hits = materialize(candidates(build_index(docs, asked, id_col, text_col), indexed), "secret-candidates")
        df = df.join(bounded_broadcast(hits, max_broadcast_rows), "addr", "left")
    found = []
    for i, r in enumerate(rules):
        spans = spans_of(F.col("t"), r, i)
        if r.kind in indexed:
            spans = F.when(F.array_contains("kinds", r.kind), spans)
        found.append(F.coalesce(spans, F.array().cast("array<struct<start:long,ord:int,end:long,kind:string>>")))
    return df.select("doc_id", F.sort_array(F.flatten(F.array(*found))).alias("found"))


def digest_columns(found: DataFrame, base: tuple[SecretRule, ...] = BASE_RULES) -> DataFrame:
    """Counts per base kind, SHA-256 of the base spans and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    names = [r.kind for r in base]
    return found.select(
        "doc_id",
        *[count(kind) for kind in names],
        F.sha2(text(F.filter("found", lambda s: s["kind"].isin(names))), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"))
