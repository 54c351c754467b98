"""Personal data: pattern spans, and terms that reveal what the patterns protect.

E-mail addresses, IP addresses, card numbers and phone numbers are found by
pattern. Each distinct value is a protected entity. From the whole corpus, the
co-occurrence of an entity ``c`` and a term ``t`` in the same document estimates
how strongly the term reveals it: with document frequencies, the pointwise mutual
information ``PMI(c; t) = log p(c, t) / (p(c) p(t))`` against the entity's
information ``IC(c) = -log p(c)``. A term that reaches ``ALPHA * IC(c)``, seen with
the entity in two different texts at least, discloses it: wherever it stands in a
document of the entity, outside of the pattern spans, it is a further span. The
rewriting step replaces pattern spans by their kind and generalises disclosing
terms with digits to ``[NUMBER]``, and removes others. Documents without the
entity keep the term: it has nobody to reveal there.

All texts are scanned once, and those of entities in two texts at least twice
more: for their terms and for the places of the disclosing ones. What is shuffled
are document counts of words and of (entity, term) pairs, both summed per batch
first; a term too frequent to reach the threshold with any entity goes before.
Texts meet their entities and terms by broadcast, up to ``EXTRA_ROWS`` texts.

Defined results: a null text is the empty text and has no spans; repeated rows
are documents of their own, with equal spans; an entity of one text only has no
disclosing terms; an empty table gives no rows; a null key is kept; other
columns are not carried (``sanitise`` keeps all columns of its input).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import fresh, whole_text
from playtrail.session import bounded_broadcast, materialize

KINDS = ("email", "ip", "card", "phone")
ALPHA = 0.9            # share of an entity's information that a term may not reveal
BATCH_ROWS = 2_000     # documents whose words are counted together
EXTRA_ROWS = 200_000   # texts with entities or disclosing terms, or frequent terms, that may be broadcast
PAIRS = 500_000        # (entity, term) pairs counted together

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIM = ".,;:!?\"'()[]{}<>|"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From @ to @ instead of from every letter: a match starts at the run of
    local characters before the @, or where the last match ended."""
    at, free = text.find("@"), 0
    while at >= 0:
        begin = free + len(text[free:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` by kind, then start, in code points."""
    out = [(0, b, e) for b, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def entity(kind: int, value: str) -> int:
    """The protected value: digits of numbers, lower case of addresses."""
    return _hash(f"{kind}:" + (value.lower() if kind == 0 else "".join(c for c in value if c.isdigit() or (kind == 1 and c == "."))))


def terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """``(term, start, end)`` of every word of three characters or more outside of
    all spans, trimmed and then in lower case."""
    ends: list[tuple[int, int]] = []      # the union of the spans
    for b, e in sorted((b, e) for _, b, e in spans):
        if ends and b < ends[-1][1]:
            ends[-1] = (ends[-1][0], max(e, ends[-1][1]))
        else:
            ends.append((b, e))
    k = 0
    for m in WORD.finditer(text):
        word = m[0].strip(TRIM)
        if len(word) < 3:
            continue
        s = m.start() + m[0].index(word)
        t = s + len(word)
        while k < len(ends) and ends[k][1] <= s:
            k += 1
        if k == len(ends) or ends[k][0] >= t:
            yield word.lower(), s, t


def term_set(text: str, spans: list[tuple[int, int, int]]) -> set[str]:
    """The distinct terms of a text."""
    if spans:
        return {t for t, _, _ in terms(text, spans)}
    return {w.lower() for w in {w.strip(TRIM) for w in set(WORD.findall(text))} if len(w) >= 3}


SCAN = pa.schema([("doc_id", pa.string()), ("tid", pa.int64()), ("base", pa.list_(pa.string())),
                  ("ents", pa.list_(pa.int64())), ("word", pa.int64()), ("docs", pa.int64())])
SCAN_SQL = "tid long, base array<string>, ents array<long>, word long, docs long"


def _scan(key_type: pa.DataType):
    schema = pa.schema([pa.field("doc_id", key_type), *list(SCAN)[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                rows, counts = [], Counter()
                for text in b.column("t").to_pylist():
                    spans = base_spans(text)
                    rows.append(([f"{KINDS[k]}:{s}:{e}" for k, s, e in spans], sorted({entity(k, text[s:e]) for k, s, e in spans})))
                    counts.update(term_set(text, spans))
                n = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("tid"), *[pa.array([r[i] for r in rows], schema.field(2 + i).type) for i in range(2)],
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, key_type), *[pa.nulls(n, schema.field(i).type) for i in range(1, 4)],
                     pa.array([_hash(w) for w in counts], pa.int64()), pa.array(list(counts.values()), pa.int64())], schema=schema)
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts, written once: a row per document (pattern spans,
    entities) and rows of document counts of words."""
    from pyspark.sql.pandas.types import to_arrow_type
    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t")).withColumn("tid", F.xxhash64("t"))
    kind = df.schema["doc_id"].dataType
    out = df.mapInArrow(_scan(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, {SCAN_SQL}")
    return materialize(out, "pii-scan")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each (entity, term), with the smallest and largest text hash."""
    seen: dict[tuple[int, str], list[int]] = {}

    def counted() -> pa.RecordBatch:
        number = {t: _hash(t) for _, t in seen}
        out = pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in seen], pa.int64()), pa.array([number[t] for _, t in seen], pa.int64()),
             *[pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(3)]], ["ent", "term", "both", "a", "b"])
        seen.clear()
        return out
    for b in batches:
        for text, tid, ents in zip(*(b.column(c).to_pylist() for c in ("t", "tid", "ents"))):
            for term in term_set(text, base_spans(text)):
                for c in ents:
                    x = seen.setdefault((c, term), [0, tid, tid])
                    x[0] += 1
                    x[1], x[2] = min(x[1], tid), max(x[2], tid)
                if len(seen) > PAIRS:
                    yield counted()
    if seen:
        yield counted()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every place of the disclosing terms of each text."""
    for b in batches:
        rows = []
        for text, own in zip(b.column("t").to_pylist(), b.column("own").to_pylist()):
            spans, own, number = base_spans(text), set(own), {}
            rows.append([f"term:{s}:{e}" for t, s, e in terms(text, spans) if (number.get(t) or number.setdefault(t, _hash(t))) in own])
        yield pa.RecordBatch.from_arrays([b.column("tid"), pa.array(rows, pa.list_(pa.string()))], ["tid", "extra"])


def shared_entities(scanned: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Entities of two different texts at least ``(ent, n_ent)``, the texts that hold
    such ones ``(tid, ents)`` and the number of documents."""
    people = scanned.where("base is not null")
    n = people.count()
    each = people.select("tid", F.explode("ents").alias("ent"))
    ents = each.groupBy("ent").agg(F.count(F.lit(1)).alias("n_ent"), F.min("tid").alias("a"), F.max("tid").alias("b"))
    ents = materialize(ents.where((F.col("a") < F.col("b")) & (F.col("n_ent") < n)).select("ent", "n_ent"), "pii-entities")
    held = each.join(bounded_broadcast(ents.select("ent"), EXTRA_ROWS), "ent").groupBy("tid").agg(F.collect_set("ent").alias("ents"))
    return ents, materialize(held, "pii-texts"), n


def disclosing(scanned: DataFrame, texts: DataFrame, shared: tuple[DataFrame, DataFrame, int], alpha: float = ALPHA) -> DataFrame:
    """``(ent, term)`` pairs that reach the disclosure threshold; ``texts`` are ``(tid, t)``."""
    ents, held, n = shared
    words = scanned.where("word is not null").groupBy(F.col("word").alias("term")).agg(F.sum("docs").alias("n_term"))
    words = materialize(words, "pii-words")
    # p(c|t) / p(c) >= p(c) ** -alpha, and a pair has at most the entity's documents, so a term of more
    # than n ** (1 - alpha) * n_ent ** alpha documents reaches it with no entity.
    most = ents.agg(F.max("n_ent")).first()[0] or 0
    frequent = words.where(F.col("n_term") > n ** (1 - alpha) * most ** alpha * 1.001).select("term")
    pairs = texts.join(bounded_broadcast(held, EXTRA_ROWS), "tid").select("t", "tid", "ents").mapInArrow(
        _pairs, "ent long, term long, both long, a long, b long")
    pairs = pairs.join(bounded_broadcast(frequent, EXTRA_ROWS), "term", "left_anti")
    pairs = (pairs.groupBy("ent", "term").agg(F.sum("both").alias("both"), F.min("a").alias("a"), F.max("b").alias("b"))
             .where("a < b").select("ent", "term", "both"))
    all_ = F.lit(float(max(n, 1)))
    pmi = F.log(F.col("both") * all_ / (F.col("n_ent") * F.col("n_term")))
    return (pairs.join(ents, "ent").join(words, "term").where(pmi >= alpha * F.log(all_ / F.col("n_ent")))
            .select("ent", "term"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """``(doc_id, tid, base, extra)``: pattern spans and disclosing spans
    (``kind:start:end``) of every document; ``tid`` is the hash of its text."""
    scanned = scan(docs, id_col, text_col)
    texts = docs.select(whole_text(text_col).alias("t")).withColumn("tid", F.xxhash64("t"))
    shared = shared_entities(scanned)
    reveal = materialize(disclosing(scanned, texts, shared, alpha), "pii-disclosing").groupBy("ent").agg(F.collect_list("term").alias("own"))
    own = shared[1].select("tid", F.explode("ents").alias("ent")).join(reveal, "ent").groupBy("tid").agg(
        F.array_distinct(F.flatten(F.collect_list("own"))).alias("own"))
    own = bounded_broadcast(materialize(own, "pii-terms"), EXTRA_ROWS)
    hit = texts.join(own, "tid").select("tid", "t", "own").mapInArrow(_places, "tid long, extra array<string>")
    hit = materialize(hit.where("size(extra) > 0").groupBy("tid").agg(F.first("extra").alias("extra")), "pii-places")  # equal texts, equal places
    people = scanned.where("base is not null").select("doc_id", "tid", "base")
    return people.join(bounded_broadcast(hit, EXTRA_ROWS), "tid", "left").select(
        "doc_id", "tid", "base", F.coalesce("extra", F.array().cast("array<string>")).alias("extra"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per pattern kind, SHA-256 of the pattern spans and all spans as text."""
    def count(kind):
        return F.size(F.filter("base", lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join(F.concat("base", "extra"), ",").alias("spans"))


def rewrite(text: str, extra: list[str]) -> str:
    """Replace pattern spans by their kind; generalise or remove disclosing terms."""
    spans = [(b, e, f"[{KINDS[k].upper()}]") for k, b, e in base_spans(text)]
    for x in extra:
        _, b, e = x.split(":")
        b, e = int(b), int(e)
        spans.append((b, e, "[NUMBER]" if any(c.isdigit() for c in text[b:e]) else ""))
    out, at = [], 0
    for b, e, new in sorted(spans, key=lambda s: (s[0], -s[1])):
        if e <= at:
            continue          # inside a span already replaced
        out += [text[at:max(b, at)], new]
        at = e
    return "".join(out) + text[at:]


def _rewrite(extra: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [None if t is None else rewrite(t, x or []) for t, x in zip(b.column("text").to_pylist(), b.column(extra).to_pylist())]
            yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(new, pa.string())).drop_columns([extra])
    return run


def sanitise(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """All rows and columns of ``docs`` with rewritten texts (``n_chars`` follows)."""
    key, held, spans = fresh(docs, "text_key", "held_key", "extra_spans")
    found = personal_data(docs, alpha=alpha).where("size(extra) > 0")
    extra = materialize(found.groupBy(F.col("tid").alias(held)).agg(F.first("extra").alias(spans)), "pii-extra")  # equal texts, equal spans
    df = docs.withColumn(key, F.xxhash64(whole_text("text")))
    df = df.join(bounded_broadcast(extra, EXTRA_ROWS), F.col(key) == F.col(held), "left").select(*docs.columns, spans)
    out = df.mapInArrow(_rewrite(spans), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
