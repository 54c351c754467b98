"""URL reputation, phrase stripes and periodic runs: brute force and odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from playtrail.llm import periodic_runs
from playtrail.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, runs string, text_ string, h int, prefix string"


# ---------------------------------------------------------------- periodic runs

def plain_runs(w):
    """All runs by checking every start for every period."""
    n, out = len(w), {}
    for q in range(1, n // periodic_runs.EXPONENT + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(periodic_runs.MIN_LENGTH, periodic_runs.EXPONENT * q):
                # a stretch that a smaller period already explains is no run of this one
                if not any(q % p == 0 and (i, length, p) in out for p in range(1, q)):
                    out[i, length, q] = None
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def in_runs(words):
    table = {x: i for i, x in enumerate(dict.fromkeys(words))}
    return periodic_runs.group_runs(np.array([table[x] for x in words], np.int64), np.array([len(words)])).get(0, [])


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for trial in range(400):
        if trial % 2:
            words = rng.choices("ab" if trial % 4 == 1 else "abc", k=rng.randint(0, 60))
        else:
            words = []
            while len(words) < 80:
                piece = rng.choices("abcde", k=rng.randint(1, 9))
                words += piece * rng.randint(1, 8) + piece[:rng.randint(0, len(piece))]
        if words:
            assert in_runs(words) == plain_runs(words), words


def test_runs_of_one_word_and_of_a_long_text():
    assert in_runs(["a"] * 5) == []
    assert in_runs(["a"] * 6) == [(0, 6, 1)]
    assert in_runs(["a", "b"] * 4) == [(0, 8, 2)]
    assert in_runs(["a", "b"] * 3 + ["a"]) == []
    assert in_runs(["x"] + ["a"] * 300_000 + ["y"]) == [(1, 300_000, 1)]
    unit = [f"w{i}" for i in range(5_000)]
    assert in_runs(["x"] + unit * 12 + ["y"]) == [(1, 60_000, 5_000)]


def test_find_runs_on_odd_rows(spark):
    long = " ".join(["lorem", "ipsum", "dolor"] * 20_000)
    texts = [(1, None), (2, ""), (3, " \n "), (4, "a a a a a a b"), (4, "a a a a a a b"), (None, "x y x\ty x y\nx y z"),
             (5, long), (6, "é é é é é é"), (7, "a b " * 7)]
    df = spark.createDataFrame([(i, t, "l", "s", "r", "t", 1, "p") for i, t in texts], SCHEMA)
    got = periodic_runs.find_runs(df).collect()
    want = []
    for i, t in texts:
        w = WORD.findall(t or "")
        runs = [(0, 60_000, 3)] if i == 5 else plain_runs(w)
        want.append((str(i), len(w), runs, plain_collapse(w, runs)))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]


def test_query_of_periodic_runs_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = planted(d.doc_id, WORD.findall(d.text or ""))
        if len(w) > 2500:
            continue
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        some += bool(runs)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert got[d.doc_id] == (len(runs), *best, best[1] and 1000 * best[1] // best[2],
                                 sha("".join("%d,%d,%d\n" % r for r in runs)), sha(plain_collapse(w, runs))), d.doc_id
    assert some > 5


# ---------------------------------------------------------------- phrase collocations

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, words, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for m in range(1, words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = []
    for lang in n:
        scored = []
        for (g, p), a in cands.items():
            if g != lang or any(g2 == lang and len(q) > len(p) and inside(p, q) and 100 * b >= 80 * a for (g2, q), b in cands.items()):
                continue
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(seed):
    rng = random.Random(seed)
    vocab = ["the", "The", "cat", "sat", "on", "a", "mat", "é", "日本", "x\u00a0y", "\U0001F600"]
    rows = [(None, None), ("en", None), ("en", ""), ("de", " \t ,;. \n"), ("", "the cat sat"), ("en", ", ".join(["the cat sat on"] * 50))]
    for _ in range(120):
        lang = rng.choice(["en", "en", "en", None])
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 40))]
        rows.append((lang, "".join(w + rng.choice([" ", "  ", "\t", ", ", "\n", " ", " "]) for w in words)))
    rows.append(("en", "the cat " * 30_000))       # one long text: a hot prefix
    return rows


@pytest.mark.parametrize("chunk_bytes", [200, 8 << 20])
def test_collocations_equal_brute_force(spark, chunk_bytes):
    from playtrail.llm import collocations as C
    rows = phrase_rows(chunk_bytes)
    df = spark.createDataFrame([(i % 5, t, g, "s", "r", "t", 1, "p") for i, (g, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = C.collocations(df, least=5, top=40, chunk_bytes=chunk_bytes, per_part=40).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, 4, 5, 40)
    assert len({r.lang for r in got}) == 2


def test_collocations_of_nothing(spark):
    from playtrail.llm import collocations as C
    df = spark.createDataFrame([(1, "a b c", "en", "s", "r", "t", 1, "p")], SCHEMA)
    assert C.collocations(df).count() == 0
    assert C.collocations(df.limit(0)).count() == 0


def test_full_filter_loses_nothing(spark, monkeypatch):
    """A bitmap far too small lets everything through; the counts stay exact."""
    from playtrail.llm import collocations as C
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 13)
    monkeypatch.setattr(C, "LEAST_BITS", 1 << 13)
    rows = phrase_rows(7)
    df = spark.createDataFrame([(i, t, g, "s", "r", "t", 1, "p") for i, (g, t) in enumerate(rows)], SCHEMA)
    got = C.collocations(df, least=5, top=25).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, 4, 5, 25)


def test_stripe_of_a_heavy_prefix_is_many_groups(spark):
    from playtrail.llm import collocations as C
    df = spark.createDataFrame([("en", " ".join(f"the w{i % 500}," for i in range(1500)))], "lang string, text string")
    share = lambda x: spark.sparkContext.broadcast(x)
    every = share(C.Filter(64, np.full(8, 255, np.uint8)))
    for heavy, parts in (({}, 1), ({("en", b"the"): 16}, 16)):
        given = df.mapInArrow(C._pass(2, every, every, share(heavy), C.LEAST_BITS, 30, 4), C.PASS)
        assert given.where("exists(stripes, s -> s.prefix = 'the')").select("group").distinct().count() == parts
        merged = {r.next: r.n for r in C.merged_stripes(given).where("prefix = 'the'").collect()}
        assert merged == {f"w{i}": 3 for i in range(500)}


# ---------------------------------------------------------------- url filter

URLS = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "http://example.org/en/1/2", "http://example.org/en/2",
        "http://notexample.org/es/", "http://org/x", "http://org", "ftp://u:p@sub.example.com:8080/fr/é", "http://example.com/de/",
        "http://example.com/DE/", "http://xcom/fr/", "a://b://c.com/fr/", "http://127.0.0.1/fr/", "http://x.org?p=/es/", "http://x.org#/",
        "http://h.co.uk/a\nb", "http://É.com/fr/"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_rules_on_odd_urls(spark):
    from playtrail.llm import url_reputation as U
    rows = [(i if i else None, u, "html", "h", "n", 1.0, "r") for i, u in enumerate(URLS + URLS[4:6])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, name string, mean double, rule string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = U.url_filter(pages, none).collect()
    want = []
    for i, u, *_ in rows:
        host, path = plain_parts(u)
        name, verdict = plain_rule(host, path)
        want.append((str(i), host, path, str(name), verdict or "allow"))
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted(want)
    assert U.url_filter(pages.limit(0), none).count() == 0


def reputation_fixture(spark):
    rng = random.Random(5)
    pages, outcomes, k = [], [], 0
    for host, n, rate in [("bad.spam.net", 60, 0.95), ("new.spam.net", 0, 0), ("www.spam.net", 80, 0.9), ("good.site.net", 200, 0.02),
                          ("few.site.net", 1, 1.0), ("a.co.uk", 30, 0.05), ("b.co.uk", 30, 0.1), ("hot.big.net", 2000, 0.05)]:
        for _ in range(n + 3):
            pages.append((k, f"http://{host}/p{k}"))
            if n:
                outcomes.append((k, rng.random() < rate))
            k += 1
    outcomes += outcomes[:5] + [(None, True), (10**9, True)]
    return (spark.createDataFrame(pages, "page_id long, url string"),
            spark.createDataFrame(outcomes, "page_id long, bad boolean"))


def plain_reputation(pages, outcomes):
    from playtrail.llm import url_reputation as U
    bad = {}
    for p, b in outcomes:
        bad[p] = max(bad.get(p, False), b)
    level = lambda h: (h, ".".join(h.split(".")[-(3 if h.endswith(".co.uk") else 2):]), "co.uk" if h.endswith(".co.uk") else h.split(".")[-1])
    counts = [collections.defaultdict(lambda: [0, 0]) for _ in range(3)]
    for p, u in pages:
        for c, name in zip(counts, level(plain_parts(u)[0])):
            c[name][0] += p in bad
            c[name][1] += bad.get(p, False)
    names = {plain_parts(u)[0] for _, u in pages}
    n = sum(v[0] for v in counts[2].values())
    prior = dict.fromkeys(counts[2], (sum(v[1] for v in counts[2].values()) + 1) / (n + 2))
    for lv in (2, 1, 0):
        c = counts[lv]
        num = sum((b - m * prior[g]) ** 2 - m * prior[g] * (1 - prior[g]) for g, (m, b) in c.items())
        den = sum(m * (m - 1) * prior[g] * (1 - prior[g]) for g, (m, b) in c.items())
        rho = num / den if den else 0
        k = U.STRENGTH[1] if rho <= 1 / (U.STRENGTH[1] + 1) else min(U.STRENGTH[1], max(U.STRENGTH[0], 1 / rho - 1))
        mean = {g: (b + k * prior[g]) / (m + k) for g, (m, b) in c.items()}
        if lv:
            prior = {level(h)[lv - 1]: mean[level(h)[lv]] for h in names}
    return {g: (m, mean[g], mean[g] - U.Z * (mean[g] * (1 - mean[g]) / (m + k + 1)) ** 0.5) for g, (m, b) in c.items()}


@pytest.mark.parametrize("salted", [False, True])
def test_reputation_equals_plain_arithmetic(spark, monkeypatch, salted):
    from playtrail.llm import url_reputation as U
    if salted:     # no broadcast of the reputations; hot hosts over several tasks
        monkeypatch.setattr(U, "LOOKUP_ROWS", 1)
        monkeypatch.setattr(U, "HOT_PAGES", 100)
    pages, outcomes = reputation_fixture(spark)
    got = U.url_filter(pages, outcomes, rules=()).collect()
    assert len(got) == pages.count()
    want = plain_reputation([tuple(r) for r in pages.collect()], [tuple(r) for r in outcomes.collect()])
    for r in got:
        n, mean, bound = want[r.host]
        assert (r.host_labels, r.verdict) == (n, "block" if bound > 0.5 else "allow")
        assert abs(r.bad_share - mean) < 2e-6 and abs(r.bad_bound - bound) < 2e-6
    verdicts = {r.host: r.verdict for r in got}
    # Plain evidence blocks; one bad page on a good domain does not.
    assert verdicts["bad.spam.net"] == verdicts["www.spam.net"] == "block"
    assert verdicts["few.site.net"] == verdicts["good.site.net"] == verdicts["hot.big.net"] == "allow"


def test_url_filter_runs_no_python(spark):
    pages, outcomes = reputation_fixture(spark)
    from playtrail.llm import url_reputation as U
    plan = U.url_filter(pages, outcomes)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
