"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from playtrail.llm.quality_rules import BASE_RULES, RULES, STOP_WORDS, SYMBOLS
from playtrail.llm.secrets import BASE_RULES as SECRET_BASE
from playtrail.llm.secrets import RULES as SECRET_RULES
from playtrail.llm.secrets import _cheap


def _broken(rule) -> str:
    bounds = [f"{rule.statistic} < {rule.low}"] if rule.low is not None else []
    bounds += [f"{rule.statistic} > {rule.high}"] if rule.high is not None else []
    return f"coalesce({' or '.join(bounds)}, false)"


def quality_rules() -> str:
    stops = sorted({w for t in STOP_WORDS.values() for w in t.split()})
    listed = ", ".join(f"'{w}', '{w.capitalize()}'" for w in stops)
    names = ", ".join(f"case when {_broken(r)} then '{r.name}' end" for r in (*BASE_RULES, *RULES))
    return rf"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
w as (select rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) ls from d),
tri as (select rid, unnest(range(1, len(w) - 1)) i, w from w),
twice as (select rid, i, count(*) over (partition by rid, w[i], w[i+1], w[i+2]) c from tri),
cov as (select rid, count(distinct i + k) n_repeat_words from twice, (values (0), (1), (2)) o(k) where c > 1 group by rid),
s as (select doc_id, len(w) n_words, cast(list_sum(list_transform(w, lambda x: length(x))) as bigint) word_chars,
        length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) n_symbols, len(ls) n_lines,
        len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words,
        len(list_filter(w, lambda x: x in ({listed}))) n_stop
      from w left join cov using (rid)),
r as (select *, n_repeat_words * 100 / nullif(n_words, 0) repeat_percent, word_chars / nullif(n_words, 0) mean_word_chars,
        n_symbols / nullif(n_words, 0) symbol_ratio, n_stop / nullif(n_words, 0) stop_ratio,
        n_dup_lines / nullif(n_lines, 0) dup_line_ratio, n_words / nullif(n_lines, 0) words_per_line from s),
f as (select *, concat_ws(',', {names}) failed from r)
select doc_id, cast(n_words as bigint) n_words, coalesce(word_chars, 0) word_chars, cast(n_symbols as bigint) n_symbols,
  cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, failed = '' kept, failed
from f"""


def secret_scan() -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(SECRET_RULES):
        parts.append(f"""select rid, {i} ord, {lit(r.kind)} kind, {r.least} least,
  regexp_extract_all(t, {lit(r.regex)}, 0) m, regexp_extract_all(t, {lit(r.regex)}, {r.group}) g,
  regexp_split_to_array(t, {lit(r.regex)}) p from d where regexp_matches(t, {lit(_cheap(r))})""")
    base = ", ".join(lit(r.kind) for r in SECRET_BASE)
    counts = ", ".join(f"cast(count(*) filter (where kind = {lit(r.kind)}) as bigint) n_{r.kind}" for r in SECRET_BASE)
    return rf"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
x as ({' union all '.join(parts)}),
y as (select rid, ord, kind, least, unnest(range(1, len(m) + 1)) i, m, g, p from x),
z as (select rid, ord, kind, length(g[i]) >= least good, length(m[i]) len,
        sum(length(p[i])) over u + coalesce(sum(length(m[i])) over (partition by rid, ord order by i rows between unbounded preceding and 1 preceding), 0) b
      from y window u as (partition by rid, ord order by i)),
s as (select rid, ord, kind, cast(b as bigint) b, concat(kind, ':', cast(b as bigint), ':', cast(b + len as bigint)) txt from z where good)
select doc_id, {counts},
  sha256(coalesce(string_agg(txt, ',' order by b, ord) filter (where kind in ({base})), '')) base_sha256,
  coalesce(string_agg(txt, ',' order by b, ord), '') spans
from d left join s using (rid) group by rid, doc_id"""


def warc(pages: str = "pages") -> str:
    """Digest, revisit decision and global order of captures, from the table alone."""
    bits = "list_reduce([cast(instr('0123456789abcdef', substr(h, 10*g + k, 1)) - 1 as bigint) for k in range(1, 11)], lambda x, y: x * 16 + y)"
    letters = ("array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(("
               f"({bits}) >> (35 - 5*i)) & 31 as int), 1) for i in range(0, 8)], '')")
    return rf"""
with p as (select row_number() over () rid, page_id, lower(coalesce(url, '')) u, coalesce(html, '') t from {pages}),
q as (select rid, page_id, t, sha1(encode(t)) h, octet_length(encode(t)) payload_bytes,
        min(page_id) over (partition by t) low,
        regexp_replace(u, '^[a-z][a-z0-9+.-]*://|#.*$', '', 'g') bare from p),
k as (select *, regexp_replace(regexp_extract(bare, '^([^/?]*)', 1), '^[^@]*@|:[0-9]*$', '', 'g') host from q),
r as (select *, case when bare = '' then '' else concat(array_to_string(list_reverse(string_split(host, '.')), ','), ')',
        regexp_replace(bare, '^[^/?]*', '')) end url_key,
        strftime(timestamp '2024-01-01' + to_seconds(coalesce(page_id, 0)), '%Y-%m-%dT%H:%M:%SZ') captured from k)
select page_id, cast(payload_bytes as bigint) payload_bytes,
  array_to_string([{letters} for g in range(0, 4)], '') payload_digest,
  case when page_id > low then 'revisit' else 'response' end record_type,
  case when page_id > low then low end refers_to, url_key, captured,
  row_number() over (order by url_key, captured, page_id) history_pos
from r"""


def url_filter(pages: str = "pages", labels: str = "labels") -> str:
    """Rules and host reputations, level by level."""
    from playtrail.llm.url_reputation import LOWER, MAX_BAD, RULES, STRENGTH, TWO_LABEL_SUFFIXES, UPPER, Z
    ruled = sorted(RULES, key=lambda r: -len(r.name))
    fit = {r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in ruled}
    case = {v: "case " + " ".join(f"when {fit[r]} then '{getattr(r, v)}'" for r in ruled) + " end" for v in ("name", "verdict")}
    low, high = STRENGTH
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)

    def strength(src, m):
        var = f"({m} * (1 - {m}))"
        return (f"(select coalesce(least({high}, greatest({low}, case when rho <= 1 / ({high} + 1) then {high} else 1 / rho - 1 end)), {high}) k "
                f"from (select sum(pow(bad - n * {m}, 2.0) - n * {var}) / nullif(sum(n * (n - 1) * {var}), 0.0) rho from {src}))")
    return rf"""
with u as (select row_number() over () rid, page_id, coalesce(url, '') u from {pages}),
r as (select rid, page_id, case when instr(u, '://') > 0 then substr(u, instr(u, '://') + 3) else '' end r from u),
p as (select rid, page_id, translate(regexp_extract(r, '\A[^/?#]*', 0), '{UPPER}', '{LOWER}') host,
        regexp_extract(r, '\A[^/?#]*([^?#]*)', 1) path from r),
j as (select *, {case['name']} "rule", {case['verdict']} ruled,
        regexp_replace(regexp_replace(host, '(?s)\A.*@', ''), ':[0-9]*\z', '') nm from p),
w as (select *, string_split(nm, '.') s from j),
d as (select *, array_to_string(s[-2:], '.') d2, array_to_string(s[-3:], '.') d3, regexp_matches(nm, '\A[0-9.]+\z') num from w),
k as (select *, case when num then nm when d2 in ({two}) then d3 else d2 end dom,
        case when num then '#' when d2 in ({two}) then d2 else s[-1] end suf from d),
m as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is not null or toxic is not null then 0 end) bad
      from {labels} group by doc_id),
h as (select nm, dom, suf, cast(count(bad) as bigint) n, cast(coalesce(sum(bad), 0) as bigint) bad
      from k left join m on page_id = doc_id group by all),
o as (select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) m0 from h),
s0 as (select suf, cast(sum(n) as bigint) n, cast(sum(bad) as bigint) bad, any_value(m0) m0 from h, o group by suf),
s1 as (select suf, (bad + k * m0) / (n + k) m1 from s0, {strength('s0', 'm0')}),
d0 as (select dom, suf, cast(sum(n) as bigint) n, cast(sum(bad) as bigint) bad, any_value(m1) m1 from h join s1 using (suf) group by dom, suf),
d1 as (select dom, suf, (bad + k * m1) / (n + k) m2 from d0, {strength('d0', 'm1')}),
h0 as (select h.*, m2 from h join d1 using (dom, suf)),
h1 as (select nm, n, (bad + k * m2) / (n + k) mean, k from h0, {strength('h0', 'm2')}),
h2 as (select *, mean - {Z} * sqrt(mean * (1 - mean) / (n + k + 1)) bound from h1)
select page_id, host, path, "rule", coalesce(ruled, case when bound > {MAX_BAD} then 'block' else 'allow' end) verdict,
  n host_labels, round(mean, 6) bad_share, round(bound, 6) bad_bound
from k join h2 using (nm)"""


def collocations(documents: str = "documents") -> str:
    """All phrases of one to four words, counted one by one."""
    from playtrail.llm.collocations import LEAST, SCALE, SUBSUMED, TOP, WORDS
    from playtrail.llm.url_reputation import LOWER, UPPER
    share, whole = SUBSUMED
    sizes = ", ".join(f"({m})" for m in range(1, WORDS + 1))
    return rf"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') t from {documents}),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) p from d),
w as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') w from p),
g as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) phrase
      from w, (values {sizes}) o(m)),
f as (select lang, m, phrase, count(*) f from g group by all),
n as (select lang, cast(sum(f) as bigint) n from f where m = 1 group by lang),
c as (select lang, m, phrase, f a, string_split(phrase, ' ') s from f where m > 1 and f >= {LEAST}),
x as (select lang, phrase, max(a) x from (
        select lang, array_to_string(s[:-2], ' ') phrase, a from c where m > 2 union all
        select lang, array_to_string(s[2:], ' '), a from c where m > 2) e group by all),
k as (select c.* from c left join x using (lang, phrase) where x is null or x::hugeint * {whole} < a::hugeint * {share}),
u as (select *, unnest(range(1, m)) k from k),
v as (select u.lang, u.phrase, a, k, fl.f l, fr.f r, cast({SCALE}::hugeint * a // (fl.f + fr.f) as bigint) score from u
      join f fl on fl.lang = u.lang and fl.phrase = array_to_string(s[:k], ' ')
      join f fr on fr.lang = u.lang and fr.phrase = array_to_string(s[k + 1:], ' ')),
b as (select * from v qualify row_number() over (partition by lang, phrase order by score, k) = 1),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) "rank" from b)
select lang, "rank", phrase, a, l, r, n, score from r join n using (lang) where "rank" <= {TOP}"""
