"""The registered queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from gaceta.llm.decontaminate import LeakParams
from gaceta.llm.divergence import AuditParams
from gaceta.llm.host_rules import SYMBOLS, WINDOW, HostRuleParams
from gaceta.llm.mixing import PART_MEAN, MixParams
from gaceta.llm.shrinkage import moments_sql
from gaceta.llm.url_reputation import ALLOW, BLOCK, ReputationParams
from gaceta.llm.vector_codes import CodeParams


def _rules_sql(column: int, params: ReputationParams) -> str:
    """A CASE over the rules, longest first; column 0: the rule, 1: its verdict."""
    cases = "".join(
        f" when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{start}')"
        f" then '{(host + start, kind)[column]}'"
        for kind, host, start in sorted(
            params.rules, key=lambda r: (len(r[1] + r[2]), r), reverse=True))
    return f"case{cases} end" if cases else "cast(null as varchar)"


def op2_url_filters(params: ReputationParams = ReputationParams()) -> str:
    two = ", ".join(f"'{s}'" for s in params.two_label_suffixes)
    tail = lambda n: f"array_to_string(string_split(bare, '.')[-{n}:], '.')"
    return f"""
with urls as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
outcomes as (
  select doc_id, max(cast(quality = 0 as int)) as bad from labels
  where doc_id is not null and quality is not null group by doc_id),
counted as (
  select host, regexp_replace(host, ':[0-9]*$', '') as bare, count(bad) as n,
    count(*) filter (bad = 1) as k
  from urls left join outcomes on doc_id = page_id group by host),
hosts as (
  select host, n, k,
    case when address then '' when two then {tail(2)} else {tail(1)} end as suffix,
    case when address then bare when two then {tail(3)} else {tail(2)} end as domain
  from (select *, regexp_matches(bare, '^[0-9]+([.][0-9]+){{3}}$') or starts_with(bare, '[')
          as address, {tail(2)} in ({two}) as two from counted)),
suffixes as (select suffix, sum(n) as ns, sum(k) as ks from hosts group by suffix),
domains as (
  select suffix, domain, sum(n) as nd, sum(k) as kd from hosts group by suffix, domain),
suffix_prior as ({moments_sql("suffixes", "ns", "ks", "s_")}),
domain_prior as ({moments_sql("domains", "nd", "kd", "d_")}),
host_prior as ({moments_sql("hosts", "n", "k")}),
rated as (
  select *, (s_mean * s_strength + ks - kd) / (s_strength + ns - nd) as suffix_rate
  from hosts join domains using (suffix, domain) join suffixes using (suffix), suffix_prior),
posterior as (
  select host, n, strength,
    ((suffix_rate * d_strength + kd - k) / (d_strength + nd - n) * strength + k) / (strength + n) as m
  from rated, domain_prior, host_prior),
bounds as (
  select host, m - {params.z} * sqrt(m * (1 - m) / (strength + n + 1)) as bound from posterior)
select page_id, host, path, {_rules_sql(0, params)} as rule,
  coalesce({_rules_sql(1, params)},
    case when bound > {params.max_bad_rate} then '{BLOCK}' else '{ALLOW}' end) as verdict,
  round(bound, 6) as bad_bound
from urls join bounds using (host)"""


def op7_exact_dedup() -> str:
    return """
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from texts window w as (partition by t)"""


def op9_mix_sources(params: MixParams = MixParams()) -> str:
    return f"""
with recursive sizes as (
  select coalesce(source, '{params.unnamed}') as name, count(*) as n from documents group by 1),
rates as (
  select name, power(n, {params.exponent}) / sum(power(n, {params.exponent})) over ()
    * {params.epochs} * sum(n) over () / n as rate
  from sizes),
parts as (
  select name, part, parts, rate / parts as mean
  from (select *, greatest(1, cast(ceil(rate / {PART_MEAN}) as int)) as parts from rates),
    range(1, 100000) t(part)
  where part <= parts),
terms(name, mean, k, p, c) as (
  select distinct name, mean, 0, exp(-mean), exp(-mean) from parts
  union all
  select name, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1)
  from terms where k < cast(ceil(mean + 12 * sqrt(mean) + 25) as int)),
tables as (select name, list(c order by k) as cdf from terms group by name),
draws as (
  select d.doc_id, name, part,
    cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || part || '|{params.seed}'),
      1, 13)) as bigint) / power(2.0, 52) as u
  from (select distinct doc_id, coalesce(source, '{params.unnamed}') as name from documents) d
    join parts using (name)),
counts as (
  select doc_id, name, sum(len(list_filter(cdf, lambda x: x <= u))) as n
  from draws join tables using (name) group by doc_id, name)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, cast(copy as int) as copy
from documents d
  join counts c on c.doc_id is not distinct from d.doc_id
    and c.name = coalesce(d.source, '{params.unnamed}'),
  lateral (select unnest(range(1, cast(n as bigint) + 1)) as copy)"""


def op10_host_rules(params: HostRuleParams = HostRuleParams()) -> str:
    window = " || ' ' || ".join(f"w[i + {j}]" for j in range(WINDOW))
    return f"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(source, '') as host,
    coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
windows as (
  select r, i, {window} as s
  from (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from texts
        where len(w) >= {WINDOW})),
repeated as (
  select r, i from windows
  qualify count(*) over (partition by r, s) > 1),
covered as (
  select r, count(distinct i + j) as n from repeated, range({WINDOW}) x(j) group by r),
rules as (
  select doc_id, host, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words
  from texts left join covered using (r)),
judged as (
  select *, n_words < {params.min_words}
    or 100 * n_repeat_words > {params.max_repeat_percent} * n_words as base_failed
  from rules),
hosts as (
  select host, count(*) as n, count(*) filter (base_failed) as k from judged group by host),
prior as ({moments_sql("hosts", "n", "k")}),
posterior as (
  select host, n, strength, (mean * strength + k) / (strength + n) as m from hosts, prior),
bounds as (
  select host, m - {params.z} * sqrt(m * (1 - m) / (strength + n + 1)) as bound from posterior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and bound <= {params.max_host_rate} as kept, round(bound, 6) as host_rate_bound
from judged join bounds using (host)"""


def _lowered_words(pattern: str) -> str:
    return (f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '{pattern}')")


def op11_decontaminate(params: LeakParams = LeakParams()) -> str:
    words = _lowered_words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return f"""
with docs as (select row_number() over () as r, doc_id, {words} as w from documents),
items as (
  select distinct coalesce(cast(item_id as varchar), '') as item, {words} as w from benchmark),
phrases as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as s from (
    select item, w, least({params.words}, len(w)) as n,
      unnest(range(1, len(w) - least({params.words}, len(w)) + 2)) as i
    from items where len(w) > 0)),
places as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as s from (
    select r, w, n, unnest(range(1, len(w) - n + 2)) as i
    from docs, (select distinct n from phrases) where len(w) >= n)),
found as (select r, n, i, item from places join phrases using (n, s)),
hits as (
  select r, count(distinct i + j) as n_hit
  from (select distinct r, n, i from found), range({params.words}) x(j) where j < n group by r),
named as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as list
  from found group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(list, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (r) left join named using (r)"""


def op12_divergence(params: AuditParams = AuditParams()) -> str:
    words = _lowered_words(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    share = lambda n, total: f"1 + (cast({params.scale} as hugeint) * ({n} + 1)) // ({total} + v)"
    apart = lambda p, q: f"(({p} - {q}) * ({p} - {q})) // {q}"
    return f"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    {words} as w
  from documents),
counts as (
  select lang, source, term, count(*) as n, count(distinct r) as d
  from (select r, lang, source, unnest(w) as term from docs) group by all),
kept as (
  select lang, term, sum(n) as n from counts group by all having sum(d) >= {params.min_docs}),
groups as (
  select g.lang, g.source, coalesce(v, 0) as v, coalesce(lang_total, 0) as lang_total,
    coalesce(total, 0) as total
  from (select distinct lang, source from docs) g
    left join (select lang, count(*) as v, sum(n) as lang_total from kept group by 1) using (lang)
    left join (select c.lang, source, sum(c.n) as total
               from counts c join kept using (lang, term) group by all) using (lang, source)),
shares as (
  select g.lang, g.source, term, coalesce(c.n, 0) as n, {share("coalesce(c.n, 0)", "total")} as p,
    {share("k.n", "lang_total")} as q
  from groups g join kept k using (lang) left join counts c using (lang, source, term)),
pairs as (
  select lang, a.source as source, b.source as item, sum({apart("a.p", "b.p")}) as value
  from shares a join shares b using (lang, term) where a.source <> b.source group by all),
listed as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, {apart("p", "q")} from shares where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (select *, row_number() over (
        partition by lang, source, part order by value desc, item) as rank from listed)
where part = 'pair' or rank <= {params.top}"""


def op13_vector_codes(params: CodeParams = CodeParams()) -> str:
    near = lambda book: f"""
  select r, part, min(struct_pack(dist := dist, entry := entry)) as best from (
    select r, part, entry, list_sum(list_transform(list_zip(q, b),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist
    from cut join {book} using (part)) group by all"""
    rounds = "".join(f"""
near{i} as ({near(f"book{i}")}),
means{i} as (
  select part, entry, list((s - ((s % n) + n) % n) // n order by pos) as m from (
    select part, best.entry as entry, pos, sum(x) as s, count(*) as n
    from (select part, r, unnest(q) as x, generate_subscripts(q, 1) as pos from cut) join near{i} using (part, r)
    group by all) group by all),
book{i + 1} as (
  select part, entry, coalesce(m, b) as b from book{i} left join means{i} using (part, entry)),"""
                     for i in range(params.rounds))
    return f"""
with whole as (
  select row_number() over () as r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(cast(x as double) * {params.units}) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as (
  select r, vec_id, part, v[part * len(v) // {params.parts} + 1:(part + 1) * len(v) // {params.parts}] as q
  from whole, range({params.parts}) p(part)),
book0 as (
  select part, cast(e as bigint) as entry, q as b from (
    select part, q, row_number() over (partition by part order by vec_id) - 1 as e from cut)
  where e < {params.entries}),{rounds}
final as ({near(f"book{params.rounds}")}),
coded as (
  select r, string_agg(lower(printf('%02x', best.entry)), '' order by part) as code,
    cast(sum(best.dist) as bigint) as error
  from final group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(b, ','), ',' order by part, entry))
   from book{params.rounds}) as codebooks_sha256
from whole join coded using (r)"""


def oracle_sql() -> dict[str, str]:
    return {f.__name__: f() for f in (
        op2_url_filters, op7_exact_dedup, op9_mix_sources, op10_host_rules, op11_decontaminate,
        op12_divergence, op13_vector_codes)}
