"""SQL counterparts of the operators that SQL can express."""
from oppflow.llm.host_rules import MAX_STRENGTH, MIN_STRENGTH, HostLimits
from oppflow.llm.url_filter import SOFT_TERMS, STRICT_TERMS, Vocabulary

_TERMS = ", ".join([f"{{'t': '{t}', 's': true, 'w': 0.0::double}}" for t in STRICT_TERMS] +
                   [f"{{'t': '{t}', 's': false, 'w': {w}::double}}" for t, w in SOFT_TERMS.items()])
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_V = Vocabulary()

URL_FILTER_SQL = rf"""
with parts as (
  select page_id, {_LOWER.format("coalesce(url, '')")} as u,
         {_LOWER.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
found as (
  select page_id, host, path, '.' || host as h,
         list_filter([{_TERMS}], lambda x: regexp_matches(u, '(^|[^a-z0-9])' || x.t || '($|[^a-z0-9])')) as hits
  from parts),
ruled as (
  select page_id, host, path, len(list_filter(hits, lambda x: x.s)) as n_strict, len(list_filter(hits, lambda x: not x.s)) as n_soft,
         round(coalesce(list_sum(list_transform(list_filter(hits, lambda x: not x.s), lambda x: x.w)), 0), 6) as soft_weight,
         case when ends_with(h, '.example.com') and starts_with(path, '/de/') then 'example.com/de/'
              when ends_with(h, '.example.net') and starts_with(path, '/en/') then 'example.net/en/'
              when ends_with(h, '.org') and starts_with(path, '/fr/') then 'org/fr/'
              when ends_with(h, '.net') and starts_with(path, '/') then 'net/' end as rule
  from found)
select page_id, host, path, rule,
       case when rule in ('example.com/de/', 'net/') then 'block' when rule is not null then 'allow'
            when n_strict > 0 or (n_soft >= {_V.min_soft} and soft_weight >= {_V.min_weight}) then 'block' else 'allow' end as verdict,
       n_strict, n_soft, soft_weight
from ruled"""

_RULES = {
    "few_words": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_words > 0 and 10 * n_dup_lines > n_words", "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
_STRENGTH = "greatest(least(m_{r} * (1 - m_{r}) / greatest(v_{r} - m_{r} * (1 - m_{r}) * inverse, 1e-9) - 1, " + f"{MAX_STRENGTH}), {MIN_STRENGTH})"
_RATE = "({r} + m_{r} * " + _STRENGTH + ") / (n + " + _STRENGTH + ")"
_BAD = " or ".join(f"{_RATE.format(r=r)} > {limit}" for r, limit in HostLimits().limits.items())

HOST_RULES_SQL = rf"""
with texts as (
  select row_number() over () as rid, doc_id, source as host, coalesce(text, '') as t from documents),
split as (
  select rid, doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from texts),
windows as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
  from (select rid, words, unnest(generate_series(1, len(words) - 2)) as i from split)),
again as (
  select rid, i from (select rid, i, count(*) over (partition by rid, w) as c from windows) where c > 1),
covered as (
  select rid, count(distinct i + d) as n from again, (values (0), (1), (2)) as x(d) group by rid),
measured as (
  select split.rid, doc_id, host, len(words) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from split left join covered on split.rid = covered.rid),
hosts as (
  select host, count(*) as n, {", ".join(f"count(*) filter ({c}) as {r}" for r, c in _RULES.items())}
  from measured where host is not null group by host),
moments as (
  select avg(1 / n) as inverse, {", ".join(f"avg({r} / n) as m_{r}, var_pop({r} / n) as v_{r}" for r in _RULES)} from hosts),
verdicts as (
  select host, {_BAD} as host_rejected from hosts, moments)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES["few_words"]} or {_RULES["repeats"]}) as base_failed,
       not ({_RULES["few_words"]} or {_RULES["repeats"]}) and not coalesce(host_rejected, false) as kept,
       coalesce(host_rejected, false) as host_rejected
from measured left join verdicts on measured.host = verdicts.host"""
