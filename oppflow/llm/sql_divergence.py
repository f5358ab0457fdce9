"""SQL counterpart of the source divergence audit, dense over all kept terms."""

SOURCE_DIVERGENCE_SQL = r"""
with docs as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
words as (
  select rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (
  select lang, term, count(*) as total from words group by lang, term having count(distinct rid) >= 10),
langs as (
  select l.lang, count(term) as v, coalesce(sum(total), 0) as n
  from (select distinct lang from docs) as l left join kept on l.lang = kept.lang group by l.lang),
counted as (
  select w.lang, w.source, w.term, count(*) as c
  from words as w join kept as k on w.lang = k.lang and w.term = k.term group by w.lang, w.source, w.term),
masses as (
  select g.lang, g.source, any_value(v) as v, coalesce(sum(c), 0) + 2 * any_value(v) as mass, any_value(n) + 2 * any_value(v) as lang_mass
  from (select distinct lang, source from docs) as g join langs on g.lang = langs.lang
  left join counted as c on g.lang = c.lang and g.source = c.source group by g.lang, g.source),
dense as (
  select m.lang, m.source, k.term, coalesce(c, 0) as c,
         1 + (1000000000::hugeint * (coalesce(c, 0) + 2)::hugeint) // mass::hugeint as p,
         1 + (1000000000::hugeint * (total + 2)::hugeint) // lang_mass::hugeint as q
  from masses as m join kept as k on m.lang = k.lang
  left join counted as c on c.lang = m.lang and c.source = m.source and c.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from dense as a join dense as b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source),
every_pair as (
  select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
  from masses as a join masses as b on a.lang = b.lang and a.source <> b.source
  left join pairs as p on p.lang = a.lang and p.source = a.source and p.item = b.source),
terms as (
  select lang, source, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value from dense where c > 0 and p > q),
ranked as (
  select lang, source, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from terms)
select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank
from every_pair
union all
select lang, source, 'term' as part, item, value, rank::int as rank from ranked where rank <= 10"""
