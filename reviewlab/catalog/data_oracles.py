"""What the queries on changing and arriving tables must return, as SQL for DuckDB."""

from __future__ import annotations

from reviewlab.operators.significance import thresholds

# The changes of customers, by rule, as the query makes them.
CHANGES = """
c as (select c_custkey as n, c_mktsegment as s, c_nationkey as k from customer),
changes(custkey, moment, ord, removed, segment, nation) as (
  select n, timestamp '1992-01-01', 1, false, s, k from c
  union all select n, timestamp '1992-01-01' + to_days((300 + n % 1500)::int), 2, false, s, (k + 1) % 25 from c where n % 2 = 0
  union all select n, timestamp '1992-01-01' + to_days((200 + n % 900)::int), 3, false, 'CORRECTED', k from c where n % 3 = 0
  union all select n, timestamp '1992-01-01' + to_days((300 + n % 1500)::int), 4, false, 'CORRECTED', (k + 2) % 25 from c where n % 5 = 0
  union all select n, timestamp '1992-01-01' + to_days((1000 + n % 1200)::int), 5, true, s, k from c where n % 7 = 0
  union all select n, timestamp '1992-01-01' + to_days((1400 + n % 1300)::int), 6, false, s, k from c where n % 14 = 0)
"""


def oracle_sql() -> dict[str, str]:
    times = " + ".join(f"(value >= {t})::int" for t in thresholds())
    return {
        "subject_access": r"""
with recursive said(tab, line, who, ends_here) as (
  select 'customer', c_custkey::varchar, 'customer:' || c_custkey, false from customer
  union select 'orders', o_orderkey::varchar, 'customer:' || o_custkey, false from orders
  union select 'orders', o_orderkey::varchar, 'order:' || o_orderkey, false from orders
  union select 'lineitem', l_orderkey || '/' || l_linenumber, 'order:' || l_orderkey, false from lineitem
  union select 'events', event_id::varchar, 'customer:' || user_id, false from events
  union select 'documents', doc_id::varchar, 'mail:' || lower(m), false
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) as m from documents)
  union select 'documents', doc_id::varchar, 'phone:' || regexp_replace(m, '[^0-9+]', '', 'g'), false
    from (select doc_id, unnest(regexp_extract_all(text, '\+[0-9][0-9 ()-]{7,}[0-9]')) as m from documents)),
linked as (select tab, line, who from said where (tab, line) in (select (tab, line) from said group by tab, line having count(*) > 1)),
edges as (
  select a.who as one, b.who as other, min(a.tab || ':' || a.line) as via
  from linked a join linked b on a.tab = b.tab and a.line = b.line and a.who <> b.who group by 1, 2),
walk(request, who, depth, path, seen) as (
  select distinct who, who, 0, who, [who] from said where who like 'customer:%' or who like 'mail:%'
  union all
  select request, other, depth + 1, path || ' > ' || via || ' > ' || other, list_append(seen, other)
  from walk join edges on one = who where not list_contains(seen, other)),
reached as (select request, who, arg_min(path, (depth, path)) as path, min(depth) as depth from walk group by 1, 2),
nearest as (
  select request, tab, line, min((depth, path || ' > ' || tab || ':' || line)) as n
  from said join reached using (who) group by 1, 2, 3)
select request, tab as "table", count(*) as row_count, min(n[1])::bigint as nearest, max(n[1])::bigint as furthest,
  min(n[2]) as first_path, max(n[2]) as last_path
from nearest group by 1, 2""",
        "erased_orders": """
with p as (
  select c_custkey as custkey, (c_acctbal < -900)::int as poor, (c_nationkey = 7 and c_mktsegment = 'BUILDING')::int as nation from customer),
o as (select o_custkey as custkey, count(*) as n, count(*) filter (o_orderkey % 10 = 0) as tenth from orders group by 1)
select custkey, case when poor + nation = 0 then coalesce(n, 0) else 0 end as kept,
  case when poor + nation = 0 then coalesce(tenth, 0) else 0 end as arrived,
  case when poor + nation > 0 then coalesce(n, 0) else 0 end as removed, (poor + nation)::bigint as runs
from p left join o using (custkey)""",
        "classifier_intervals": f"""
with j as (
  select doc_id as key, (quality = 1 - toxic)::int as a, (quality = (n_chars >= 300)::int)::int as b
  from documents join labels using (doc_id)),
d as (
  select a, b, r.i as replicate,
    ('0x' || substr(md5('11:' || (r.i // 4) || ':' || key), (r.i % 4 * 8 + 1)::int, 8))::bigint as value
  from j, range(200) r(i)),
t as (select a, b, replicate, {times} as times from d),
shares as (
  select replicate, sum(a * times) * 100 / sum(times) as polite, sum(b * times) * 100 / sum(times) as long,
    (sum(a * times) - sum(b * times)) * 100 / sum(times) as difference
  from t group by replicate having sum(times) > 0),
v as (unpivot shares on polite, long, difference into name measure value share),
lists as (select measure, list(share order by share) as v from v group by measure),
seen as (
  select count(*) as n, sum(a) * 100 / count(*) as polite, sum(b) * 100 / count(*) as long, (sum(a) - sum(b)) * 100 / count(*) as difference,
    count(*) filter (a > b) as x, count(*) filter (b > a) as y from j),
s as (unpivot seen on polite, long, difference into name measure value value)
select measure, round(value, 6) as value, round(v[1 + (len(v) * 5 // 200)], 6) as low, round(v[len(v) - (len(v) * 5 // 200)], 6) as high,
  case when measure = 'difference' then round(len(list_filter(v, lambda e: e * sign(value) <= 0)) / len(v), 6) end as opposite,
  case when measure = 'difference' and x + y > 0 then round(greatest(abs(x - y) - 1, 0) * greatest(abs(x - y) - 1, 0) / (x + y), 6) end as mcnemar,
  n as row_count
from s join lists using (measure)""",
        "tokenised_orders": """
with recursive k(name, secret) as (select n, sha256(n) from (values ('first key'), ('second key')) v(n)),
walk(custkey, name, secret, i, a, b) as (
  select c_custkey, name, secret, 0, substr(lpad(c_custkey::varchar, 9, '0'), 1, 4)::bigint, substr(lpad(c_custkey::varchar, 9, '0'), 5, 5)::bigint
  from customer, k
  union all
  select custkey, name, secret, i + 1,
    case when i % 2 = 0 then (a + ('0x' || substr(sha256(concat_ws(':', secret, i, 9, b)), 1, 14))::bigint) % 10000 else a end,
    case when i % 2 = 1 then (b + ('0x' || substr(sha256(concat_ws(':', secret, i, 9, a)), 1, 14))::bigint) % 100000 else b end
  from walk where i < 10),
ends as (select custkey, name, 'C-' || lpad(a::varchar, 4, '0') || lpad(b::varchar, 5, '0') as token from walk where i = 10),
counted as (select o_custkey, count(*) as n from orders group by o_custkey)
select f.token, coalesce(n, 0)::bigint as row_count, 'C-' || lpad(f.custkey::varchar, 9, '0') as customer, s.token as rotated
from ends f join ends s on f.custkey = s.custkey and f.name = 'first key' and s.name = 'second key'
left join counted on o_custkey = f.custkey""",
        "quality_rules": """
with found(rule, checked, failed) as (
  select 'orders.key', count(*), coalesce(sum(case when n > 1 then 1 end), 0)
  from (select count(*) over (partition by o_orderkey) as n from orders where o_orderkey is not null)
  union all select 'orders.customer_day', count(*), coalesce(sum(case when n > 1 then 1 end), 0)
  from (select count(*) over (partition by o_custkey, o_orderdate) as n from orders where o_custkey is not null and o_orderdate is not null)
  union all select 'orders.customer', count(*), count(*) filter (o_custkey not in (select c_custkey from customer)) from orders where o_custkey is not null
  union all select 'orders.price', count(*), count(*) filter (o_totalprice not between 1000 and 400000) from orders
  union all select 'orders.status', count(*), count(*) filter (o_orderstatus is null or o_orderstatus not in ('O', 'F')) from orders
  union all select 'orders.urgent', count(*), case when count(*) filter (o_orderpriority = '1-URGENT') >= 0.15 * count(*) then 0
    else count(*) - count(*) filter (o_orderpriority = '1-URGENT') end from orders
  union all select 'orders.fresh', count(*), case when max(o_orderdate) >= timestamp '2024-01-01' then 0 else 1 end from orders
  union all select 'lines.key', count(*), coalesce(sum(case when n > 1 then 1 end), 0)
  from (select count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem where l_orderkey is not null and l_linenumber is not null)
  union all select 'lines.order', count(*), count(*) filter (l_orderkey not in (select o_orderkey from orders)) from lineitem where l_orderkey is not null
  union all select 'lines.quantity', count(*), count(*) filter (l_quantity not between 1 and 45) from lineitem
  union all select 'lines.price', count(*), count(*) filter (not coalesce(l_extendedprice * (1 - l_discount) > 1500, false)) from lineitem
  union all select 'events.user', count(*), count(*) filter (user_id is null) from events
  union all select 'events.customer', count(*), count(*) filter (user_id not in (select c_custkey from customer)) from events where user_id is not null
  union all select 'events.type', count(*), count(*) filter (event_type is null or event_type = 'error') from events
  union all select 'events.small', count(*), case when count(*) filter (value < 20) >= 0.5 * count(*) then 0
    else count(*) - count(*) filter (value < 20) end from events)
select rule, checked::bigint as checked, failed::bigint as failed, failed = 0 as passed from found""",
        "quarantined_lines": """
select l_orderkey as orderkey, broken, count(*) as row_count
from (select l_orderkey, concat_ws(',', case when l_quantity not between 1 and 45 then 'lines.quantity' end,
        case when not coalesce(l_extendedprice * (1 - l_discount) > 1500, false) then 'lines.price' end) as broken from lineitem)
where broken <> '' group by all""",
        "evolved_events": """
select event_id as event, user_id as user, event_type as kind,
  case when event_id % 4 < 2 then floor(value)::int::double else value end as amount,
  case event_id % 4 when 0 then null when 2 then date_trunc('day', ts)::timestamp else ts::timestamp end as at,
  case event_id % 4 when 2 then event_id::varchar when 3 then props end as note
from events""",
        "schema_conflicts": """
select 'note' as "column", case event_id % 4 when 2 then 'bigint' else 'string' end as type, count(*) as row_count
from events where event_id % 4 >= 2 group by all""",
        "recoded_events": """
with recursive mapping(version, old, new, weight) as (values
  (1, 'click', 'tap', 1.0), (2, 'tap', 'press', 0.75), (2, 'tap', 'swipe', 0.25), (2, 'view', 'look', 1.0),
  (3, 'swipe', 'press', 0.5), (3, 'swipe', 'drag', 0.5), (3, 'error', 'fault', 1.0)),
walk as (
  select distinct event_id % 4 + 1 as list, event_type as code, event_id % 4 + 1 as step, event_type as now, 1.0::double as share from events
  union all
  select list, code, step + 1, coalesce(new, now), share * coalesce(weight, 1)
  from walk left join mapping on version = step and old = now where step < 4),
ends as (select list, code, now, sum(share) as share from walk where step = 4 group by all)
select ts::date as day, now as code, count(*) as row_count, round(sum(share), 4) as weight
from events join ends on list = event_id % 4 + 1 and code = event_type group by all""",
        "customer_history": f"""
with {CHANGES},
told as (select * from changes qualify row_number() over (partition by custkey, moment order by ord desc) = 1),
state as (select *, case when removed then null else segment || '/' || nation end as v from told),
turned as (select * from state
  qualify v is distinct from lag(v) over (partition by custkey order by moment)
    or row_number() over (partition by custkey order by moment) = 1 and v is not null),
closed as (select *, lead(moment) over (partition by custkey order by moment) as valid_to from turned)
select custkey, moment as valid_from, valid_to, segment, nation::int as nation from closed where v is not null""",
        "orders_as_of": f"""
with {CHANGES},
last as (
  select o_orderkey, arg_max({{'r': removed, 's': segment, 'n': nation}}, {{'a': moment, 'o': ord}}) as x
  from orders join changes on custkey = o_custkey and moment <= o_orderdate group by o_orderkey)
select o.o_orderkey, case when not x.r then x.s end as segment, (case when not x.r then x.n end)::int as nation
from orders o left join last using (o_orderkey)""",
        "reconcile_lines": """
with recursive lines as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), l_quantity::int) as id,
    l_orderkey as n, l_partkey as part, l_shipdate::date as day, max(l_extendedprice) as amount
  from lineitem group by all),
theirs as (
  select id, part, day + (n % 4)::int as day, floor(amount / 100) * 100.0 as amount from lines where n % 11 <> 0
  union all select id || '-again', part, day + 1, amount from lines where n % 13 = 0),
pairs as (
  select a.id as l, b.id as r, (b.day - a.day)::int as dg, b.amount - a.amount as ag,
    round(abs(b.day - a.day) / 4.0 + case when greatest(abs(a.amount), abs(b.amount)) > 0 then
      abs(b.amount - a.amount) / (greatest(abs(a.amount), abs(b.amount)) * 0.02) else 0 end, 9) as d
  from lines a join theirs b on a.part = b.part and abs(b.day - a.day) <= 3
    and abs(b.amount - a.amount) <= greatest(abs(a.amount), abs(b.amount)) * 0.02),
rounds as (
  select l, r, dg, ag, d, false as chosen, false as taken from pairs
  union all
  select l, r, dg, ag, d, chosen,
    bool_or(chosen) over (partition by l) or bool_or(chosen) over (partition by r) as taken
  from (select l, r, dg, ag, d,
          row_number() over (partition by l order by d, l, r) = 1
            and row_number() over (partition by r order by d, l, r) = 1 as chosen
        from rounds where not chosen and not taken)),
matched as (select * from rounds where chosen)
select l as left_id, r as right_id, case when dg = 0 and ag = 0 then 'exact' else 'within' end as status,
  dg as day_gap, round(ag, 2) as amount_gap, round(d, 6) as residual from matched
union all select id, null, 'left_only', null, null, null from lines where id not in (select l from matched)
union all select null, id, 'right_only', null, null, null from theirs where id not in (select r from matched)""",
        "layered_orders": """
with o as (select o_orderkey as n, o_custkey as custkey, o_orderstatus as status, round(o_totalprice * 100)::bigint as cents from orders),
now as (
  select custkey, status, case when n % 5 = 0 then cents + n else cents end as cents from o where n % 7 <> 3
  union all select custkey, status, cents from o where n % 11 = 1)
select case when custkey % 9 = 0 then 'MOVED' else c_mktsegment end as segment, status, count(*) as row_count,
  sum(cents)::bigint as total, min(cents) as least, max(cents) as largest
from now join customer on c_custkey = custkey group by all""",
        "stream_scores": """
select doc_id as review_id, 1::bigint as stored, true as same_score from documents where doc_id is not null""",
        "stream_windows": """
select date_trunc('day', ts) as window_start, event_type, count(*) as row_count,
  sum(value::decimal(18, 4))::double as total
from events where ts is not null group by all""",
    }
