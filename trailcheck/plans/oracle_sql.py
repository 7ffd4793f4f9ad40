"""Independent DuckDB formulations of every registered query.

The driver registers the raw parquet tables as views; the audit-shaped
fixtures (FIXTURES.md) are inlined here as CTEs.  Each oracle is written the
plain way — correlated subqueries, ``row_number`` ranks, recursive walks —
so it checks the distributed Spark plans rather than repeating them.
"""

from __future__ import annotations

from trailcheck.contracts import PERCENTILES, SEQUENCE_BUCKETS, USER_METRICS

# ---------------------------------------------------------------- fixtures
_FIX = {
    "log": "select epoch_us(ts)//1000 as timestamp, user_id as visitorid, case event_type when 'click' then 'addtocart' "
           "when 'purchase' then 'transaction' else event_type end as event, "
           "cast(json_extract_string(props,'$.k') as bigint) as itemid, "
           "case when event_type='purchase' then cast(event_id as varchar) end as transactionid from events",
    "pair_log": "select timestamp, visitorid*1000+itemid as visitorid, event, itemid, transactionid from log",
    "log_items": "select timestamp, visitorid, event, itemid*37 as itemid from log",
    "order_log": "select epoch_us(o_orderdate)//1000 as timestamp, o_custkey as visitorid, case o_orderstatus "
                 "when 'P' then 'view' when 'O' then 'addtocart' else 'transaction' end as event, "
                 "o_orderkey%1000 as itemid from orders",
    "star_log": "select epoch_us(l_shipdate)//1000 as timestamp, o_custkey as visitorid, case l_returnflag "
                "when 'N' then 'view' when 'A' then 'addtocart' else 'transaction' end as event, "
                "l_partkey%400 as itemid from lineitem join orders on l_orderkey=o_orderkey",
    "tie_log": "select timestamp, visitorid%50 as visitorid, event, itemid%20 as itemid from star_log",
    "props": "select case when l_linenumber=6 and l_suppkey%10=0 then null else ts0 end as timestamp, "
             "case when l_linenumber=7 and l_suppkey%10=0 then null else l_partkey end as itemid, property, "
             "case when l_linenumber=7 and l_suppkey%10=0 then 'x'||cast(l_suppkey as varchar) else value end as value, "
             "case when l_linenumber<=3 then 'part1' else 'part2' end as _source_name from ("
             "select epoch_us(l_shipdate)//1000 as ts0, l_partkey, l_suppkey, l_linenumber, 'available' as property, "
             "case l_linestatus when 'O' then '1' else '0' end as value from lineitem where true union all "
             "select epoch_us(l_shipdate)//1000 as ts0, l_partkey, l_suppkey, l_linenumber, '790' as property, "
             "cast(cast(round(l_discount*100) as int) as varchar) as value from lineitem where true union all "
             "select epoch_us(l_shipdate)//1000 as ts0, l_partkey, l_suppkey, l_linenumber, 'categoryid' as property, "
             "case when l_partkey%10<8 then cast(l_partkey%50 as varchar) end as value from lineitem "
             "where l_partkey%7<>0) t",
    "raw_ids": "select cast(page_id as varchar) as row_key, nullif(regexp_extract(url,'/([^/]*)$',1),'') as raw_value "
               "from pages",
    "tree_func": "select p_partkey as categoryid, case when p_partkey%97=0 then null else (p_partkey*7+3)%2100 end "
                 "as parentid from part",
    "tree_heap": "select p_partkey as categoryid, case when p_partkey=0 then null else (p_partkey-1)//2 end "
                 "as parentid from part",
    "tree_lines": "select row_number() over () - 1 as row_number, l_partkey%2000 as categoryid, case when l_suppkey%13<>0 then "
                  "(l_partkey*7+l_linenumber)%2100 end as parentid from lineitem",
    "tree_first": "select categoryid, parentid from (select *, row_number() over (partition by categoryid order by row_number) as k "
                  "from tree_lines) where k=1",
}
_DEPS = {"pair_log": ["log"], "log_items": ["log"], "tie_log": ["star_log"], "tree_first": ["tree_lines"]}
_ORDER = ["log", "pair_log", "log_items", "order_log", "star_log", "tie_log", "props", "raw_ids",
          "tree_func", "tree_heap", "tree_lines", "tree_first"]


def with_fixtures(names: list[str], body: str, extra: list[tuple[str, str]] | None = None,
                  recursive: bool = False) -> str:
    """Prefix ``body`` with CTEs for the named fixtures (and dependencies)."""
    need: set[str] = set()

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    ctes = [f"{n} as ({_FIX[n]})" for n in _ORDER if n in need]
    ctes += [f"{n} as ({q})" for n, q in (extra or [])]
    return ("with recursive " if recursive else "with ") + ", ".join(ctes) + " " + body


VALID = "timestamp is not null and visitorid is not null and event is not null and itemid is not null"


def _dbl(expr: str) -> str:
    """Exact integer/decimal -> double, correctly rounded (via text)."""
    return f"cast(cast({expr} as varchar) as double)"


def _share(num: str, den: str) -> str:
    return f"case when ({den}) > 0 then cast({num} as double) / cast({den} as double) else 0.0::double end"


def distribution_sql(samples_cte: str, metrics: list[str]) -> list[tuple[str, str]]:
    """CTEs ending in ``dist``: the distribution summary of samples(metric, x).

    Exact per-row ranks via row_number; the same two-sided linear
    interpolation as the Spark side; std from exact integer sums.
    """
    cat = " union all ".join(f"select '{m}' as metric, {i} as ord" for i, m in enumerate(metrics))
    qs = " union all ".join(f"select '{n}' as pname, cast('{p}' as double) as p" for n, p in PERCENTILES)
    dec = "cast(x as decimal(38,0))"
    return [
        ("samples", samples_cte),
        ("cat", cat),
        ("qs", qs),
        ("mom", f"select metric, count(*) as n, sum({dec}) as s1, sum({dec}*{dec}) as s2, "
                f"min(x)::double as mn, max(x)::double as mx from samples group by metric"),
        ("ranked", "select metric, x, row_number() over (partition by metric order by x) - 1 as r from samples"),
        ("tgt", "select m.metric, q.pname, (m.n - 1)::double * q.p as h from mom m, qs q"),
        ("pick", "select t.metric, t.pname, t.h - floor(t.h) as t, "
                 "(select x from ranked r where r.metric = t.metric and r.r = floor(t.h))::double as a, "
                 "(select x from ranked r where r.metric = t.metric and r.r = ceil(t.h))::double as b from tgt t"),
        ("pv", "select metric, pname, case when t >= 0.5 then b - (b - a) * (1.0::double - t) "
               "else a + (b - a) * t end as v from pick"),
        ("dist", "select c.metric, coalesce(m.n, 0)::bigint as count, "
                 f"{_dbl('m.s1')} / m.n::double as mean, "
                 f"case when m.n > 1 then sqrt({_dbl('m.n * m.s2 - m.s1 * m.s1')} / "
                 f"{_dbl('cast(m.n as decimal(38,0)) * (m.n - 1)')}) end as std, m.mn as min, "
                 + ", ".join(f"(select v from pv where pv.metric = c.metric and pv.pname = '{n}') as \"{n}\""
                             for n, _ in PERCENTILES)
                 + ", m.mx as max from cat c left join mom m on m.metric = c.metric"),
    ]


def _prior_tx(src: str) -> str:
    return (f"select t.visitorid, t.itemid, t.timestamp, "
            f"(select max(p.timestamp) from {src} p where p.visitorid = t.visitorid and p.itemid = t.itemid "
            f"and p.event = 'view' and p.timestamp < t.timestamp) as lv, "
            f"(select max(p.timestamp) from {src} p where p.visitorid = t.visitorid and p.itemid = t.itemid "
            f"and p.event = 'addtocart' and p.timestamp < t.timestamp) as lc "
            f"from {src} t where t.event = 'transaction'")


def _prior_behavior(fixture: str) -> str:
    return with_fixtures([fixture], (
        "select count(*)::bigint as transaction_event_count, count(lv)::bigint as with_strictly_prior_view_count, "
        "count(lc)::bigint as with_strictly_prior_addtocart_count, "
        f"{_share('count(lv)', 'count(*)')} as with_strictly_prior_view_share, "
        f"{_share('count(lc)', 'count(*)')} as with_strictly_prior_addtocart_share from tx"),
        extra=[("v", f"select * from {fixture} where {VALID}"), ("tx", _prior_tx("v"))])


def _prior_intervals(fixture: str) -> str:
    samples = ("select 'most_recent_prior_view_interval_ms' as metric, timestamp - lv as x from tx where lv is not null "
               "union all select 'most_recent_prior_addtocart_interval_ms' as metric, timestamp - lc as x from tx "
               "where lc is not null")
    return with_fixtures([fixture], "select * from dist",
                         extra=[("v", f"select * from {fixture} where {VALID}"), ("tx", _prior_tx("v"))]
                         + distribution_sql(samples, ["most_recent_prior_view_interval_ms",
                                                      "most_recent_prior_addtocart_interval_ms"]))


_USERS = ("select visitorid, count(*)::bigint as total_behavior_length, count(distinct itemid)::bigint as "
          "distinct_item_count, count(distinct floor(timestamp / 86400000))::bigint as active_day_count, "
          "min(timestamp) as first_timestamp_ms, max(timestamp) as last_timestamp_ms, "
          "count(*) filter (where event = 'view') as view_length, "
          "count(*) filter (where event = 'transaction') as transaction_event_count, "
          "count(*) filter (where event = 'addtocart') as addtocart_event_count, "
          "max(timestamp) - min(timestamp) as lifecycle_ms from {src} where " + VALID + " group by visitorid")


def _bucket_case(col: str) -> str:
    parts = []
    for lo, hi, label in SEQUENCE_BUCKETS:
        cond = f"{col} >= {lo}" if hi is None else f"{col} between {lo} and {hi}"
        parts.append(f"when {cond} then '{label}'")
    return "case " + " ".join(parts) + " end"


def _length_buckets(fixture: str) -> str:
    cat = " union all ".join(f"select '{label}' as b" for _, _, label in SEQUENCE_BUCKETS)
    return with_fixtures([fixture], (
        "select cat.b as sequence_length_bucket, coalesce(g.uc, 0)::bigint as user_count, "
        f"{_share('coalesce(g.uc, 0)', 't.tu')} as user_share, coalesce(g.bc, 0)::bigint as behavior_count, "
        f"{_share('coalesce(g.bc, 0)', 't.te')} as behavior_contribution_share "
        "from cat left join g on g.b = cat.b, (select count(*) as tu, sum(len) as te from u) t"),
        extra=[("u", f"select visitorid, count(*) as len from {fixture} where {VALID} group by visitorid"),
               ("g", f"select {_bucket_case('len')} as b, count(*) as uc, sum(len) as bc from u group by 1"),
               ("cat", cat)])


_ITEMS = ("select itemid, count(*)::bigint as total_behavior_count, "
          "count(distinct floor(timestamp / 86400000))::bigint as active_day_count, "
          "min(timestamp) as first_timestamp_ms, max(timestamp) as last_timestamp_ms, "
          "count(*) filter (where event = 'view') as view_event_count, "
          "count(*) filter (where event = 'addtocart') as addtocart_event_count, "
          "count(*) filter (where event = 'transaction') as transaction_event_count "
          "from {src} where " + VALID + " group by itemid")


def _top_share(fixture: str) -> str:
    fr = " union all ".join(f"select cast('{p}' as double) as p" for p in (0.01, 0.05, 0.10, 0.20))
    return with_fixtures([fixture], (
        "select p as top_item_percentage, 'ceil; ties resolved by ascending itemid' as rounding_rule, "
        "topn as top_item_count, coalesce((select sum(c) from ranked where rk <= topn), 0)::bigint as behavior_count, "
        f"{_share('coalesce((select sum(c) from ranked where rk <= topn), 0)', 'nt.t')} as behavior_contribution_share, "
        "'top_contribution' as metric from (select p, case when n > 0 then greatest(1, ceil(n::double * p))::bigint "
        "else 0::bigint end as topn from fr, nt) s, nt"),
        extra=[("items", f"select itemid, count(*) as c from {fixture} where {VALID} group by itemid"),
               ("ranked", "select c, row_number() over (order by c desc, itemid asc) as rk from items"),
               ("nt", "select count(*) as n, sum(c) as t from items"), ("fr", fr)])


def _gini(fixture: str) -> str:
    return with_fixtures([fixture], (
        "select null::double as top_item_percentage, 'all event-observed items' as rounding_rule, "
        "n::bigint as top_item_count, t::bigint as behavior_count, "
        "case when n = 0 then null when t = 0 then 0.0::double else "
        f"2.0::double * {_dbl('s')} / (n::double * t::double) - (n::double + 1.0::double) / n::double end "
        "as behavior_contribution_share, 'gini_coefficient' as metric from "
        "(select count(*) as n, sum(c) as t, sum(cast(rk as decimal(38,0)) * c) as s from ranked) z"),
        extra=[("items", f"select itemid, count(*) as c from {fixture} where {VALID} group by itemid"),
               ("ranked", "select c, row_number() over (order by c asc, itemid asc) as rk from items")])


def _sequence_distribution(fixture: str) -> str:
    samples = " union all ".join(f"select '{m}' as metric, {m} as x from users" for m in USER_METRICS)
    return with_fixtures([fixture], "select * from dist",
                         extra=[("users", _USERS.format(src=fixture))] + distribution_sql(samples, list(USER_METRICS)))


def _behavior_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["prior_behavior"] = _prior_behavior("log")
    q["strict_prior_ties"] = _prior_behavior("tie_log")
    q["prior_intervals"] = _prior_intervals("log")
    q["prior_intervals_ties"] = _prior_intervals("tie_log")
    q["event_distribution"] = with_fixtures(["log"], (
        "select coalesce(event, '<missing>') as event, count(*)::bigint as event_count, "
        f"{_share('count(*)', '(select count(*) from log)')} as event_share, "
        "coalesce(event, '<missing>') in ('view', 'addtocart', 'transaction') as is_expected_event "
        "from log group by 1"))
    q["daily_trend"] = with_fixtures(["log"], (
        "select cast(date '1970-01-01' + cast(floor(timestamp / 86400000) as integer) as varchar) as date_utc, "
        "event, count(*)::bigint as event_count from log where timestamp is not null and event is not null "
        "group by 1, 2"))
    q["behavior_combinations"] = with_fixtures(["pair_log"], (
        f"select behavior_combination, count(*)::bigint as user_count, "
        f"{_share('count(*)', '(select count(*) from u)')} as user_share from u group by 1"),
        extra=[("u", "select visitorid, array_to_string(list_sort(list_distinct(list(event))), '|') "
                     "as behavior_combination from pair_log where visitorid is not null and event is not null "
                     "group by visitorid")])
    q["user_sequences"] = with_fixtures(["log"], _USERS.format(src="log"))
    q["sequence_distribution"] = _sequence_distribution("log")
    q["length_buckets"] = _length_buckets("order_log")
    q["length_buckets_star"] = _length_buckets("star_log")
    q["item_metrics"] = with_fixtures(["log"], _ITEMS.format(src="log"))
    fields = ", ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
                       for c in ("timestamp", "visitorid", "event", "itemid", "transactionid"))
    q["table_fingerprint"] = with_fixtures(["log"], (
        f"select 'events' as \"table\", count(*) as rows, cast(coalesce(sum(h), 0) as varchar) as hash_sum, "
        f"coalesce(bit_xor(h), 0) as hash_xor from (select cast('0x' || substr(md5(concat_ws(',', {fields})), 1, 8) as bigint) as h from log)"))
    q["top_share"] = _top_share("star_log")
    q["gini"] = _gini("star_log")
    return q


# ---------------------------------------------------------------- quality
def _parse(col: str) -> str:
    d = f"try_cast({col} as decimal(38,9))"
    return f"(case when {d} = floor({d}) then try_cast({d} as bigint) end)"


_TEXT = {
    "events": ("select cast(timestamp as varchar) as timestamp, cast(visitorid as varchar) as visitorid, event, "
               "cast(itemid as varchar) as itemid, transactionid from log", ["log"]),
    "props_text": ("select cast(timestamp as varchar) as timestamp, cast(itemid as varchar) as itemid, property, value, "
                   "case when _source_name = 'part1' then 'item_properties_part1' else 'item_properties_part2' end "
                   "as _source_name from props", ["props"]),
    "category_tree": ("select cast(categoryid as varchar) as categoryid, cast(parentid as varchar) as parentid "
                      "from tree_func", ["tree_func"]),
}

_SOURCES = [
    ("events", "events_t", ["timestamp", "visitorid", "event", "itemid", "transactionid"],
     ["timestamp", "visitorid", "itemid"], True),
    ("item_properties_part1", "p1_t", ["timestamp", "itemid", "property", "value"], ["timestamp", "itemid"], True),
    ("item_properties_part2", "p2_t", ["timestamp", "itemid", "property", "value"], ["timestamp", "itemid"], True),
    ("category_tree", "tree_t", ["categoryid", "parentid"], ["categoryid", "parentid"], False),
    ("raw_ids", "raw_ids", ["row_key", "raw_value"], ["raw_value"], False),
]


def _source_profile() -> str:
    parts = []
    for name, view, cols, ints, has_ts in _SOURCES:
        items = [f"'{name}' as source", "count(*)::bigint as rows_read", f"{len(cols)}::bigint as columns",
                 f"'{'|'.join(cols)}' as column_names",
                 f"(select coalesce(sum(n - 1), 0) from (select count(*) as n from {view} group by all_cols) g)::bigint "
                 "as exact_duplicate_rows".replace("group by all_cols", "group by " + ", ".join(cols)),
                 "'stable_partition_then_exact_original_field_comparison' as duplicate_method"]
        if has_ts:
            items += [f"min({_parse('timestamp')}) as timestamp_min_ms", f"max({_parse('timestamp')}) as timestamp_max_ms"]
        else:
            items += ["null::bigint as timestamp_min_ms", "null::bigint as timestamp_max_ms"]
        items += [f"count(*) filter (where {c} is null) as missing_count__{c}" for c in cols]
        items += [f"{_share(f'count(*) filter (where {c} is null)', 'count(*)')} as missing_rate__{c}" for c in cols]
        items += [f"count(*) filter (where {c} is not null and {_parse(c)} is null) as invalid_parse_count__{c}"
                  for c in ints]
        parts.append(f"select {', '.join(items)} from {view}")
    body = " union all by name ".join(parts)
    return with_fixtures(["log", "props", "tree_func", "raw_ids"], body, extra=[
        ("events_t", _TEXT["events"][0]), ("props_t", _TEXT["props_text"][0]),
        ("p1_t", "select timestamp, itemid, property, value from props_t where _source_name = 'item_properties_part1'"),
        ("p2_t", "select timestamp, itemid, property, value from props_t where _source_name = 'item_properties_part2'"),
        ("tree_t", _TEXT["category_tree"][0])])


def _exact_duplicates() -> str:
    ev_cols = "timestamp, visitorid, event, itemid, transactionid"
    pcols = "timestamp, itemid, property, value"
    body = (
        "select 'events_file_internal' as duplicate_scope, "
        f"(select coalesce(sum(n - 1), 0) from (select count(*) n from events_t group by {ev_cols}))::bigint "
        "as exact_duplicate_row_count, null::bigint as exact_distinct_shared_row_count "
        "union all select 'item_properties_part1_file_internal', coalesce(sum(greatest(n1 - 1, 0)), 0)::bigint, "
        "null::bigint from pg "
        "union all select 'item_properties_part2_file_internal', coalesce(sum(greatest(n2 - 1, 0)), 0)::bigint, "
        "null::bigint from pg "
        "union all select 'item_properties_cross_file', coalesce(sum(least(n1, n2)) filter (where n1 > 0 and n2 > 0), "
        "0)::bigint, count(*) filter (where n1 > 0 and n2 > 0) from pg "
        "union all select 'item_properties_combined', coalesce(sum(n1 + n2 - 1), 0)::bigint, null::bigint from pg "
        "union all select 'category_tree_file_internal', "
        "(select coalesce(sum(n - 1), 0) from (select count(*) n from tree_func group by categoryid, parentid))::bigint, "
        "null::bigint")
    return with_fixtures(["log", "props", "tree_func"], body, extra=[
        ("events_t", _TEXT["events"][0]), ("props_t", _TEXT["props_text"][0]),
        ("pg", f"select {pcols}, count(*) filter (where _source_name = 'item_properties_part1') as n1, "
               f"count(*) filter (where _source_name = 'item_properties_part2') as n2 from props_t group by {pcols}")])


_ITEM_SETS = [
    ("ev", "select distinct itemid from log_items where itemid is not null"),
    ("pr", "select distinct itemid from props where itemid is not null"),
    ("ca", "select distinct itemid from props where itemid is not null and property = 'categoryid'"),
    ("un", "select itemid from ev union select itemid from pr"),
    ("cnt", "select (select count(*) from ev) as e, (select count(*) from pr) as p, (select count(*) from un) as u, "
            "(select count(*) from ca) as c, (select count(*) from ev join pr using (itemid)) as ep, "
            "(select count(*) from ev join ca using (itemid)) as ec, (select count(*) from pr join ca using (itemid)) "
            "as pc, (select count(*) from un join ca using (itemid)) as uc"),
]


def _entity_coverage() -> str:
    return with_fixtures(["log_items", "props"], (
        "select e as event_item_count, p as property_item_count, ep as overlap_item_count, "
        f"{_share('ep', 'e')} as event_items_with_properties_share, {_share('ep', 'p')} as "
        "property_items_with_events_share from cnt"), extra=_ITEM_SETS)


def _attribute_coverage() -> str:
    return with_fixtures(["log_items", "props"], (
        "select e as event_item_count, p as property_item_count, u as union_item_count, "
        f"c as items_with_categoryid_count, {_share('ec', 'e')} as event_item_category_coverage, "
        f"{_share('pc', 'p')} as property_item_category_coverage, {_share('uc', 'u')} as union_item_category_coverage "
        "from cnt"), extra=_ITEM_SETS)


# ---------------------------------------------------------------- history
def _pairs_sql(src: str, by: list[str]) -> list[tuple[str, str]]:
    k = ", ".join(by + ["itemid", "property"])
    return [
        ("hv", f"select * from {src} where itemid is not null and property is not null"),
        ("base", f"select {k}, count(*) as record_count, count(distinct value) as unique_value_count, "
                 "min(timestamp) as first_timestamp_ms, max(timestamp) as last_timestamp_ms, "
                 "count(distinct timestamp) as distinct_timestamp_count, "
                 f"count(*) filter (where value is null) as missing_value_count from hv group by {k}"),
        ("sets", f"select {k}, timestamp, list_sort(list_distinct(list(coalesce(value, '<no value>')))) as vs "
                 f"from hv group by {k}, timestamp"),
        ("fl", f"select {k}, count(distinct vs) as distinct_timestamp_value_sets, "
               f"bool_or(len(vs) > 1) as same_timestamp_multiple_values from sets group by {k}"),
        ("pairs", f"select base.*, fl.distinct_timestamp_value_sets, fl.same_timestamp_multiple_values, "
                  f"fl.distinct_timestamp_value_sets > 1 as value_changes_over_time from base join fl using ({k})"),
    ]


def _roll_sql(by: list[str]) -> tuple[str, str]:
    k = ", ".join(by + ["property"])
    return ("roll", f"select {k}, sum(record_count)::bigint as record_count, count(*)::bigint as unique_item_count, "
                    "sum(missing_value_count)::bigint as missing_value_count, min(first_timestamp_ms) as "
                    "first_timestamp_ms, max(last_timestamp_ms) as last_timestamp_ms, "
                    "count(*) filter (where distinct_timestamp_count > 1) as pairs_with_multiple_timestamps, "
                    "count(*) filter (where unique_value_count > 1) as pairs_with_multiple_values, "
                    "count(*) filter (where value_changes_over_time) as pairs_changing_over_time, "
                    "count(*) filter (where same_timestamp_multiple_values) as pairs_with_same_timestamp_multiple_values "
                    f"from pairs group by {k}")


def _profile_sql(src: str, by: list[str], where: str = "true") -> str:
    bsel = "".join(f"roll.{b}, " for b in by)
    bk = ", ".join(by)
    join_ti = f"left join ti using ({bk})" if by else ", ti"
    extra = _pairs_sql(src, by) + [
        _roll_sql(by),
        ("vals", f"select {bk + ', ' if by else ''}coalesce(property, '<missing>') as property, "
                 f"count(distinct value) as uvc from {src} group by {bk + ', ' if by else ''}coalesce(property, '<missing>')"),
        ("ti", f"select {bk + ', ' if by else ''}count(distinct itemid) as n from {src} where itemid is not null"
               + (f" group by {bk}" if by else "")),
    ]
    body = (f"select {bsel}roll.property, record_count, unique_item_count, coalesce(uvc, 0)::bigint as unique_value_count, "
            f"missing_value_count, {_share('missing_value_count', 'record_count')} as missing_value_rate, "
            f"{_share('unique_item_count', 'ti.n')} as item_coverage, first_timestamp_ms, last_timestamp_ms, "
            "case when roll.property in ('categoryid', 'available') then 'explicit_dataset_property' "
            "else 'unverified_hashed_property' end as semantic_status "
            f"from roll left join vals using ({bk + ', ' if by else ''}property) {join_ti} where {where}")
    return body, extra


def _history_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["pair_history"] = with_fixtures(["props"], "select * from pairs", extra=_pairs_sql("props", []))
    body, extra = _profile_sql("props", [])
    q["property_profile"] = with_fixtures(["props"], body, extra=extra)
    body, extra = _profile_sql("props", [], "roll.property in ('categoryid', 'available')")
    q["special_properties"] = with_fixtures(["props"], body, extra=extra)
    q["property_change"] = with_fixtures(["props"], (
        "select property, unique_item_count as item_property_pair_count, pairs_with_multiple_timestamps, "
        "pairs_with_multiple_values, pairs_changing_over_time, pairs_with_same_timestamp_multiple_values from roll"),
        extra=_pairs_sql("props", []) + [_roll_sql([])])
    q["special_record_counts"] = with_fixtures(["props"], (
        "select property, count(*)::bigint as records from props where property in ('categoryid', 'available') "
        "group by property"))
    body, extra = _profile_sql("dbl", ["part"])
    q["property_parts_profile"] = with_fixtures(["props"], body, extra=[
        ("dbl", "select *, _source_name as part from props union all select *, 'combined' as part from props")] + extra)
    q["asof_attribute"] = with_fixtures(["star_log", "props"], (
        "select v.timestamp, v.visitorid, v.event, v.itemid, (select r.value from rec r where r.itemid = v.itemid "
        "and r.timestamp <= v.timestamp order by r.timestamp desc limit 1) as asof_value from v"), extra=[
        ("rec", "select itemid, timestamp, max(value) as value from props where property = 'categoryid' and itemid "
                "is not null and timestamp is not null group by itemid, timestamp"),
        ("v", f"select timestamp, visitorid, event, itemid from star_log where {VALID}")])
    return q


def _quality_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_profile"] = _source_profile()
    q["parse_integer"] = with_fixtures(["raw_ids"], (
        f"select row_key, raw_value, {_parse('raw_value')} as parsed_value, raw_value is null as is_missing, "
        f"raw_value is not null and {_parse('raw_value')} is null as is_invalid from raw_ids"))
    na = ", ".join("'" + t.replace("'", "''") + "'" for t in __import__("trailcheck.contracts", fromlist=["x"]).NA_TOKENS)
    q["normalized_nulls"] = with_fixtures(["raw_ids"], (
        f"select row_key, case when raw_value in ({na}) then null else raw_value end as raw_value from raw_ids"))
    q["exact_duplicates"] = _exact_duplicates()
    q["entity_coverage"] = _entity_coverage()
    q["attribute_coverage"] = _attribute_coverage()
    q["tagged_union"] = with_fixtures(["props"], "select * from props")
    return q


# ---------------------------------------------------------------- splits
def _labels(scheme: str) -> str:
    if scheme == "rows":
        return ("select visitorid, itemid, timestamp, case when rn <= floor(n::double * 0.7::double) then 'train' "
                "when rn <= floor(n::double * 0.85::double) then 'validation' else 'test' end as split from "
                "(select *, row_number() over (order by timestamp, visitorid, itemid) as rn, count(*) over () as n "
                "from sv) r")
    d = int(scheme)
    return (f"select visitorid, itemid, timestamp, case when timestamp >= mx - {d} * 86400000::bigint then 'test' "
            f"when timestamp >= mx - {2 * d} * 86400000::bigint then 'validation' else 'train' end as split "
            "from sv, (select max(timestamp) as mx from sv) m")


def _scheme_name(scheme: str) -> str:
    return "chronological_70_15_15_by_ordered_rows" if scheme == "rows" else \
        f"last_{scheme}d_test_previous_{scheme}d_validation"


def _split_metrics_sql(scheme: str, fixture: str = "pair_log") -> str:
    body = (
        f"select '{_scheme_name(scheme)}' as scheme, sp.split, "
        "(select count(*) from lab where lab.split = sp.split)::bigint as event_count, "
        "(select count(distinct visitorid) from lab where lab.split = sp.split)::bigint as user_count, "
        "(select count(distinct itemid) from lab where lab.split = sp.split)::bigint as item_count, "
        "case when sp.split = 'train' then 0.0::double else "
        + _share("(select count(distinct visitorid) from lab where lab.split = sp.split and visitorid not in "
                 "(select visitorid from tu))", "(select count(distinct visitorid) from lab where lab.split = sp.split)")
        + " end as cold_user_share, case when sp.split = 'train' then 0.0::double else "
        + _share("(select count(distinct itemid) from lab where lab.split = sp.split and itemid not in "
                 "(select itemid from ti))", "(select count(distinct itemid) from lab where lab.split = sp.split)")
        + " end as cold_item_share, "
        + _share("(select count(distinct visitorid) from lab where lab.split = sp.split and visitorid in "
                 "(select visitorid from tu))", "(select count(distinct visitorid) from lab where lab.split = sp.split)")
        + " as users_with_training_history_share, "
        + _share("(select count(distinct itemid) from lab where lab.split = sp.split and itemid in "
                 "(select itemid from ti))", "(select count(distinct itemid) from lab where lab.split = sp.split)")
        + " as items_seen_in_training_share, "
        "(select count(*) from (select visitorid from lab where lab.split = sp.split group by visitorid "
        "having count(*) >= 2) e)::bigint as next_item_eligible_user_count, "
        "(select count(*) from (select visitorid from lab where lab.split = sp.split group by visitorid "
        "having count(*) >= 2) e)::bigint as leave_future_out_eligible_user_count from sp")
    return with_fixtures([fixture], body, extra=[
        ("sv", f"select * from {fixture} where {VALID}"), ("lab", _labels(scheme)),
        ("tu", "select distinct visitorid from lab where split = 'train'"),
        ("ti", "select distinct itemid from lab where split = 'train'"),
        ("sp", "select 'train' as split union all select 'validation' union all select 'test'")])


def _boundaries_sql(fixture: str = "pair_log") -> str:
    parts, extra = [], [("sv", f"select * from {fixture} where {VALID}")]
    for s in ("rows", "7", "14"):
        extra.append((f"lab_{s}", _labels(s)))
        parts.append(f"select '{_scheme_name(s)}' as scheme, split, min(timestamp) as first_timestamp_ms, "
                     f"max(timestamp) as last_timestamp_ms, count(*)::bigint as event_count from lab_{s} group by split")
    return with_fixtures([fixture], " union all ".join(parts), extra=extra)


def _cold_prior_sql(fixture: str = "pair_log") -> str:
    parts, extra = [], [("sv", f"select * from {fixture} where {VALID}")]
    for s in ("rows", "7", "14"):
        lab = f"lab_{s}"
        extra.append((lab, _labels(s)))
        for split, prior in (("validation", "('train')"), ("test", "('train', 'validation')")):
            uc = f"(select count(distinct visitorid) from {lab} where split = '{split}')"
            ic = f"(select count(distinct itemid) from {lab} where split = '{split}')"
            cu = (f"(select count(distinct visitorid) from {lab} where split = '{split}' and visitorid not in "
                  f"(select visitorid from {lab} where split in {prior}))")
            ci = (f"(select count(distinct itemid) from {lab} where split = '{split}' and itemid not in "
                  f"(select itemid from {lab} where split in {prior}))")
            parts.append(f"select '{_scheme_name(s)}' as scheme, '{split}' as split, {uc}::bigint as user_count, "
                         f"{_share(cu, uc)} as cold_user_share_vs_prior, {ic}::bigint as item_count, "
                         f"{_share(ci, ic)} as cold_item_share_vs_prior")
    return with_fixtures([fixture], " union all ".join(parts), extra=extra)


# ---------------------------------------------------------------- tree
def _tree_ctes(fixture: str) -> list[tuple[str, str]]:
    return [
        ("nd0", f"select categoryid as node, min(parentid) as parent, count(*) as copies from {fixture} "
                "where categoryid is not null group by categoryid"),
        ("nd", "select a.*, b.node is not null as pexists from nd0 a left join nd0 b on b.node = a.parent"),
        ("nn", "select count(*) as n from nd"),
        ("walk", "select node, node as cur, 0 as steps from nd union all select w.node, p.parent, w.steps + 1 "
                 "from walk w join nd p on p.node = w.cur where p.pexists and w.steps <= (select n from nn)"),
        ("last", "select node, arg_max(cur, steps) as cur, max(steps) as steps from walk group by node"),
        ("cyc", "select distinct node from walk where cur = node and steps > 0"),
        ("det", "select nd.node as categoryid, nd.parent as parentid, nd.parent is null as is_root, "
                "(nd.parent is not null and not nd.pexists) as has_missing_parent, "
                "coalesce(nd.parent = nd.node, false) as is_self_loop, cyc.node is not null as is_cycle_node, "
                "case when l.steps <= (select n from nn) and t.parent is null then (l.steps + 1)::bigint end "
                "as resolved_depth from nd join last l on l.node = nd.node join nd t on t.node = l.cur "
                "left join cyc on cyc.node = nd.node"),
    ]


def _tree_nodes_sql(fixture: str) -> str:
    return with_fixtures([fixture], "select * from det", extra=_tree_ctes(fixture), recursive=True)


def _tree_summary_sql(fixture: str) -> str:
    return with_fixtures([fixture], (
        f"select (select count(*) from {fixture})::bigint as category_row_count, count(*)::bigint as "
        "distinct_category_count, (select coalesce(sum(copies) filter (where copies > 1), 0) from nd)::bigint as "
        "duplicate_category_row_count, count(*) filter (where is_root) as root_count, count(*) filter (where "
        "has_missing_parent) as missing_parent_node_count, count(*) filter (where is_self_loop) as self_loop_count, "
        "count(*) filter (where is_cycle_node) as cycle_node_count, coalesce(max(resolved_depth), 0)::bigint as "
        "max_resolved_depth from det"), extra=_tree_ctes(fixture), recursive=True)


def _split_tree_queries() -> dict[str, str]:
    q = {"split_by_rows": _split_metrics_sql("rows"), "split_last_7d": _split_metrics_sql("7"),
         "split_last_14d": _split_metrics_sql("14"), "split_boundaries": _boundaries_sql(),
         "cold_vs_prior_splits": _cold_prior_sql()}
    for f in ("tree_func", "tree_heap"):
        q[f"tree_nodes_{f.split('_')[1]}"] = _tree_nodes_sql(f)
        q[f"tree_summary_{f.split('_')[1]}"] = _tree_summary_sql(f)
    return q


# ---------------------------------------------------------------- spec-only analytics
def _concentration_bodies(items_cte: str) -> tuple[list[tuple[str, str]], str, str]:
    fr = " union all ".join(f"select cast('{p}' as double) as p" for p in (0.01, 0.05, 0.10, 0.20))
    ctes = [("lt_items", items_cte),
            ("lt_rd", "select c, row_number() over (order by c desc, itemid asc) as rk from lt_items"),
            ("lt_ra", "select c, row_number() over (order by c asc, itemid asc) as rk from lt_items"),
            ("lt_nt", "select count(*) as n, coalesce(sum(c), 0) as t from lt_items"), ("lt_fr", fr)]
    top = ("select p as top_item_percentage, 'ceil; ties resolved by ascending itemid' as rounding_rule, "
           "topn as top_item_count, coalesce((select sum(c) from lt_rd where rk <= topn), 0)::bigint as "
           f"behavior_count, {_share('coalesce((select sum(c) from lt_rd where rk <= topn), 0)', 'lt_nt.t')} as "
           "behavior_contribution_share, 'top_contribution' as metric from (select p, case when n > 0 then "
           "greatest(1, ceil(n::double * p))::bigint else 0::bigint end as topn from lt_fr, lt_nt) s, lt_nt")
    gin = ("select null::double as top_item_percentage, 'all event-observed items' as rounding_rule, n::bigint as "
           "top_item_count, t::bigint as behavior_count, case when n = 0 then null when t = 0 then 0.0::double else "
           f"2.0::double * {_dbl('s')} / (n::double * t::double) - (n::double + 1.0::double) / n::double end as "
           "behavior_contribution_share, 'gini_coefficient' as metric from (select (select n from lt_nt) as n, "
           "(select t from lt_nt) as t, (select sum(cast(rk as decimal(38,0)) * c) from lt_ra) as s) z")
    return ctes, top, gin


def _long_tail_by_universe() -> str:
    parts, extra = [], [
        ("tot", f"select itemid, count(*) as c from log_items where {VALID} group by itemid"),
        ("flags", "select itemid, bool_or(e) as e, bool_or(p) as p from (select itemid, true as e, false as p from "
                  "log_items where itemid is not null union all select itemid, false, true from props where itemid is "
                  "not null) u group by itemid"),
        ("filled", "select f.itemid, f.e, f.p, coalesce(t.c, 0) as c from flags f left join tot t using (itemid)")]
    for name, cond in (("event_items", "e"), ("property_items", "p"), ("union_items", "true")):
        ctes, top, gin = _concentration_bodies(f"select itemid, c from filled where {cond}")
        ren = {n: f"{n}_{name}" for n, _ in ctes}
        def sub(t):
            for a, b in sorted(ren.items(), key=lambda kv: -len(kv[0])):
                t = __import__("re").sub(rf"\b{a}\b", b, t)
            return t
        extra += [(ren[n], sub(q)) for n, q in ctes]
        parts.append(f"select '{name}' as universe, * from ({sub(top)}) a")
        parts.append(f"select '{name}' as universe, * from ({sub(gin)}) b")
    return with_fixtures(["log_items", "props"], " union all ".join(parts), extra=extra)


def _spec_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["pair_order_patterns"] = with_fixtures(["log"], (
        "select pattern, count(*)::bigint as pair_count from (select visitorid, itemid, string_agg(case when prev is "
        "null then '' when prev = ts then '=' else '<' end || event, '' order by ts, event) as pattern from "
        "(select *, lag(ts) over (partition by visitorid, itemid order by ts, event) as prev from firsts) x "
        "group by visitorid, itemid) y group by pattern"), extra=[
        ("firsts", f"select visitorid, itemid, event, min(timestamp) as ts from log where {VALID} and event in "
                   "('view', 'addtocart', 'transaction') group by visitorid, itemid, event")])
    ks = " union all ".join(f"select {k} as k" for k in (2, 3, 5, 10, 20))
    q["short_history_removal_impact"] = with_fixtures(["pair_log"], (
        "select k.k::bigint as min_user_events, (select count(*) from u where n >= k.k)::bigint as users_kept, "
        f"{_share('(select count(*) from u where n >= k.k)', '(select count(*) from u)')} as user_share_kept, "
        "(select coalesce(sum(n), 0) from u where n >= k.k)::bigint as events_kept, "
        f"{_share('(select coalesce(sum(n), 0) from u where n >= k.k)', '(select sum(n) from u)')} as event_share_kept "
        "from ks k"), extra=[("u", f"select visitorid, count(*) as n from pair_log where {VALID} group by visitorid"),
                             ("ks", ks)])
    lf = ["count(*)::bigint as item_count",
          "count(*) filter (where tx = 0) as no_transaction_item_count",
          f"{_share('count(*) filter (where tx = 0)', 'count(*)')} as no_transaction_item_share"]
    for k in (2, 5, 10):
        lf += [f"count(*) filter (where c < {k}) as items_below_{k}_events_count",
               f"{_share(f'count(*) filter (where c < {k})', 'count(*)')} as items_below_{k}_events_share"]
    q["low_frequency_share"] = with_fixtures(["order_log"], "select " + ", ".join(lf) + " from it", extra=[
        ("it", f"select itemid, count(*) as c, count(*) filter (where event = 'transaction') as tx from order_log "
               f"where {VALID} group by itemid")])
    cuts = []
    for d in (7, 14):
        for label, mult in (("test_start", 1), ("validation_start", 2)):
            cut = f"(mx - {mult * d} * 86400000::bigint)"
            cuts.append(f"select 'last_{d}d_{label}' as cutoff, {cut} as cutoff_ms, "
                        f"(select count(*) from it where last_ts >= {cut})::bigint as active_item_count, "
                        f"(select count(*) from it where first_ts >= {cut})::bigint as new_item_count, "
                        f"{_share(f'(select count(*) from it where first_ts >= {cut})', f'(select count(*) from it where last_ts >= {cut})')} "
                        "as new_item_share from m")
    q["new_item_cohorts"] = with_fixtures(["log"], " union all ".join(cuts), extra=[
        ("it", f"select itemid, min(timestamp) as first_ts, max(timestamp) as last_ts from log where {VALID} "
               "group by itemid"), ("m", f"select max(timestamp) as mx from log where {VALID}")])
    q["long_tail_by_universe"] = _long_tail_by_universe()
    q["history_features"] = with_fixtures(["order_log"], (
        "select e.timestamp, e.visitorid, e.event, e.itemid, "
        "(select count(*) from v p where p.visitorid = e.visitorid and p.timestamp < e.timestamp) as "
        "user_prior_event_count, (select count(distinct floor(p.timestamp / 86400000)) from v p where "
        "p.visitorid = e.visitorid and p.timestamp < e.timestamp) as user_prior_active_day_count, "
        "(select count(*) from v p where p.itemid = e.itemid and p.timestamp < e.timestamp) as item_prior_event_count, "
        "(select count(*) from v p where p.visitorid = e.visitorid and p.itemid = e.itemid and p.timestamp < "
        "e.timestamp) as pair_prior_event_count from v e"), extra=[
        ("v", f"select timestamp, visitorid, event, itemid from order_log where {VALID}")])
    tree = _tree_ctes("tree_heap")
    q["category_depth_coverage"] = with_fixtures(["props", "tree_heap"], (
        "select det.resolved_depth, count(*)::bigint as item_count from latest left join det on det.categoryid = "
        f"{_parse('latest.value')} group by det.resolved_depth"), extra=tree + [
        ("latest", "select itemid, value from (select itemid, value, row_number() over (partition by itemid order by "
                   "timestamp desc, value desc) as rn from props where property = 'categoryid' and itemid is not null "
                   "and timestamp is not null and value is not null) r where rn = 1")], recursive=True)
    day = "cast(date '1970-01-01' + cast(floor(timestamp / 86400000) as integer) as varchar)"
    q["trend_hourly"] = with_fixtures(["log"], (
        f"select 'hour' as granularity, {day} || ' ' || lpad(cast(cast(floor((timestamp % 86400000) / 3600000) as "
        "bigint) as varchar), 2, '0') || ':00:00' as period_start_utc, event, count(*)::bigint as event_count from log "
        "where timestamp is not null and event is not null group by 2, 3"))
    wk = ("cast(date '1970-01-01' + cast(floor(timestamp / 86400000)::bigint - ((floor(timestamp / 86400000)::bigint "
          "+ 3) % 7) as integer) as varchar)")
    q["trend_weekly"] = with_fixtures(["order_log"], (
        f"select 'week' as granularity, {wk} || ' 00:00:00' as period_start_utc, event, count(*)::bigint as "
        "event_count from order_log where timestamp is not null and event is not null group by 2, 3"))
    from trailcheck.plans.catalog import B01, EVIDENCE_META

    _, population, denominator = EVIDENCE_META[B01]
    q["evidence_annotation"] = with_fixtures(["log"], (
        f"select {_lit(B01)} as evidence_id, 'full' as data_scope, {_lit(population)} as population, "
        f"{_lit(denominator)} as denominator_definition, coalesce(event, '<missing>') as event, count(*)::bigint "
        f"as event_count, {_share('count(*)', '(select count(*) from log)')} as event_share, "
        "coalesce(event, '<missing>') in ('view', 'addtocart', 'transaction') as is_expected_event "
        "from log group by coalesce(event, '<missing>')"))
    ra = []
    for name, view, cols, ints, _ in _SOURCES:
        for c in cols:
            valid = f"{_parse(c)} is not null" if c in ints else f"{c} is not null"
            inv = f"{c} is not null and {_parse(c)} is null" if c in ints else "false"
            ra.append(f"select '{name}' as source, '{c}' as column, count(*)::bigint as rows, count(*) filter (where "
                      f"{c} is null) as missing, count(*) filter (where {inv}) as invalid, count(*) filter (where "
                      f"{valid}) as valid, count(*) = count(*) filter (where {c} is null) + count(*) filter (where "
                      f"{inv}) + count(*) filter (where {valid}) as reconciles from {view}")
    q["row_accounting"] = with_fixtures(["log", "props", "tree_func", "raw_ids"], " union all ".join(ra), extra=[
        ("events_t", _TEXT["events"][0]), ("props_t", _TEXT["props_text"][0]),
        ("p1_t", "select timestamp, itemid, property, value from props_t where _source_name = 'item_properties_part1'"),
        ("p2_t", "select timestamp, itemid, property, value from props_t where _source_name = 'item_properties_part2'"),
        ("tree_t", _TEXT["category_tree"][0])])
    # the second run goes by item and day first
    by_day = ("select itemid, floor(timestamp / 86400000) as day, count(*) as n, min(timestamp) as lo, max(timestamp) as hi, "
              "count(*) filter (where event = 'view') as v, count(*) filter (where event = 'addtocart') as c, "
              f"count(*) filter (where event = 'transaction') as t from log where {VALID} group by all")
    again = ("select itemid, sum(n)::bigint, count(*)::bigint, min(lo), max(hi), sum(v)::bigint, sum(c)::bigint, sum(t)::bigint "
             "from by_day group by itemid")
    lost = "(select count(*) from (select * from {} except all select * from {}))"
    q["rerun_equivalence"] = with_fixtures(["log"], (
        "select 'item_metrics' as \"table\", (select count(*) from run_a)::bigint as rows_a, (select count(*) from run_b)::bigint as rows_b, "
        f"{lost.format('run_a', 'run_b')}::bigint as only_in_a, {lost.format('run_b', 'run_a')}::bigint as only_in_b, "
        f"{lost.format('run_a', 'run_b')} + {lost.format('run_b', 'run_a')} = 0 as equal"),
        extra=[("run_a", _ITEMS.format(src="log")), ("by_day", by_day), ("run_b", again)])
    return q


# ---------------------------------------------------------------- evidence layer
def _count_of(sql: str) -> str:
    return f"(select count(*) from ({sql}) z)"


def _evidence_row_counts() -> dict[str, str]:
    """Row count of every evidence table of the fixture audit (log, props, tree_func)."""
    from trailcheck.plans import catalog as C

    base = _table_queries()
    combos = with_fixtures(["log"], (
        "select count(*) from (select distinct array_to_string(list_sort(list_distinct(list(event))), '|') "
        "from log where visitorid is not null and event is not null group by visitorid) c"))
    return {
        C.A01: _count_of(base["source_profile"]), C.A02: _count_of(base["exact_duplicates"]),
        C.B01: _count_of(base["event_distribution"]), C.B02: _count_of(base["daily_trend"]),
        C.B03: f"({combos})", C.B04: "1", C.B05: "2",
        C.C01: _count_of(base["user_sequences"]), C.C02: str(len(USER_METRICS)), C.C03: str(len(SEQUENCE_BUCKETS)),
        C.D01: _count_of(base["item_metrics"]), C.D02: "5", C.F01: "9",
        C.E01: _count_of(base["property_profile"]), C.E02: _count_of(base["property_change"]),
        C.E03: _count_of(base["special_properties"]), C.A03: "1", C.A04: "1", C.A05: "1",
        C.A06: _count_of(base["tree_nodes_func"]),
    }


def _lit(v) -> str:
    return "null" if v is None else "'" + str(v).replace("'", "''") + "'"


def _evidence_index_sql() -> str:
    from trailcheck.plans.catalog import EVIDENCE_META

    counts = _evidence_row_counts()
    rows = [f"select {_lit(eid)} as evidence_id, {_lit(t)} as title, {_lit(p)} as population, {_lit(d)} as "
            f"denominator, ({counts[eid]})::bigint as row_count, null::varchar as path"
            for eid, (t, p, d) in EVIDENCE_META.items() if eid in counts]
    return " union all ".join(rows)


def _feature_matrix_sql() -> str:
    from trailcheck.plans import catalog as C

    counts = _evidence_row_counts()
    v = f"select * from log where {VALID}"
    metric_sql = {
        (C.A01, "rows_read"): with_fixtures(["log"], "select cast(count(*) as varchar) from log"),
        (C.A03, "overlap_item_count"): with_fixtures(["log", "props"], (
            "select cast(count(*) as varchar) from (select distinct itemid from log where itemid is not null) e "
            "join (select distinct itemid from props where itemid is not null) p using (itemid)")),
        (C.A04, "union_item_category_coverage"): with_fixtures(["log", "props"], (
            "select cast(case when u > 0 then c::double / u::double else 0.0::double end as varchar) from "
            "(select (select count(*) from (select itemid from log where itemid is not null union select itemid "
            "from props where itemid is not null) x) as u, (select count(distinct itemid) from props where itemid "
            "is not null and property = 'categoryid') as c) z")),
        (C.B04, "transaction_event_count"): with_fixtures(["log"], f"select cast(count(*) as varchar) from ({v}) t "
                                                                   "where event = 'transaction'"),
    }
    parts = []
    for rule in C.feature_rules_df.__globals__["FEATURE_RULES"]:
        group, name, support, ev, metric, usage = rule
        src, method, leak, limits = C._FEATURE_PROSE[support]
        value = f"cast({counts[ev]} as varchar)" if metric == "row_count" else f"({metric_sql[(ev, metric)]})"
        parts.append(f"select {_lit(group)} as feature_group, {_lit(name)} as feature_name, {_lit(src)} as "
                     f"source_fields, {_lit(method)} as construction_method, {_lit(support)} as support_level, "
                     f"{_lit(ev)} as coverage_evidence_id, {value} as coverage_value, {_lit(leak)} as leakage_risk, "
                     f"{_lit(limits)} as limitations, {_lit(usage)} as recommended_usage, '' as notes")
    return " union all ".join(parts)


def _module_matrix_sql() -> str:
    """H01 evidence text: ID[c1=v1,c2=v2] from each cited table's first two
    numeric columns, first non-null value in the table's key order."""
    from trailcheck.plans import catalog as C

    base = _table_queries()
    cov = with_fixtures(["log", "props"], (
        "select (select count(distinct itemid) from log where itemid is not null) as event_item_count, "
        "(select count(distinct itemid) from props where itemid is not null) as property_item_count"))
    spec = {  # evidence id -> (oracle body, key order, first two numeric columns)
        C.A01: (base["source_profile"], "case when source = 'events' then 0 else 1 end, source",
                ["rows_read", "columns"]),
        C.A03: (cov, "1", ["event_item_count", "property_item_count"]),
        C.A04: (cov, "1", ["event_item_count", "property_item_count"]),
        C.B01: (base["event_distribution"], "event", ["event_count", "event_share"]),
        C.B04: (base["prior_behavior"], "1", ["transaction_event_count", "with_strictly_prior_view_count"]),
        C.C01: (base["user_sequences"], "visitorid", ["visitorid", "total_behavior_length"]),
        C.C02: (base["sequence_distribution"], "metric", ["count", "mean"]),
        C.C03: (_length_buckets("log"), "sequence_length_bucket", ["user_count", "user_share"]),
        C.D01: (base["item_metrics"], "itemid", ["itemid", "total_behavior_count"]),
        C.D02: (f"({_top_share('log')}) union all ({_gini('log')})", "metric, top_item_percentage nulls first",
                ["top_item_percentage", "top_item_count"]),
        C.E01: (base["property_profile"], "property", ["record_count", "unique_item_count"]),
        C.E03: (base["special_properties"], "property", ["record_count", "unique_item_count"]),
        C.F01: (" union all ".join(f"({_split_metrics_sql(s, 'log')})" for s in ("rows", "7", "14")),
                "scheme, split", ["event_count", "user_count"]),
    }

    # every cited table once, then one row with all evidence texts, read by all rules
    cited = list(dict.fromkeys(e for _, _, evs, _, _ in C.MODULE_RULES for e in evs))
    name = {e: f"ev{i}" for i, e in enumerate(cited)}
    tables, texts = [], []
    for e in cited:
        if e == C.G01:
            texts.append(f"'{e}[rows={len(C.FEATURE_RULES)}]' as {name[e]}")
            continue
        body, order, cols = spec[e]
        tables.append(f"{name[e]} as materialized ({body})")
        vals = [f"(select cast(\"{c}\" as varchar) from {name[e]} where \"{c}\" is not null order by {order} limit 1)"
                for c in cols]
        pairs = " || ',' || ".join(f"'{c}=' || {v}" for c, v in zip(cols, vals))
        texts.append(f"'{e}[' || {pairs} || ']' as {name[e]}")
    tables.append(f"texts as materialized (select {', '.join(texts)})")

    parts = []
    for module, support, evs, action, conf in C.MODULE_RULES:
        req, scope, limits, leak = C._MODULE_PROSE[support]
        evidence = " || '; ' || ".join(name[e] for e in evs)
        parts.append(f"select {_lit(module)} as module, {_lit(req)} as required_data, {_lit(support)} as "
                     f"dataset_support, {evidence} as evidence, {_lit(scope)} as feasible_scope, {_lit(limits)} as "
                     f"limitations, {_lit(leak)} as leakage_risk, {_lit(action)} as recommended_action, "
                     f"{_lit(conf)} as confidence, '' as notes from texts")
    return f"with {', '.join(tables)} {' union all '.join(parts)}"


def _numeric_names(sql: str) -> str:
    """Names of the numeric columns of a query."""
    return f"select column_name from (describe {sql}) where column_type in ('INTEGER', 'BIGINT', 'DOUBLE', 'HUGEINT')"


def _traceability_sql() -> str:
    """Every citation, and whether a table of that id has the row count or a numeric column of that name."""
    from trailcheck.plans import catalog as C

    base, counts = _table_queries(), _evidence_row_counts()
    known = [f"select {_lit(e)} as evidence_id, 'row_count' as metric" for e in (*counts, C.G01)]
    tables = {C.A01: base["source_profile"], C.A03: base["entity_coverage"], C.A04: base["attribute_coverage"], C.B04: base["prior_behavior"]}
    known += [f"select {_lit(e)}, column_name from ({_numeric_names(sql)}) z" for e, sql in tables.items()]
    cited = [f"select 'feature' as catalogue, {_lit(r[1])} as rule, {_lit(r[3])} as evidence_id, {_lit(r[4])} as metric" for r in C.FEATURE_RULES]
    cited += [f"select 'module', {_lit(m[0])}, {_lit(e)}, 'row_count'" for m in C.MODULE_RULES for e in m[2]]
    return (f"with known as ({' union all '.join(known)}), cited as ({' union all '.join(cited)}) select catalogue, rule, evidence_id, metric, "
            "exists (select 1 from known k where k.evidence_id = cited.evidence_id and k.metric = cited.metric) as resolved from cited")


def _rule_evaluation_sql() -> str:
    from trailcheck.plans import catalog as C
    from trailcheck.plans.registry import SAMPLE_RULES

    rows = ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else _lit(x) for x in r) + ")" for r in SAMPLE_RULES)
    n = "(select count(*) from ({}))"
    shares = ["transaction_event_count", "with_strictly_prior_view_count", "with_strictly_prior_view_share", "with_strictly_prior_addtocart_count"]
    metrics = [f"select {_lit(C.B04)} as evidence_id, {_lit(c)} as metric, cast({c} as varchar) as v, 1 as n from b04" for c in shares]
    metrics += [f"select {_lit(C.B04)}, 'summary', 'transaction_event_count=' || transaction_event_count || ',with_strictly_prior_view_count=' || "
                "with_strictly_prior_view_count, 1 from b04",
                f"select {_lit(C.D01)}, 'row_count', cast(n as varchar), n from (select count(distinct itemid) as n from log_items where {VALID})",
                f"select {_lit(C.B01)}, 'row_count', cast(n as varchar), n from (select count(distinct coalesce(event, '<missing>')) as n from log_items)"]
    metrics += [f"select {_lit(C.A03)}, {_lit(c)}, cast({q} as varchar), 1" for c, q in (
        ("overlap_item_count", n.format("select itemid from log_items where itemid is not null intersect select itemid from props where itemid is not null")),
        ("event_item_count", n.format("select distinct itemid from log_items where itemid is not null")))]
    number = "try_cast(v as double)"
    wanted = "coalesce(try_cast(threshold as double), try_cast(tv as double))"
    outcome = (f"case when v is null then 'unresolved' when comparison = 'present' then 'pass' when {number} is null or {wanted} is null then 'unresolved' "
               + " ".join(f"when comparison = '{c}' then case when {number} {c.replace('!=', '<>')} {wanted} then 'pass' else 'fail' end" for c in (">=", ">", "<=", "<", "=", "!="))
               + " end")
    text = "template"
    for name, value in (("value", "v"), ("threshold", "coalesce(tv, threshold)"), ("metric", "metric"), ("rows", "cast(n as varchar)"), ("evidence_id", "evidence_id")):
        text = f"replace({text}, '{{{name}}}', coalesce({value}, '?'))"
    return with_fixtures(["log_items", "props"], (
        f"select rule_id, case when bool_or(o = 'unresolved') then 'unresolved' when bool_or(o = 'fail') then 'fail' else 'pass' end as outcome, "
        "count(*) filter (where o = 'pass') as passed, count(*) filter (where o = 'fail') as failed, count(*) filter (where o = 'unresolved') as unresolved, "
        f"string_agg(said, '; ' order by position) as text from (select *, {outcome} as o, {text} as said from x) group by rule_id"), extra=[
            ("b04", _prior_behavior("log_items")), ("m", " union all ".join(metrics)),
            ("r", f"select * from (values {rows}) t(rule_id, position, evidence_id, metric, comparison, threshold, template)"),
            ("x", "select r.*, m.v, m.n, t.v as tv from r left join m on m.evidence_id = r.evidence_id and m.metric = r.metric "
                  "left join m t on r.threshold = t.evidence_id || '.' || t.metric")])


def _order_queries() -> dict[str, str]:
    """Row order, given intervals, differences of runs."""
    changed = "select * from log_items where visitorid % 211 <> 0 or event <> 'view'"
    lost = "select *, '{}' as run, count(*)::bigint as copies from (select * from {} except all select * from {}) group by all"
    return {
        "tree_nodes_first_row": _tree_nodes_sql("tree_first"),
        "tree_row_numbers": with_fixtures(["tree_lines"], "select * from tree_lines"),
        "price_intervals": "select 'from ' || lower as label, count(cents)::bigint as row_count, coalesce(sum(cents), 0)::bigint as value_sum from "
                           "(select i * i as lower, case when i < 9999 then (i + 1) * (i + 1) - 1 else 9000000000000000 end as upper from range(10000) r(i)) s "
                           "left join (select cast(round(o_totalprice * 100) as bigint) as cents from orders) o on cents between lower and upper group by lower",
        "table_difference": with_fixtures(["log_items"], f"{lost.format('a', 'run_a', 'run_b')} union all {lost.format('b', 'run_b', 'run_a')}", extra=[
            ("changed", changed), ("run_a", _ITEMS.format(src="log_items")), ("run_b", _ITEMS.format(src="changed"))]),
    }


def _table_queries() -> dict[str, str]:
    """All but the evidence layer, which is built on these."""
    return {**_behavior_queries(), **_quality_queries(), **_history_queries(), **_split_tree_queries(), **_spec_queries(), **_order_queries()}


def oracle_queries() -> dict[str, str]:
    return {**_table_queries(), "evidence_index": _evidence_index_sql(), "feature_matrix": _feature_matrix_sql(),
            "module_matrix": _module_matrix_sql(), "evidence_traceability": _traceability_sql(), "rule_evaluation": _rule_evaluation_sql()}
