"""DuckDB oracle SQL for the registered queries.

Each string runs on DuckDB over the staged tables (views named after them) and
must give the same rows as the Spark query of the same name.  The derived
feeds are written out as portable SQL CTEs (the rules of FIXTURES.md).
"""

from __future__ import annotations

CHANGELOG = """
cl_w as (
  select event_id, ts, user_id, event_type as et, value, props,
         lag(value) over (partition by user_id order by event_id) as pv,
         lag(props) over (partition by user_id order by event_id) as pp
  from events),
cl_c as (
  select *, case when event_id % 250 = 0 then 'query' when et = 'signup' then 'insert'
                 when et = 'error' then 'delete' else 'update' end as op,
         cast(floor(event_id / 1000) as bigint) + 1 as fno
  from cl_w),
cl as (
  select event_id as seq,
         concat('mysql-bin.', lpad(cast(fno as varchar), 6, '0')) as log_file,
         fno as file_no,
         cast(4 + (event_id % 1000) * 120 as bigint) as log_pos,
         0 as row_no,
         fno * 4294967296 + 4 + (event_id % 1000) * 120 as pos_key,
         case when user_id % 2 = 0 then 'app' else 'audit' end as db,
         concat('t', cast(user_id % 4 as varchar)) as tbl,
         op as event_type,
         case when op <> 'query' then '' else replace(replace(case (event_id // 250) % 5
              when 0 then 'ALTER TABLE `tT` ADD `cN` INT'
              when 1 then '/* note */ ALTER TABLE `tT` ADD COLUMN `cN` INT, ADD INDEX `iN` (`id`)'
              when 2 then 'ALTER TABLE `tT` ADD (`cN` INT, `dN` DECIMAL(10,2))'
              when 3 then 'ALTER TABLE `tT` MODIFY `props` TEXT'
              else 'ALTER TABLE `tT` ADD UNIQUE KEY `uN` (`value`)' end,
              '`tT`', concat('`t', cast(user_id % 4 as varchar), '`')), 'N`', concat(cast(event_id as varchar), '`')) end as query,
         case when op = 'query' then '' else 'id' end as "primary",
         case when op in ('update','delete') then user_id end as b_id,
         case when op in ('update','delete') then pv end as b_value,
         case when op in ('update','delete') then pp end as b_props,
         case when op in ('insert','update') then user_id end as a_id,
         case when op in ('insert','update') then value end as a_value,
         case when op in ('insert','update') then props end as a_props,
         ts as ev_ts
  from cl_c)"""

# Keyed changes: the record key is coalesce(after.id, before.id); query rows have none.
KEYED = """
kc as (
  select *, coalesce(a_id, b_id) as id from cl where event_type <> 'query')"""

ROW_IMAGES = """
ri as (
  select l_orderkey,
         case when l_orderkey % 3 = 0 then 'insert' when l_orderkey % 3 = 1 then 'update' else 'delete' end as op,
         row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 as row_no,
         l_partkey, l_quantity, l_extendedprice
  from lineitem)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["envelope"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type, query, "primary",
       b_id as before_id, b_value as before_value, b_props as before_props,
       a_id as after_id, a_value as after_value, a_props as after_props,
       cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as "timestamp"
from cl"""

SQL["latest_state"] = with_(CHANGELOG, KEYED) + """,
ranked as (
  select *, count(*) over (partition by db, tbl, id) as n_changes,
         row_number() over (partition by db, tbl, id order by pos_key desc, row_no desc) as rn
  from kc)
select db, tbl, id, a_value as value, a_props as props, event_type as last_op, log_file, log_pos, n_changes
from ranked where rn = 1 and event_type <> 'delete'"""

SQL["change_rollup"] = with_(CHANGELOG) + """
select db, tbl, event_type, count(*) as n_changes, grouping_id(db, tbl, event_type) as gid
from cl group by rollup (db, tbl, event_type)"""

PACKED = """
pk_p as (
  select o_orderkey, o_orderdate,
         cast(extract(year from o_orderdate) as bigint) y, cast(extract(month from o_orderdate) as bigint) m,
         cast(extract(day from o_orderdate) as bigint) dd, cast(extract(hour from o_orderdate) as bigint) h,
         cast(extract(minute from o_orderdate) as bigint) mi,
         cast(floor(extract(second from o_orderdate)) as bigint) se from orders),
pk as (
  select o_orderkey, (549755813888 | ((y*13+m) << 22) | (dd << 17) | (h << 12) | (mi << 6) | se) as dt2,
         ((y << 9) | (m << 5) | dd) as d3, o_orderdate, y, m, dd, h, mi, se
  from pk_p)"""

CELLS = """
ce as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
         (o_orderkey * 7919) % 3020400 as secs,
         case when o_orderkey % 5 = 0 then -1 else 1 end as sgn,
         case when o_orderkey % 50 = 0 then 0 else
           cast(extract(year from o_orderdate) as bigint) * 10000000000 + cast(extract(month from o_orderdate) as bigint) * 100000000
           + cast(extract(day from o_orderdate) as bigint) * 1000000 + cast(extract(hour from o_orderdate) as bigint) * 10000
           + cast(extract(minute from o_orderdate) as bigint) * 100 + cast(floor(extract(second from o_orderdate)) as bigint)
         end as dt_int,
         case when o_orderkey % 97 = 0 then 0 when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 2
              when o_orderstatus = 'P' then 3 end as enum_idx,
         o_orderkey % 8 as set_mask
  from orders)"""

SQL["decode_unsigned"] = """
select o_orderkey,
       256 - ((o_orderkey % 128) + 1) as u_tiny,
       65536 - ((o_orderkey % 32768) + 1) as u_small,
       16777216 - ((o_orderkey % 8388608) + 1) as u_medium,
       case when (o_orderkey * 40503) % 16777216 >= 8388608 then (o_orderkey * 40503) % 16777216 - 16777216
            else (o_orderkey * 40503) % 16777216 end as s_medium24,
       4294967296 - ((o_orderkey % 2147483648) + 1) as u_int,
       cast(case when o_orderkey = 0 then 0 else cast('18446744073709551616' as hugeint) - o_orderkey end as decimal(20,0)) as u_bigint
from orders"""

SQL["decode_bool"] = """
select o_orderkey, o_orderkey % 3 as tiny1,
       case o_orderkey % 3 when 1 then true when 0 then false end as as_bool
from orders"""

SQL["decode_year"] = """
select o_orderkey, case when o_orderkey % 256 = 0 then null else 1900 + o_orderkey % 256 end as yr
from orders"""

SQL["decode_decimal"] = """
select o_orderkey,
       cast(concat(cast(o_custkey % 100000 as varchar), '.', lpad(cast(o_orderkey % 100 as varchar), 2, '0'))
            as decimal(12,2)) as dec_value
from orders"""

SQL["decode_date"] = with_(PACKED) + """
select o_orderkey, cast(o_orderdate as date) as decoded_date from pk"""

SQL["decode_time"] = with_(CELLS) + """
select o_orderkey, sgn * secs as time_secs, sgn * secs as time2_secs,
       concat(case when sgn * secs < 0 then '-' else '' end,
              format('{:d}:{:02d}:{:02d}', secs // 3600, (secs // 60) % 60, secs % 60)) as time_text
from ce"""

SQL["decode_timestamp"] = """
select o_orderkey, make_timestamp((1500000000 + o_orderkey * 37) * 1000000) as ts_value from orders"""

SQL["decode_datetime_int"] = with_(CELLS) + """
select o_orderkey, dt_int,
       case when dt_int = 0 then null else date_trunc('second', o_orderdate) end as dt_value
from ce"""

SQL["decode_datetime_packed"] = with_(PACKED) + """
select o_orderkey, dt2,
       make_timestamp(cast(((dt2 >> 22) & 131071) // 13 as bigint), cast(((dt2 >> 22) & 131071) % 13 as bigint),
                      cast((dt2 >> 17) & 31 as bigint), cast((dt2 >> 12) & 31 as bigint),
                      cast((dt2 >> 6) & 63 as bigint), cast(dt2 & 63 as double)) as dt_value
from pk"""

SQL["decode_enum"] = with_(CELLS) + """
select o_orderkey, enum_idx,
       case enum_idx when 0 then '' when 1 then 'F' when 2 then 'O' when 3 then 'P' end as enum_value
from ce"""

SQL["decode_set"] = with_(CELLS) + """
select o_orderkey, set_mask,
       array_to_string(list_filter(['s0', 's1', 's2'], lambda v, i: (set_mask & (1 << (i - 1))) <> 0), ',') as set_value
from ce"""

SQL["decode_bit"] = """
select o_orderkey, cast(o_orderkey as decimal(20,0)) as bit_value from orders"""

SQL["decode_text"] = """
select c_custkey, c_name as name_text, length(c_name) as n_chars from customer"""


def lit(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _fixed():
    # Patterns and code tables are shared spec values; the oracle applies them with DuckDB's own functions.
    from ..functions.decode import LABEL_PATTERN
    from ..functions.position import VALID_POSITION
    from ..model import FIELD_TYPE_NAMES, UNSUPPORTED_FIELD_CODES
    from ..sources.feeds import FLAG_TYPES, KEY_KINDS, TYPE_CODES
    return dict(LABEL=lit(LABEL_PATTERN), VALID=lit(VALID_POSITION), NAMES=FIELD_TYPE_NAMES, UNSUP=UNSUPPORTED_FIELD_CODES,
                FLAG_TYPES=FLAG_TYPES, KEY_KINDS=KEY_KINDS, TYPE_CODES=TYPE_CODES)


X = _fixed()
P2 = "4294967296"
def _at(part: int, of: int) -> str:
    """Position key ``part / of`` of the way through the log."""
    return f"""(select (1 + a // w) * {P2} + a % w from (
  select max(log_pos) as w, ((max(file_no) - 1) * max(log_pos) + max(pos_key) % {P2}) * {part} // {of} as a from cl))"""


LOG = "select seq, log_file, log_pos, event_type from cl"

SQL["bounded_scan"] = with_(CHANGELOG) + LOG + f"""
where pos_key > {_at(3, 10)} and pos_key < {_at(7, 10)}"""

SQL["latest_position"] = with_(CHANGELOG) + """
select arg_max(log_file, pos_key) as log_file, arg_max(log_pos, pos_key) as log_pos,
       arg_max(concat(log_file, ':', cast(log_pos as varchar)), pos_key) as binlog
from cl"""

SQL["newest_position"] = with_(CHANGELOG) + """
select db, arg_max(label, pos_key) as newest, max(label) as newest_by_text
from (select db, concat(log_file, ':', cast(log_pos as varchar)) as label, pos_key from cl)
group by db"""

SQL["resume_after"] = with_(CHANGELOG) + LOG + f"""
where pos_key > {_at(1, 2)}"""

SQL["dedup_replay"] = with_(CHANGELOG) + f"""
select distinct seq, log_file, log_pos, event_type
from (select * from cl union all select * from cl where pos_key > {_at(1, 2)})"""

SQL["valid_position"] = with_(CHANGELOG) + f""",
cand as (
  select seq, 0 as variant, concat(log_file, ':', cast(log_pos as varchar)) as candidate from cl
  union all select seq, 1, concat(log_file, ':') from cl
  union all select seq, 2, log_file from cl)
select seq, variant, candidate, coalesce(regexp_full_match(candidate, {X['VALID']}), false) as valid,
       case when regexp_full_match(candidate, {X['VALID']})
            then cast(regexp_extract(candidate, '(\\d+):', 1) as bigint) * {P2}
                 + cast(regexp_extract(candidate, ':(\\d+)$', 1) as bigint) end as pos_key
from cand"""

FILT = "select seq, db, tbl, event_type from cl"
SQL["type_subscription"] = with_(CHANGELOG) + FILT + " where event_type in ('insert', 'delete')"
SQL["db_allow"] = with_(CHANGELOG) + FILT + " where db in ('app')"
SQL["table_include"] = with_(CHANGELOG) + FILT + \
    " where (db = 'app' and tbl = 't0') or (db = 'audit' and tbl = 't3')"
SQL["table_exclude"] = with_(CHANGELOG) + FILT + " where not (db = 'app' and tbl = 't0')"

SQL["flatten_insert"] = with_(ROW_IMAGES) + """
select l_orderkey, row_no, l_partkey, l_quantity, l_extendedprice from ri where op = 'insert'"""

SQL["flatten_delete"] = with_(ROW_IMAGES) + """
select l_orderkey, row_no, l_partkey, l_quantity, l_extendedprice from ri where op = 'delete'"""

SQL["pair_update"] = with_(ROW_IMAGES) + """
select l_orderkey, row_no // 2 as pair_no,
       max(case when row_no % 2 = 0 then row_no end) as before_row_no,
       max(case when row_no % 2 = 0 then l_partkey end) as before_l_partkey,
       max(case when row_no % 2 = 0 then l_quantity end) as before_l_quantity,
       max(case when row_no % 2 = 1 then row_no end) as after_row_no,
       max(case when row_no % 2 = 1 then l_partkey end) as after_l_partkey,
       max(case when row_no % 2 = 1 then l_quantity end) as after_l_quantity,
       case when count(*) = 2 then 'paired' else 'odd_tail' end as status
from ri where op = 'update' group by l_orderkey, row_no // 2"""

SQL["pair_update_long"] = SQL["pair_update"]

SQL["drop_empty"] = with_(CHANGELOG) + """
select log_file, log_pos, event_type,
       case event_type when 'update' then 2 when 'query' then 0 else 1 end as n_rows
from cl"""

SQL["query_passthrough"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, query, event_type, "primary",
       cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as "timestamp", true as before_empty, true as after_empty
from cl where event_type = 'query'"""

SQL["envelope_json"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type, query, "primary",
       b_id as before_id, b_value as before_value, b_props as before_props,
       a_id as after_id, a_value as after_value, a_props as after_props,
       cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as "timestamp",
       case when b_id is null then 0 else 3 end as before_keys,
       case when a_id is null then 0 else 3 end as after_keys
from cl"""

# What the statements of the feed do, by the rule that makes them (five kinds in turn).
DDL = """
ddl as (
  select seq, pos_key, row_no, 'ALTER' as ddl_kind, db, tbl,
         case (seq // 250) % 5 when 0 then ['c'] when 1 then ['c'] when 2 then ['c', 'd'] else [] end as added
  from cl where event_type = 'query')"""

# The catalogue: ``id`` and the added columns, in order.
CAT = """
cat as (
  select db, tbl, 1 as ordinal, 'id' as column_name, 'PRI' as column_key from (select distinct db, tbl from cl)
  union all
  select db, tbl, 3 + row_number() over (partition by db, tbl order by pos_key, row_no, letter) as ordinal,
         concat(letter, cast(seq as varchar)) as column_name,
         case when seq % 1000 = 0 then 'PRI' else '' end as column_key
  from (select *, unnest(added) as letter from ddl))"""

VERSIONS = f"""
dv as (
  select db, tbl, row_number() over w as version, pos_key as valid_from, lead(pos_key) over w as valid_to,
         3 + sum(len(added))
               over (partition by db, tbl order by pos_key, row_no rows unbounded preceding) as n_columns
  from ddl window w as (partition by db, tbl order by pos_key, row_no)),
tb as (select distinct db, tbl from cl),
vall as (
  select tb.db, tb.tbl, 0 as version, 0 as valid_from, min(dv.valid_from) as valid_to, 3 as n_columns
  from tb left join dv on tb.db = dv.db and tb.tbl = dv.tbl group by tb.db, tb.tbl
  union all select db, tbl, version, valid_from, valid_to, n_columns from dv)"""

SQL["ddl_table"] = with_(CHANGELOG, DDL) + "select seq, ddl_kind, db, tbl from ddl"

SQL["schema_intervals"] = with_(CHANGELOG, DDL, VERSIONS) + "select * from vall"

SQL["schema_asof"] = with_(CHANGELOG, DDL, VERSIONS) + """
select c.seq, c.db, c.tbl, v.version, v.n_columns
from cl c left join vall v
  on c.db = v.db and c.tbl = v.tbl and c.pos_key >= v.valid_from and (v.valid_to is null or c.pos_key < v.valid_to)
where c.event_type <> 'query'"""

SQL["primary_keys"] = with_(CHANGELOG, DDL, CAT) + """
select db, tbl, string_agg(column_name, ',' order by ordinal) as primary_keys,
       arg_max(column_name, ordinal) as "primary", count(*) as n_keys
from cat where column_key = 'PRI' group by db, tbl"""


def _list(values) -> str:
    return "[" + ", ".join(lit(v) if isinstance(v, str) else str(v) for v in values) + "]"


COLUMN_TYPES = f"""
ct as (
  select o_orderkey,
         concat(case when o_orderkey % 2 = 0 then 'enum' else 'set' end, '(''', o_orderstatus, ',',
                o_orderpriority, ''',''it''''s ', cast(o_custkey % 10 as varchar), ')'')') as column_type,
         list_extract({_list(X['FLAG_TYPES'])}, cast(o_orderkey % {len(X['FLAG_TYPES'])} + 1 as integer)) as flag_type,
         list_extract({_list(X['KEY_KINDS'])}, cast(o_orderkey % {len(X['KEY_KINDS'])} + 1 as integer)) as column_key,
         case when o_orderkey % 5 = 0 then 'auto_increment' else '' end as extra,
         list_extract({_list(X['TYPE_CODES'])}, cast(o_orderkey % {len(X['TYPE_CODES'])} + 1 as integer)) as type_code
  from orders)"""

SQL["enum_labels"] = with_(COLUMN_TYPES) + f"""
select o_orderkey, column_type,
       array_to_string(list_transform(regexp_extract_all(column_type, {X['LABEL']}, 1),
                                      lambda s: replace(s, '''''', '''')), '|') as labels,
       len(regexp_extract_all(column_type, {X['LABEL']}, 1)) as n_labels
from ct"""

SQL["column_flags"] = with_(COLUMN_TYPES) + """
select o_orderkey, flag_type, column_key, extra,
       lower(flag_type) = 'tinyint(1)' as is_bool, contains(lower(flag_type), 'unsigned') as unsigned,
       column_key <> '' as is_primary, contains(lower(extra), 'auto_increment') as auto_increment
from ct"""

_NAME_CASE = "case type_code " + " ".join(f"when {k} then {lit(v)}" for k, v in X["NAMES"].items()) + \
    " else cast(type_code as varchar) end"
_KNOWN = ", ".join(str(k) for k in X["NAMES"])
_UNSUP = ", ".join(str(k) for k in X["UNSUP"])

SQL["quarantine"] = with_(COLUMN_TYPES) + f""",
q as (
  select o_orderkey, type_code, {_NAME_CASE} as type_name,
         case when type_code in ({_UNSUP}) then concat('unimplemented type ', {_NAME_CASE})
              when type_code not in ({_KNOWN}) then concat('unknown field type ', cast(type_code as varchar))
         end as decode_error
  from ct)
select *, case when decode_error is null then 'ok' else 'quarantine' end as route from q"""

SQL["key_history"] = with_(CHANGELOG, KEYED) + """
select db, tbl, id, seq, event_type, row_number() over w as version, ev_ts as valid_from,
       lead(ev_ts) over w as valid_to
from kc window w as (partition by db, tbl, id order by pos_key, row_no)"""

SQL["key_order"] = with_(CHANGELOG, KEYED) + """
select db, tbl, id, seq, row_number() over (partition by db, tbl, id order by pos_key, row_no) as key_seq
from kc"""

SQL["changed_columns"] = with_(CHANGELOG) + """
select db, tbl, a_id as id, seq,
       concat_ws(',', case when b_id is distinct from a_id then 'id' end,
                      case when b_value is distinct from a_value then 'value' end,
                      case when b_props is distinct from a_props then 'props' end) as changed,
       cast(b_id is distinct from a_id as integer) + cast(b_value is distinct from a_value as integer)
         + cast(b_props is distinct from a_props as integer) as n_changed
from cl where event_type = 'update'"""

SQL["continuity"] = with_(CHANGELOG, KEYED) + """,
k as (
  select *, lag(a_id) over w as p_id, lag(a_value) over w as p_value, lag(a_props) over w as p_props
  from kc window w as (partition by db, tbl, id order by pos_key, row_no))
select db, tbl, id, seq, event_type, case when p_id is null then 'no_prior_image' else 'mismatch' end as status
from k
where b_id is not null
  and (p_id is null or b_id is distinct from p_id or b_value is distinct from p_value
       or b_props is distinct from p_props)"""

SQL["last_changes"] = with_(CHANGELOG) + LOG + """
where db = 'app' and tbl = 't0' order by pos_key desc, row_no desc limit 20"""

SQL["merge_feeds"] = with_(CHANGELOG) + LOG + f" where pos_key <= {_at(7, 10)} union " + LOG + \
    f" where pos_key >= {_at(4, 10)}"

SQL["feed_difference"] = with_(CHANGELOG) + LOG + \
    f" where pos_key <= {_at(7, 10)} and not (pos_key >= {_at(4, 10)})"

SQL["lookup_current"] = with_(CHANGELOG, KEYED) + """,
ranked as (
  select *, row_number() over (partition by db, tbl, id order by pos_key desc, row_no desc) as rn from kc),
cur as (select db, tbl, id, a_value as value, a_props as props from ranked where rn = 1 and event_type <> 'delete'),
keys as (select distinct db, tbl, id from kc)
select k.db, k.tbl, k.id, c.value, c.props, c.id is not null as found
from keys k left join cur c on k.db = c.db and k.tbl = c.tbl and k.id = c.id"""

SQL["rate_tumbling"] = with_(CHANGELOG) + """
select time_bucket(interval '10 minutes', ev_ts) as window_start,
       time_bucket(interval '10 minutes', ev_ts) + interval '10 minutes' as window_end, db, count(*) as n_changes
from cl group by all"""

SQL["rate_sliding"] = with_(CHANGELOG) + """
select ws as window_start, ws + interval '10 minutes' as window_end, db, count(*) as n_changes
from (select db, unnest([time_bucket(interval '5 minutes', ev_ts),
                         time_bucket(interval '5 minutes', ev_ts) - interval '5 minutes']) as ws from cl)
group by all"""

SQL["rate_session"] = with_(CHANGELOG) + """,
s as (
  select db, tbl, ev_ts, pos_key, row_no, lag(ev_ts) over w as p
  from cl window w as (partition by db, tbl order by ev_ts, pos_key, row_no)),
g as (
  select *, sum(case when p is null or ev_ts > p + interval '30 minutes' then 1 else 0 end)
              over (partition by db, tbl order by ev_ts, pos_key, row_no rows unbounded preceding) as sid
  from s)
select db, tbl, min(ev_ts) as session_start, max(ev_ts) + interval '30 minutes' as session_end,
       count(*) as n_changes
from g group by db, tbl, sid"""

RAW = f"""
ev as (
  select seq * 4 as ordinal, 4 as type_code, 0 as ts_secs, 19 + 4 + 8 + strlen(log_file) as event_size,
         0 as log_pos, 32 as flags, log_file, seq, db, query, event_type from cl where seq % 1000 = 0
  union all
  select seq * 4 + 1, 33, cast(floor(epoch_us(ev_ts) / 1000000) as bigint), 19 + 4 + 25, log_pos + 1, 0,
         log_file, seq, db, query, event_type from cl
  union all
  select seq * 4 + 2, case event_type when 'query' then 2 when 'insert' then 30 when 'update' then 31 else 32 end,
         cast(floor(epoch_us(ev_ts) / 1000000) as bigint),
         case when event_type = 'query' then 19 + 4 + 13 + strlen(db) + 1 + strlen(query) else 19 + 4 + 8 end,
         log_pos, (seq * 37) % 2048, log_file, seq, db, query, event_type from cl
  union all
  select seq * 4 + 3, 16, cast(floor(epoch_us(ev_ts) / 1000000) as bigint), 19 + 4 + 8, log_pos + 2, 0,
         log_file, seq, db, query, event_type from cl where event_type <> 'query')"""

SQL["header_split"] = with_(CHANGELOG, RAW) + """
select 'srv-2' as source, ordinal, ts_secs, type_code, case when db = 'app' then 2 else 3 end as server_id,
       event_size, log_pos, flags,
       true as checksum_ok, true as size_ok
from ev"""


def _event_name_case():
    from ..model import EVENT_NAMES
    return "case type_code " + " ".join(f"when {k} then {lit(v)}" for k, v in EVENT_NAMES.items()) + \
        " else cast(type_code as varchar) end"


SQL["event_names"] = with_(CHANGELOG, RAW) + f"""
select ordinal, type_code, {_event_name_case()} as event_name,
       case when type_code in (20, 23, 30) then 'insert' when type_code in (21, 24, 31) then 'update'
            when type_code in (22, 25, 32) then 'delete' when type_code = 2 then 'query'
            else cast(type_code as varchar) end as operation
from ev where type_code not in (27, 28, 33, 34, 35)"""


def _flag_list():
    from ..model import FLAG_NAMES
    return "[" + ", ".join(lit(n) for n in FLAG_NAMES) + "]"


SQL["flag_names"] = with_(CHANGELOG, RAW) + f"""
select ordinal, flags,
       array_to_string(list_concat(list_filter({_flag_list()}, lambda n, i: (flags & (1 << (i - 1))) <> 0),
                                   case when flags & 64512 <> 0 then ['UNKNOWN_0x' || lower(hex(flags & 64512))]
                                        else [] end), ',') as flag_names
from ev"""

SQL["query_body_split"] = with_(CHANGELOG) + """
select seq * 4 + 2 as ordinal, seq as proxy_id, 0 as exec_time, 0 as error_code, db as schema, query
from cl where event_type = 'query'"""

SQL["log_file_fill"] = with_(CHANGELOG, RAW) + "select ordinal, type_code, log_file from ev"

SQL["stream_envelope"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type, query, "primary",
       b_id as before_id, b_value as before_value, b_props as before_props,
       a_id as after_id, a_value as after_value, a_props as after_props,
       cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as "timestamp", cast(ev_ts as date) as dt
from cl"""

SQL["stream_latest"] = SQL["latest_state"]

SQL["change_table"] = SQL["stream_envelope"]

SQL["ordered_delivery"] = with_(CHANGELOG, KEYED) + """
select db, tbl, id, count(*) as n_changes, cast(0 as bigint) as n_out_of_order from kc group by db, tbl, id"""

SQL["db_ignore"] = with_(CHANGELOG) + FILT + " where db not in ('audit')"

SQL["server_filter"] = with_(CHANGELOG, RAW) + """
select ordinal, type_code, 3 as server_id from ev where db <> 'app'"""

SQL["known_tables"] = with_(CHANGELOG, DDL) + FILT + """
where (db, tbl) in (select db, tbl from ddl)"""

SQL["attach_primary"] = with_(CHANGELOG, DDL, CAT) + """,
pk as (
  select db, tbl, string_agg(column_name, ',' order by ordinal) as key_columns,
         arg_max(column_name, ordinal) as key_primary
  from cat where column_key = 'PRI' group by db, tbl)
select cl.seq, cl.db, cl.tbl, pk.key_columns, pk.key_primary
from cl left join pk on cl.db = pk.db and cl.tbl = pk.tbl"""

SQL["publish_messages"] = with_(CHANGELOG) + """
select concat(db, '.', tbl, ':', coalesce(cast(coalesce(a_id, b_id) as varchar), '')) as key,
       concat(log_file, ':', cast(log_pos as varchar)) as binlog, event_type, a_value as after_value
from cl"""

SQL["name_columns"] = """
select l_orderkey as orderkey, l_partkey as partkey, l_suppkey as suppkey, cast(l_linenumber as bigint) as linenumber
from lineitem"""

SQL["decode_blob"] = """
select c_custkey, to_base64(encode(c_name)) as blob_b64, octet_length(encode(c_name)) as n_bytes from customer"""

SQL["envelope_variant"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type,
       coalesce(a_id, b_id) as "key", a_value as amount,
       case when event_type in ('insert', 'update') then 3 else 0 end as n_after_fields,
       cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as "timestamp", false as malformed
from cl
union all
select case when garbled then null else concat('shop-bin.000001:', cast(l_orderkey * 8 + l_linenumber as varchar)) end,
       case when garbled then null else 'shop' end, case when garbled then null else 'lineitem' end,
       case when garbled then null else 'insert' end, case when garbled then null else l_orderkey end,
       case when garbled then null else l_quantity end, case when garbled then null else 4 end,
       case when garbled then null else cast(floor(epoch_us(l_shipdate) / 1000000) as bigint) end, garbled
from (select *, l_linenumber = 7 as garbled from lineitem)"""

SQL["table_scan"] = with_(CHANGELOG) + f"""
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type, pos_key from cl
where db = 'app' and tbl = 't0' and pos_key > {_at(3, 10)} and pos_key < {_at(7, 10)}"""

SQL["stream_progress"] = with_(CHANGELOG) + """
select 'stream' as source, arg_max(log_file, pos_key) as log_file, arg_max(log_pos, pos_key) as log_pos,
       arg_max(concat(log_file, ':', cast(log_pos as varchar)), pos_key) as binlog
from cl where event_type <> 'query'"""

SQL["stream_rate"] = SQL["rate_tumbling"]

SQL["stream_dedup"] = with_(CHANGELOG) + "select log_file, log_pos, event_type from cl"

# Sessions over the whole seconds a message carries (its ``timestamp`` field).
SQL["stream_sessions"] = with_(CHANGELOG) + """,
t as (
  select db, tbl, cast(floor(epoch_us(ev_ts) / 1000000) as bigint) as s, pos_key, row_no from cl),
p as (
  select *, lag(s) over (partition by db, tbl order by s, pos_key, row_no) as ps from t),
g as (
  select *, sum(case when ps is null or s > ps + 1800 then 1 else 0 end)
              over (partition by db, tbl order by s, pos_key, row_no rows unbounded preceding) as sid
  from p)
select db, tbl, min(s) as session_start_s, max(s) + 1800 as session_end_s, count(*) as n_changes
from g group by db, tbl, sid"""

SQL["latest_state_partial"] = with_(CHANGELOG) + """,
p as (
  select *, coalesce(a_id, b_id) as id,
         case when event_type in ('insert', 'update') then 7
              - case when event_type = 'update' and seq % 3 = 0 then 4 else 0 end
              - case when event_type = 'update' and seq % 5 = 0 then 2 else 0 end
              else 0 end as mask
  from cl where event_type <> 'query')
select db, tbl, id,
       arg_max_null(a_value, case when mask & 2 <> 0 then pos_key end) as value,
       arg_max_null(a_props, case when mask & 4 <> 0 then pos_key end) as props,
       arg_max(event_type, pos_key) as last_op, count(*) as n_changes
from p group by db, tbl, id
having arg_max(event_type, pos_key) <> 'delete'"""

SQL["stream_latest_partial"] = SQL["latest_state_partial"]

ROW_CHANGES = f"""
ev as (
  select l_orderkey, op, row_no // 8 as chunk, row_no % 8 as i, l_partkey as id, l_extendedprice as value,
         cast(row_no as varchar) as props from ri),
rc as (
  select concat('mysql-bin.', lpad(cast(l_orderkey // 20000 + 1 as varchar), 6, '0'), ':',
                cast(4 + (l_orderkey % 20000) * 1000 + chunk * 10 as varchar)) as binlog,
         (l_orderkey // 20000 + 1) * {P2} + 4 + (l_orderkey % 20000) * 1000 + chunk * 10 as pos_key,
         op as event_type, case when op = 'update' then i // 2 else i end as row_no,
         max(case when op = 'delete' or op = 'update' and i % 2 = 0 then {{'id': id, 'value': value, 'props': props}} end) as b,
         max(case when op = 'insert' or op = 'update' and i % 2 = 1 then {{'id': id, 'value': value, 'props': props}} end) as a
  from ev group by all)"""

SQL["event_envelopes"] = with_(ROW_IMAGES, ROW_CHANGES) + """
select binlog, row_no, event_type, b.id as before_id, b.props as before_props, a.id as after_id, a.props as after_props
from rc"""

SQL["stream_dedup_rows"] = with_(ROW_IMAGES, ROW_CHANGES) + "select binlog, row_no, event_type from rc"

SQL["stream_latest_rows"] = with_(ROW_IMAGES, ROW_CHANGES) + """,
last as (
  select coalesce(a.id, b.id) as id, arg_max({'op': event_type, 'value': a.value, 'props': a.props}, (pos_key, row_no)) as w,
         count(*) as n_changes from rc group by 1)
select id, w.value as value, w.props as props, w.op as last_op, n_changes from last where w.op <> 'delete'"""

SQL["stream_publish"] = with_(CHANGELOG) + """
select concat(db, '.', tbl, ':', coalesce(cast(coalesce(a_id, b_id) as varchar), '')) as key,
       concat(log_file, ':', cast(log_pos as varchar)) as binlog, event_type, a_value as after_value
from cl where seq % 97 <> 0 and seq % 89 <> 0"""

SQL["stream_dead_letters"] = with_(CHANGELOG) + """
select case when seq % 97 = 0 then 'malformed message' else 'no log position' end as reason, count(*) as n_messages
from cl where seq % 97 = 0 or seq % 89 = 0 group by 1"""

SQL["stream_publish_progress"] = with_(CHANGELOG) + """
select 'stream' as source, arg_max(log_file, pos_key) as log_file, arg_max(log_pos, pos_key) as log_pos,
       arg_max(concat(log_file, ':', cast(log_pos as varchar)), pos_key) as binlog
from cl where seq % 97 <> 0 and seq % 89 <> 0"""

SQL["decode_text_errors"] = """
select c_custkey, case when c_custkey % 3 = 2 then c_name end as utf8,
       case when c_custkey % 3 <> 2 then 'malformed utf8mb4 text' end as utf8_error,
       case c_custkey % 3 when 0 then 'ÿþ' when 1 then '€' else c_name end as latin1,
       case when c_custkey % 3 = 2 then c_name end as ascii, 'unknown charset koi9' as koi9_error
from customer"""

SQL["decode_time2_fraction"] = """
select o_orderkey, (case when o_orderkey % 2 = 0 then -1 else 1 end)
       * ((o_orderkey % 3000000) * 1000000 + (o_orderkey * 7919) % 1000000) as time_us from orders"""


# ---- the evolving log: statement j (from 1) of a table, by the rules of feeds.evolving_log -------
EVOLVING = """
ev_w as (
  select event_id, user_id, event_type as et, value, user_id % 4 as g, event_id % 50 = 25 as is_ddl,
         sum(case when event_id % 50 = 25 then 1 else 0 end) over (partition by user_id % 4 order by event_id) as j
  from events),
ev as (
  select event_id as seq, g, j::bigint as j, is_ddl, value,
         (event_id // 1000 + 1) * 4294967296 + 4 + (event_id % 1000) * 120 as pos_key,
         case when user_id % 2 = 0 then 'app' else 'audit' end as db,
         't' || g || case when (case when is_ddl then (j - 1) % 12 else j % 12 end) in (10, 11) then 'r' else '' end as tbl,
         case when is_ddl then 'query' when et = 'signup' then 'insert' when et = 'error' then 'delete' else 'update' end as event_type
  from ev_w where is_ddl or j = 0 or j % 36 <> 0)"""

# names of a life: its first, two for each rename away (one of them passing), one for each rename back
SQL["table_identity"] = f"""
with {EVOLVING},
life as (select *, case when j = 0 then 0 else (j - 1) // 36 end as l from ev),
born as (
  select g, l, case when l = 0 then 0 else min(pos_key) end as born, max(j) as last_j,
         1 + 2 * count(*) filter (is_ddl and (j - 1) % 12 = 9) + count(*) filter (is_ddl and (j - 1) % 12 = 11 and j % 36 <> 0) as n
  from life group by g, l)
select seq, db, tbl, event_type, born::bigint as born, db as first_db, 't' || g as first_tbl, db as last_db,
       't' || g || case when last_j % 12 in (10, 11) or last_j > 0 and last_j % 36 = 0 then 'r' else '' end as last_tbl, n::bigint as n_names
from life join born using (g, l)
"""


def _evolve() -> str:
    """State ``s`` after statement k (from 0) by list operations; s2 and s3 lack the column that moves or goes."""
    def place(state: str, at: str, new: str) -> str:
        p = f"list_position([x.n for x in {state}], {at})"
        return f"list_concat(list_concat({state}[:{p}], [{new}]), {state}[{p} + 1:])"

    def col(n: str, t: str, k: str = "''") -> str:
        return f"{{'n': {n}, 't': {t}, 'k': {k}}}"

    def keyed(k: str) -> str:
        return f"[{{'n': x.n, 't': x.t, 'k': case when x.n = 'value' then {k} else x.k end}} for x in s]"

    enum = "'enum(''new'',''it''''s, so'')'"
    more = "'enum(''new'',''it''''s, so'',''done'')'"
    created = ", ".join([col("'id'", "'bigint'", "'PRI'"), col("'a' || c", "'int unsigned'"), col("'value'", "'double'"), col("'props'", "'varchar(64)'")])
    return f"""case
      when k > 0 and k % 36 = 0 then [{created}]
      when k % 36 = 35 then s
      when k % 12 = 0 then {place("s", "'id'", col("'a' || c", "'int unsigned'"))}
      when k % 12 = 1 then list_concat([{col("'b' || c", enum)}], {keyed("'MUL'")})
      when k % 12 = 2 then list_concat(s, [{col("'c' || c", "'varchar(20)'")}, {col("'d' || c", "'decimal(10,2)'")}])
      when k % 12 = 3 then [{{'n': x.n, 't': case when x.n = 'b' || c then {more} else x.t end, 'k': x.k}} for x in s]
      when k % 12 = 4 then {place("s2", "'b' || c", col("'cc' || c", "'varchar(40)'"))}
      when k % 12 = 5 then [{{'n': case when x.n = 'd' || c then 'dd' || c else x.n end, 't': x.t, 'k': x.k}} for x in s]
      when k % 12 = 6 then {place("s3", "'cc' || c", col("'e' || c", "'bigint unsigned'"))}
      when k % 12 = 7 then list_concat([{col("'dd' || c", "'decimal(12,4)'")}], [x for x in s if x.n <> 'dd' || c])
      when k % 12 = 8 then [{{'n': x.n, 't': x.t, 'k': case when x.n = 'e' || c then 'UNI' else x.k end}} for x in s]
      when k % 12 = 10 then [x for x in {keyed("''")} if x.n <> 'dd' || c]
      else s end"""


COLUMNS = EVOLVING + f""",
ddl as (select g, j - 1 as k, (j - 1) // 12 as c, pos_key, db from ev where is_ddl),
st as (
  select distinct g, -1::bigint as k, [{{'n': 'id', 't': 'bigint', 'k': 'PRI'}}, {{'n': 'value', 't': 'double', 'k': ''}}, {{'n': 'props', 't': 'varchar(64)', 'k': ''}}] as s,
         0::bigint as pos_key, db from ev
  union all
  select g, k, {_evolve()} as s, pos_key::bigint, db
  from (select ddl.g, ddl.k, ddl.c, ddl.pos_key, ddl.db, st.s, [x for x in st.s if x.n <> 'c' || ddl.c] as s2, [x for x in st.s if x.n <> 'a' || ddl.c] as s3
        from st join ddl on ddl.g = st.g and ddl.k = st.k + 1)),
ver as (
  select g, k, s, db, case when k < 36 then k + 1 else k % 36 end as version, pos_key as valid_from, lead(pos_key) over (partition by g order by k) as valid_to,
         't' || g || case when k % 12 in (9, 10) then 'r' else '' end as tbl
  from st),
cols as (
  select db, tbl, version::bigint as version, ordinal, s[ordinal].n as name, s[ordinal].t as type, s[ordinal].k as key, valid_from, valid_to
  from (select *, unnest(range(1, len(s) + 1))::int as ordinal from ver where k < 0 or k % 36 <> 35))"""

SQL["schema_columns"] = f"with recursive {COLUMNS} select * from cols"

SQL["decode_by_schema"] = f"""
with recursive {COLUMNS},
cell as (
  select seq, db, tbl, pos_key, o as ordinal, case when seq % 11 <> 0 then (seq * 7 + o) % 5 - 1 end as stored
  from (select *, unnest(range(1, 9))::int as o from ev where not is_ddl)),
j as (
  select seq, cell.tbl, cell.ordinal, stored, name, type,
         case when type like 'enum%' then [replace(x, '''''', '''') for x in regexp_extract_all(type, '''((?:[^'']|'''')*)''', 1)] end as labels
  from cell left join cols on cols.db = cell.db and cols.tbl = cell.tbl and cols.ordinal = cell.ordinal
       and pos_key >= valid_from and (valid_to is null or pos_key < valid_to)),
d as (
  select *, case when type in ('bigint') then cast(stored as varchar)
                 when type = 'int unsigned' then cast(case when stored < 0 then stored + 4294967296 else stored end as varchar)
                 when type = 'bigint unsigned' then cast(case when stored < 0 then stored + 18446744073709551616::hugeint else stored end as varchar)
                 when labels is not null then case when stored = 0 then '' when stored > 0 then labels[stored] end end as v
  from j)
select seq, tbl, ordinal, stored, name, type, type like '% unsigned' as unsigned, v as value,
       case when stored is null then null when type is null then 'no such column'
            when type not like 'bigint%' and type <> 'int unsigned' and labels is null then 'no decoder for ' || regexp_extract(type, '^[a-z]+')
            when v is null then 'no value of enum: ' || stored end as error
from d
"""

SQL["decode_decimal_bytes"] = """
with a as (
  select o_orderkey, (o_orderkey % 65 + 1)::int as p, least((o_orderkey // 65) % 31, o_orderkey % 65 + 1)::int as s, (o_orderkey * 40503)::varchar as t from orders),
b as (select *, lpad(right(t || reverse(t) || t, p), p, '0') as g from a),
c as (select *, regexp_replace(left(g, p - s), '^0+', '') as w, right(g, s) as f from b)
select o_orderkey, p, s,
       (((p - s) // 9) * 4 + ((p - s) % 9 + 1) // 2 + (s // 9) * 4 + (s % 9 + 1) // 2)::int as n_bytes,
       case when o_orderkey % 3 = 0 and regexp_matches(g, '[1-9]') then '-' else '' end || case when w = '' then '0' else w end
       || case when s > 0 then '.' || f else '' end as value
from c
"""

SQL["decode_float"] = """
with a as (
  select o_orderkey as k, case when o_orderkey % 2 = 1 then -1.0::double else 1.0::double end as sign from orders),
b as (
  select k, case when k % 150 = 0 then sign * 0.0 when k % 50 <> 0 then sign * (1.0::double + (k * 7919 % 8388608) / 8388608.0::double) * pow(2.0::double, 117 + k % 30 - 127) end as f_value,
         case when k % 150 = 0 then sign * 0.0
              when k % 50 <> 0 then sign * (1.0::double + (k * 2654435761 % 4503599627370496) / 4503599627370496.0::double) * pow(2.0::double, 1003 + k % 60 - 1023) end as d_value,
         case when k % 150 = 50 then 'nan' when k % 150 = 100 then case when sign < 0 then '-inf' else 'inf' end end as odd
  from a)
select k as o_orderkey, f_value, d_value, odd as f_odd, odd as d_odd from b
"""

SQL["stream_from_position"] = with_(CHANGELOG) + f"""
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, event_type, pos_key = (select max(pos_key) from cl) as is_newest
from cl where pos_key > {_at(1, 2)}"""
SQL["stream_reordered"] = SQL["ordered_delivery"]
SQL["stream_rate_late"] = SQL["rate_tumbling"]

SQL["stream_change_table_compacted"] = SQL["stream_envelope"]

SQL["envelope_inferred"] = with_(CHANGELOG) + """
select concat(log_file, ':', cast(log_pos as varchar)) as binlog, db, tbl, event_type, coalesce(a_id, b_id) as "key", a_value as amount, null::double as tax
from cl
union all
select concat('shop-bin.000001:', cast(l_orderkey * 8 + l_linenumber as varchar)), 'shop', 'lineitem', 'insert', l_orderkey,
       case when late then l_quantity + 0.25 else cast(trunc(l_quantity) as bigint) end, case when late then l_tax end
from (select *, l_orderkey * 2 > (select max(l_orderkey) from lineitem) as late from lineitem)"""

SQL["raw_quarantine"] = with_(CHANGELOG, RAW) + f"""
select case when ordinal % 71 = 0 then 'torn header' when ordinal % 89 = 0 then 'wrong size' when ordinal % 53 = 0 then 'bad checksum'
            else {_event_name_case()} end as what, count(*) as n_events, min(ordinal) as first_ordinal
from ev group by 1"""

SQL["stream_publish_sinks"] = with_(CHANGELOG) + """
select sink, event_type, count(*) as n_messages
from (select event_type, unnest(['callback', 'json', 'text']) as sink from cl where seq % 97 <> 0 and seq % 89 <> 0) group by all"""

SQL["primary_keys_versions"] = f"""
with recursive {COLUMNS}
select db, tbl, version, valid_from, valid_to, coalesce(string_agg(name, ',' order by ordinal) filter (key = 'PRI'), '') as primary_keys,
       arg_max(name, ordinal) filter (key = 'PRI') as "primary", (count(*) filter (key = 'PRI'))::int as n_keys, count(*) as n_columns
from cols group by all"""
