"""The catalogue's queries in SQL over the same tables, written independently of Spark.

Queries SQL cannot express (curve arithmetic behind addresses, approximate
counts) have no entry here and are covered by tests.
"""

from __future__ import annotations

from ..functions.encoding import BASE58_ALPHABET, BECH32_ALPHABET, BECH32_GENERATOR
from ..sources.tables import KEYS, NO_KEY

_CHANGES = """
changes as (
  select * from (
    select event_id + 1 as ts, (event_id + 1)::int as height, 0 as tx_pos,
           case when event_type in ('purchase', 'error') then -1 else 1 end * round(value * 100)::bigint as value,
           'u' || user_id as address
    from events)
  where value <> 0)
"""

_NETTED = _CHANGES + """,
netted as materialized (
  select ts, height, tx_pos, sum(value)::bigint as value, address from changes group by all having sum(value) <> 0)
"""

_ENTRIES = """
lines as materialized (
  select sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice * 100)::bigint,
                          round(l_discount * 100)::bigint, date_diff('day', date '1970-01-01', l_shipdate::date))) as tx_hash,
         l_linenumber::bigint as out_index, 's' || l_suppkey as address,
         round(l_extendedprice * 100)::bigint as sat,
         date_diff('day', date '1995-01-01', o_orderdate::date)::int as created,
         date_diff('day', date '1995-01-01', l_shipdate::date)::int as spent,
         (100000 + l_partkey % 50)::int as spend_pos
  from lineitem join orders on l_orderkey = o_orderkey),
entries as materialized (
  select created::bigint * 86400 as ts, created as height, 1 as tx_pos, tx_hash, out_index, false as is_input,
         address, sat as value
  from lines
  union all
  select spent::bigint * 86400, spent, spend_pos, tx_hash, out_index, true, null, null from lines)
"""

_MATCHED = (
    _ENTRIES
    + """,
seen as materialized (
  select *, lag(not is_input) over w as live, lag(address) over w as owner, lag(value) over w as amount
  from entries
  window w as (partition by tx_hash, out_index order by height, tx_pos, not is_input)),
matched as (
  select ts, height, tx_pos, case when is_input then -amount else value end as value,
         case when is_input then owner else address end as address
  from seen where not is_input or coalesce(live, false))
"""
)

_NET = (
    _MATCHED
    + """,
net as (
  select ts, height, tx_pos, sum(value)::bigint as value, address
  from matched group by all having sum(value) <> 0)
"""
)


def _legs(percent: str) -> str:
    return f"""
paid as materialized (
  select (l_orderkey // 100)::int as height, 1500000000 + (l_orderkey // 100) * 600 as ts,
         (l_orderkey % 100 + 1)::int as tx_pos, 't' || l_orderkey as tx_hash, l_partkey, l_suppkey, l_linenumber,
         round(l_extendedprice * 100)::bigint as sat, {percent} as percent
  from lineitem),
legs as materialized (
  select height, ts, tx_pos, tx_hash, false as is_coinbase, true as is_input, 'p' || l_partkey as address,
         'P2PKH' as kind, sat as value, l_linenumber, l_partkey, l_suppkey, sat, percent
  from paid
  union all
  select height, ts, tx_pos, tx_hash, false, false, 's' || l_suppkey,
         case when l_suppkey % 2 = 0 then 'P2PKH' else 'P2SH' end, (sat * (100 - percent)) // 100,
         l_linenumber, l_partkey, l_suppkey, sat, percent
  from paid),
coinbases as (
  select (o_orderkey // 100)::int as height, 1500000000 + (o_orderkey // 100) * 600 as ts, 0 as tx_pos,
         'b' || (o_orderkey // 100) as tx_hash, true as is_coinbase, false as is_input, 'c' || o_custkey as address,
         'P2WPKH' as kind, 5000000000 + round(o_totalprice * 100)::bigint as value, o_orderkey % 100 as entry_idx
  from orders),
all_legs as materialized (
  select height, ts, tx_pos, tx_hash, is_coinbase, is_input, address, kind, value from legs
  union all
  select height, ts, tx_pos, tx_hash, is_coinbase, is_input, address, kind, value from coinbases)
"""


_TOTALS = """
totals as materialized (
  select height, ts, tx_pos, tx_hash, is_coinbase,
         coalesce(sum(value) filter (is_input), 0)::bigint as input_value,
         coalesce(sum(value) filter (not is_input), 0)::bigint as output_value
  from all_legs group by all),
fees as (
  select height, ts, tx_pos, tx_hash, input_value, output_value, input_value - output_value as fee
  from totals where not is_coinbase),
minting as materialized (
  select height, ts,
         coalesce(sum(input_value - output_value) filter (not is_coinbase), 0)::bigint as fees,
         coalesce(sum(output_value) filter (is_coinbase), 0)::bigint as reward,
         max(tx_hash) filter (is_coinbase) as coinbase_hash, count(*) as txs
  from totals group by all)
"""


_DISCOUNT = "round(l_discount * 100)::bigint"
_LEGS = f"{_legs(_DISCOUNT)}, {_TOTALS}"
_TAXED_LEGS = f"{_legs(f'({_DISCOUNT} - round(l_tax * 100)::bigint)')}, {_TOTALS}"

_MODELLED = """
balanced as (
  select height, ts, tx_pos, tx_hash, address, kind, case when is_input then -value else value end as v from all_legs
  union all
  select height, ts, tx_pos, tx_hash, 'fee', 'virtual', fee from fees
  union all
  select height, ts, 0, coinbase_hash, 'fee', 'virtual', -fees from minting where coinbase_hash is not null
  union all
  select height, ts, 0, coinbase_hash, 'mint', 'virtual', fees - reward from minting where coinbase_hash is not null),
accounts as materialized (
  select height, ts, tx_pos, tx_hash, address, kind, sum(v)::bigint as v
  from balanced group by all having sum(v) <> 0),
placed as materialized (
  select *, sum(abs(v)) over (partition by height, ts, tx_pos, tx_hash, v > 0 order by abs(v) desc, address, kind
                              rows unbounded preceding)::bigint as hi
  from accounts),
transfers as (
  select height, ts, tx_pos, tx_hash, p.address as "from", p.kind as from_kind, r.address as "to", r.kind as to_kind,
         least(p.hi, r.hi) - greatest(p.hi + p.v, r.hi - r.v) as amount
  from (select * from placed where v < 0) p join (select * from placed where v > 0) r
       using (height, ts, tx_pos, tx_hash)
  where p.hi + p.v < r.hi and r.hi - r.v < p.hi)
"""
_TRANSFERS = f"{_LEGS}, {_MODELLED}"

# One step of the recursion takes one segment off or puts one on; all addresses advance together.
_FOLD = """
ch as (
  select address, row_number() over (partition by address order by height, tx_pos) as seq, ts, height, tx_pos, value
  from netted),
r as (
  select address, seq, case when value < 0 then -value else 0 end as rem, 0::bigint as last_ots, 0 as nonce,
         []::struct(n int, o bigint, v bigint)[] as st, ts, height, tx_pos, value as val,
         null::int as esign, null::int as en, null::bigint as eo, null::bigint as ev, null::bigint as ets,
         null::int as eheight, null::int as epos
  from ch where seq = 1
  union all
  select s.address,
    case when act <> 'pop' then s.seq + 1 else s.seq end,
    case when act <> 'pop' then (case when nx.value < 0 then -nx.value else 0 end) else s.rem - top.v end,
    case when act = 'pop' then top.o else 0 end,
    case when act in ('push', 'liab', 'remn') then s.nonce + 1 else s.nonce end,
    case act when 'pop' then s.st[:len(s.st) - 1]
             when 'push' then list_append(s.st, {'n': s.nonce + 1, 'o': s.ts, 'v': s.val})
             when 'liab' then list_append(s.st, {'n': s.nonce + 1, 'o': 0::bigint, 'v': -s.rem})
             when 'remn' then list_append(s.st, {'n': s.nonce + 1, 'o': s.last_ots, 'v': -s.rem})
             else s.st end,
    case when act <> 'pop' then nx.ts else s.ts end,
    case when act <> 'pop' then nx.height else s.height end,
    case when act <> 'pop' then nx.tx_pos else s.tx_pos end,
    case when act <> 'pop' then nx.value else s.val end,
    case act when 'pop' then -1 when 'skip' then null else 1 end,
    case act when 'pop' then top.n when 'skip' then null else s.nonce + 1 end,
    case act when 'pop' then top.o when 'push' then s.ts when 'liab' then 0 when 'remn' then s.last_ots end,
    case act when 'pop' then top.v when 'push' then s.val when 'liab' then -s.rem when 'remn' then -s.rem end,
    s.ts, s.height, s.tx_pos
  from (select *, st[len(st)] as top,
               case when val >= 0 then 'push' when rem > 0 and len(st) > 0 then 'pop'
                    when rem > 0 then 'liab' when rem < 0 then 'remn' else 'skip' end as act
        from r where val is not null) s
  left join ch nx on nx.address = s.address and nx.seq = s.seq + 1),
stack as (
  select esign as sign, ets as ts, eheight as height, epos as tx_pos, en as nonce, eo as ots, address, ev as value
  from r where esign is not null)
"""
_STACK = f"recursive {_NETTED}, {_FOLD}"

_HEADERS = """
headers as (
  select event_id::int as height, epoch(date_trunc('second', ts))::bigint - (event_id % 7) * 600 as raw_ts from events)
"""

_DATED = """
dated as (
  select ts, 'u' || user_id as address from events where round(value * 100)::bigint <> 0)
"""


def _processed(source: str) -> str:
    return f"""
        select ts, height, tx_pos,
               coalesce(to_json(list({{'address': address, 'value': value}} order by entry_idx)
                                filter (is_input))::varchar, '[]') as inputs,
               coalesce(to_json(list({{'address': address, 'value': value}} order by entry_idx)
                                filter (not is_input))::varchar, '[]') as outputs
        from {source} group by 1, 2, 3
        union all
        select ts, height, txs::int, to_json([{{'address': 'mint', 'value': reward - fees}}])::varchar, '[]'
        from minting"""


def _string_hash(text: str) -> str:
    units = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    unsigned = f"list_reduce(list_prepend(0::bigint, {units}), lambda a, b: (a * 31 + b) & 4294967295)"
    return f"(case when {unsigned} >= 2147483648 then {unsigned} - 4294967296 else {unsigned} end)"


def _shard(text: str) -> str:
    hashed = _string_hash(text)
    floored = f"floor({hashed} / 4.0)::bigint"
    return f"((({hashed}) % 4 + 4) % 4)::int as topic, ((({floored}) % 6 + 6) % 6)::int as partition"


_SCRIPTS = """
scripts as materialized (
  select c_custkey,
         case c_custkey % 8
           when 0 then '76A914' || d[:40] || '88AC' when 1 then '2102' || d || 'AC' when 2 then 'A914' || d[:40] || '87'
           when 3 then '0014' || d[:40] when 4 then '0020' || d when 5 then '6A20' || d
           when 6 then '512102' || d || '2103' || d || '52AE' else '76A914' || d[:40] || '88ACAC' end as script
  from (select c_custkey, upper(sha256(c_name)) as d from customer))
"""


def _le(value: str, size: int) -> str:
    digits = f"lpad(to_hex(({value})::bigint), {2 * size}, '0')"
    return "(" + " || ".join(f"substr({digits}, {2 * i - 1}, 2)" for i in range(size, 0, -1)) + ")"


def _coinbase(h: str) -> str:
    return (
        f"'0100000001{'00' * 32}FFFFFFFF04' || {_le(h, 4)} || 'FFFFFFFF01' || {_le(h + ' + 5000000000', 8)} || "
        f"'1976A914' || upper(sha256((({h}) % 97)::varchar))[:40] || '88AC00000000'"
    )


def _txid(digits: str) -> str:
    return f"upper(sha256(from_hex(sha256(from_hex({digits})))))"


def _shown(txid: str) -> str:
    return "lower(" + " || ".join(f"substr({txid}, {2 * i - 1}, 2)" for i in range(32, 0, -1)) + ")"


_LIMBS = 7  # 32-bit digits of the 25 bytes of a Base58Check body
_FIVE_DIGITS = 58**5


def _base58(source: str, body: str) -> str:
    """CTEs from ``source`` (script, ``body`` in hex) to ``base58_text`` (script, text).

    Seven long divisions by 58**5 give five digits each.
    """
    limbs = ", ".join(
        f"('0x' || substr(lpad({body}, {8 * _LIMBS}, '0'), {8 * i + 1}, 8))::bigint as l{i}" for i in range(_LIMBS)
    )
    ctes = [f"d0 as (select script, {body} as body, {limbs}, '' as digits from {source})"]
    for step in range(1, 8):
        parts, rest = [], "0"
        for i in range(_LIMBS):
            parts.append(f"({rest} * 4294967296 + l{i}) as v{i}, v{i} // {_FIVE_DIGITS} as q{i}")
            rest = f"(v{i} % {_FIVE_DIGITS})"
        chars = " || ".join(f"substr('{BASE58_ALPHABET}', ({rest} // {58**k}) % 58 + 1, 1)" for k in range(4, -1, -1))
        quotients = ", ".join(f"q{i} as l{i}" for i in range(_LIMBS))
        ctes.append(
            f"e{step} as (select *, {', '.join(parts)}, {chars} || digits as more from d{step - 1}), "
            f"d{step} as (select script, body, {quotients}, more as digits from e{step})"
        )
    ctes.append(
        "base58_text as (select script, repeat('1', (length(regexp_extract(body, '^((00)*)', 1)) // 2)::int) "
        "|| ltrim(digits, '1') as text from d7)"
    )
    return ", ".join(ctes)


def _addresses(source: str) -> str:
    """CTEs from the distinct ``script`` hex of ``source`` to ``addresses`` (script, address, kind)."""
    step = ""
    for bit, factor in enumerate(BECH32_GENERATOR):
        step = step if bit else "xor((c & 33554431) << 5, v)"
        step = f"xor({step}, case when (c >> {25 + bit}) & 1 = 1 then {factor} else 0 end)"
    fives = "list_transform(range(0, length(padded) // 5), lambda i: ('0x' || substr(padded, 5 * i + 1, 5))::bigint)"
    groups = f"flatten(list_transform({fives}, lambda n: [(n >> 15) & 31, (n >> 10) & 31, (n >> 5) & 31, n & 31]))"
    return f"""
kinds as materialized (
  select distinct script,
         case when regexp_full_match(script, '76A914[0-9A-F]{{40}}88AC') then 'P2PKH'
              when regexp_full_match(script, 'A914[0-9A-F]{{40}}87') then 'P2SH'
              when regexp_full_match(script, '0014[0-9A-F]{{40}}') then 'P2WPKH'
              when regexp_full_match(script, '0020[0-9A-F]{{64}}') then 'P2WSH'
              when starts_with(script, '6A') then 'NULL' else 'UNKNOWN' end as kind
  from {source}),
hashed as (
  select script, case kind when 'P2PKH' then '00' || substr(script, 7, 40) else '05' || substr(script, 5, 40) end as h
  from kinds where kind in ('P2PKH', 'P2SH')),
bodies as (
  select script, h || upper(substr(sha256(from_hex(sha256(from_hex(h)))), 1, 8)) as full_body from hashed),
{_base58("bodies", "full_body")},
witness as (
  select script, list_prepend(0::bigint, {groups}) as data
  from (select script, substr(script, 5) || case kind when 'P2WSH' then '0' else '' end as padded
        from kinds where kind in ('P2WPKH', 'P2WSH'))),
summed as (
  select script, data,
         xor(list_reduce([1, 3, 3, 0, 2, 3]::bigint[] || data || [0, 0, 0, 0, 0, 0]::bigint[], lambda c, v: {step}), 1) as s
  from witness),
bech32_text as (
  select script, 'bc1' || array_to_string(list_transform(
           data || [(s >> 25) & 31, (s >> 20) & 31, (s >> 15) & 31, (s >> 10) & 31, (s >> 5) & 31, s & 31],
           lambda d: substr('{BECH32_ALPHABET}', d::int + 1, 1)), '') as text
  from summed),
addresses as materialized (
  select k.script, k.kind,
         coalesce(b.text, w.text, case k.kind when 'NULL' then '' else 'unknown:' || base64(from_hex(k.script)) end) as address
  from kinds k left join base58_text b using (script) left join bech32_text w using (script))
"""


_CHAIN = f"""
chain0 as (
  select event_id as h, epoch(date_trunc('second', ts))::bigint - (event_id % 7) * 600 as raw_ts,
         round(value * 100)::bigint as cents, user_id::varchar as u, {_coinbase("event_id")} as cb,
         {_txid(_coinbase("(event_id - 1)"))} as parent
  from (select * from events
        qualify row_number() over (partition by event_id order by ts desc, user_id desc, value desc) = 1)),
chain1 as materialized (
  select *, {_txid("cb")} as cbid, upper(sha256(u))[:40] as d0, upper(sha256('s' || u))[:40] as d1,
         upper(sha256((h % 97)::varchar))[:40] as miner
  from chain0),
chain as materialized (
  select *, {_txid("'0100000001' || parent || '0000000000FFFFFFFF02' || " + _le("h + 4000000000", 8) + " || '160014' || d0 || " + _le("999999999 - cents", 8) + " || '17A914' || d1 || '8700000000'")} as spendid
  from chain1),
parsed as materialized (
  select raw_ts as ts, h::int as height, 0 as tx_pos, {_shown("cbid")} as tx_hash, 0::bigint as out_index, 0 as entry_idx,
         false as is_input, false as is_marker, '76A914' || miner || '88AC' as script, h + 5000000000 as value,
         {_shown("cbid")} as own_hash
  from chain
  union all
  select raw_ts, h::int, 1, {_shown("parent")}, 0, 0, true, false, null, null, {_shown("spendid")} from chain where h > 0
  union all
  select raw_ts, h::int, 1, {_shown("spendid")}, 0, 0, false, false, '0014' || d0, h + 4000000000, {_shown("spendid")}
  from chain where h > 0
  union all
  select raw_ts, h::int, 1, {_shown("spendid")}, 1, 1, false, false, 'A914' || d1 || '87', 999999999 - cents, {_shown("spendid")}
  from chain where h > 0
  union all
  select raw_ts, h::int, case when h = 0 then 1 else 2 end, null, null, 0, false, true, null, null, null from chain)
"""

_CLOCK = """
unique_headers as (select height, max(raw_ts) as raw_ts from headers group by height),
clock as (
  select height, raw_ts, rn + max(raw_ts - rn) over (order by height rows unbounded preceding) as ts
  from (select *, row_number() over (order by height) as rn from unique_headers))
"""

_LAST_EVENT = """
  select tx_hash, out_index, height, address, value from (
    select * from entries {where}
    qualify row_number() over (partition by tx_hash, out_index
                               order by height desc, tx_pos desc, not is_input desc, address desc, value desc) = 1)
  where not is_input
"""

_CHAIN_NET = f"""
{_CHAIN}, headers as (select height, ts as raw_ts from parsed where is_marker), {_CLOCK},
seen as materialized (
  select p.*, c.ts as block_ts, lag(value) over w as amount, lag(script) over w as owner
  from (select * exclude (ts) from parsed where not is_marker) p join clock c using (height)
  window w as (partition by tx_hash, out_index order by height, tx_pos, not is_input)),
chain_net as materialized (
  select block_ts as ts, height, tx_pos, sum(case when is_input then -amount else value end)::bigint as value,
         case when is_input then owner else script end as address
  from seen group by 1, 2, 3, 5 having sum(case when is_input then -amount else value end) <> 0)
"""

_CHAIN_LEGS = f"""
{_CHAIN},
owned as materialized (
  select *, lag(value) over w as amount, lag(script) over w as owner
  from parsed where not is_marker
  window w as (partition by tx_hash, out_index order by height, tx_pos, not is_input)),
{_addresses("(select script from parsed where script is not null)")},
all_legs as materialized (
  select o.height, o.ts, o.tx_pos, o.own_hash as tx_hash, o.tx_pos = 0 as is_coinbase, o.is_input, a.address, a.kind,
         case when o.is_input then o.amount else o.value end as value, o.entry_idx
  from owned o join addresses a on a.script = case when o.is_input then o.owner else o.script end),
{_TOTALS}
"""

_STREAM_NET = f"""
{_CHAIN_NET}, {_addresses("(select address as script from chain_net)")},
netted as (
  select n.ts, n.height, n.tx_pos, n.value, a.address from chain_net n join addresses a on a.script = n.address)
"""

# The well-known addresses of the sample keys.
_KEY_ADDRESSES = [
    "1BgGZ9tcN4rm9KBzDn7KprQz87SZ26SAMH",
    "1cMh228HTCiwS8ZsaakH8A8wze1JR5ZsP",
    "1EHNa6Q4Jz2uvNExL497mE43ikXhwF6kZm",
]
_KEYS = ", ".join(f"({i}, '{len(k) // 2:02X}{k}', '{a}')" for i, (k, a) in enumerate(zip(KEYS, _KEY_ADDRESSES, strict=True)))
_KEY_SCRIPTS = f"""
keys as (select * from (values {_KEYS}) k(i, push, owner)),
chosen as materialized (
  select c_custkey, c_custkey % 8 as shape, one.push as p1, one.owner as a1, two.push as p2, two.owner as a2,
         '21{NO_KEY}' as bad
  from customer join keys one on one.i = c_custkey // 8 % 3 join keys two on two.i = (c_custkey // 8 + 1) % 3)
"""

_HASH_SCRIPTS = """
scripts as materialized (
  select c_custkey,
         case c_custkey % 6
           when 0 then '76A914' || d[:40] || '88AC' when 1 then 'A914' || d[:40] || '87' when 2 then '0014' || d[:40]
           when 3 then '0020' || d when 4 then '76A914' || d[:40] || '88ACAC' else '6A20' || d end as script
  from (select c_custkey, upper(sha256(c_name)) as d from customer))
"""

ORACLE: dict[str, str] = {
    "utxo_match": f"with {_MATCHED} select * from matched",
    "utxo_match_join": f"""
        with {_ENTRIES},
        outs as (select * from entries where not is_input
                 qualify row_number() over (partition by tx_hash, out_index order by height desc, tx_pos desc) = 1)
        select i.height, i.ts, i.tx_pos, tx_hash, out_index, o.height as created, o.address, -o.value as value
        from (select * from entries where is_input) i join outs o using (tx_hash, out_index)""",
    "missing_utxo": f"""
        with {_MATCHED}
        select height, ts, tx_pos, tx_hash, out_index from seen where is_input and not coalesce(live, false)""",
    "utxo_set": f"with {_ENTRIES} {_LAST_EVENT.format(where='')}",
    "utxo_bootstrap": f"with {_ENTRIES} {_LAST_EVENT.format(where='where height between 1100 and 1500')}",
    "outpoints": f"with {_ENTRIES} select height, tx_pos, is_input, tx_hash, out_index from entries",
    "net_changes": f"with {_NET} select * from net",
    "net_changes_windowed": f"with {_NET} select * from net",
    "account_changes": f"""
        with {_NET}
        select value < 0 as "in", ts, height, tx_pos as "txPos", value / 1e8::double as value, address from net""",
    "transfers_mv": f"""
        with {_NET}
        select strftime(timestamp '1970-01-01' + to_seconds(ts), '%Y-%m-%d %H:%M:%S') as dt, height,
               tx_pos as "txPos", (value >= 0)::int as "out", value / 1e8::double as value, address
        from net""",
    "monthly_table": f"""
        with {_NET}
        select strftime(timestamp '1970-01-01' + to_seconds(ts), '%Y%m') as month, count(*) as records,
               sum((value >= 0)::int)::bigint as outs, sum(value)::bigint as satoshi
        from net group by 1""",
    "monthly_rewritten": f"""
        with {_NET},
        written as (
          select ts + case when height % 7 = 0 then 31 * 86400 else 0 end as paid, value >= 0 as is_out,
                 value + case when height % 7 = 0 then 200000000 when height % 5 = 0 then -100000000 else 0 end as value
          from net
        )
        select strftime(timestamp '1970-01-01' + to_seconds(paid), '%Y%m') as month, count(*) as records,
               sum(is_out::int)::bigint as outs, sum(value)::bigint as satoshi
        from written group by 1""",
    "tx_net_by_account": f"""
        with {_LEGS}
        select height, ts, tx_pos, tx_hash, address, kind,
               sum(case when is_input then -value else value end)::bigint as value
        from legs group by all""",
    "tx_fees": f"with {_LEGS} select * from fees",
    "block_minting": f"with {_LEGS} select *, reward - fees as minted from minting",
    "processed_txs": f"""
        with {_LEGS},
        numbered as (
          select height, ts, tx_pos, is_input, address, value,
                 row_number() over (partition by tx_hash, is_input
                                    order by l_linenumber, l_partkey, l_suppkey, sat, percent) - 1 as entry_idx
          from legs
          union all
          select height, ts, tx_pos, is_input, address, value, entry_idx from coinbases)
        {_processed("numbered")}""",
    "unbalanced_txs": f"with {_TAXED_LEGS} select * from fees where fee < 0",
    "unmatched_sides": f"""
        with {_LEGS}
        select height, ts, tx_pos, tx_hash, output_value - input_value as excess
        from totals where output_value <> input_value""",
    "tx_positions": f"""
        with {_LEGS}
        select height, tx_pos, tx_hash, count(*) filter (is_input) as inputs, count(*) filter (not is_input) as outputs
        from all_legs group by all""",
    "transfers": f"with {_TRANSFERS} select * from transfers",
    "transfer_edges": f"""
        with {_TRANSFERS}
        select "from", "to", amount / 1e8::double as value, height as "blockNumber", ts as "timestamp",
               tx_hash as "transactionHash"
        from transfers""",
    "transfer_edge_records": f"""
        with {_TRANSFERS}
        select "from", count("to") as edges, max(amount / 1e8::double) as largest, max(height) as last_block
        from transfers group by 1""",
    "stack_changes": f"with {_STACK} select * from stack",
    "transfer_edge_fields": f"""
        with {_TRANSFERS}
        select "from", "to", amount / 1e8::double as value, height as "blockNumber", ts as "timestamp",
               tx_hash as "transactionHash"
        from transfers""",
    "spent_by_origin": f"""
        with {_STACK}
        select address, ts, ots, sum(sign * value)::bigint as value
        from stack group by all having sum(sign * value) <> 0""",
    "open_segments": f"""
        with {_STACK}
        select address, nonce, max(ots) as ots, max(value) as value
        from stack group by address, nonce having sum(sign) = 1""",
    "stack_keyed_json": f"""
        with {_STACK}
        select concat_ws('-', address, nonce, case when sign > 0 then 'A' else 'D' end) as key, {_shard("address")},
               ots, value / 1e8::double as value
        from stack""",
    "stack_json_fields": f"""
        with {_STACK}
        select sign, ts, height, tx_pos as "txPos", nonce, ots, address, value / 1e8::double as value from stack""",
    "monotone_block_time": f"with {_HEADERS}, {_CLOCK} select * from clock",
    "time_regressions": f"""
        with {_HEADERS}
        select * from (select height, raw_ts, lag(raw_ts) over (order by height) as previous_ts
                       from (select height, max(raw_ts) as raw_ts from headers group by height))
        where raw_ts < previous_ts""",
    "confirmed_blocks": f"""
        with {_HEADERS}
        select * from headers where height > 100 and height <= (select max(height) - 3 from headers)""",
    "resume_height": f"with {_HEADERS} select coalesce(max(height), 0) as height from headers",
    "run_counters": f"""
        with {_ENTRIES}
        select floor(height / 1000)::bigint as interval, count(distinct height) as blocks,
               count(distinct (height, tx_pos)) as txs, count(*) as events
        from entries group by 1""",
    "daa_exact": f"with {_DATED} select ts::date::varchar as day, count(distinct address) as addresses from dated group by 1",
    "daa_approx_close": f"""
        with {_DATED} select ts::date::varchar as day, count(distinct address) as addresses, true as close
        from dated group by 1""",
    "daa_sketches_close": f"""
        with {_DATED}
        select date_trunc('week', ts)::date::varchar as day, count(distinct address) as addresses, true as close
        from dated group by 1""",
    "classify_scripts": f"""
        with {_SCRIPTS}
        select c_custkey,
               case when regexp_full_match(script, '76A914[0-9A-F]{{40}}88AC') then 'P2PKH'
                    when regexp_full_match(script, '21[0-9A-F]{{66}}AC') then 'P2PK'
                    when regexp_full_match(script, 'A914[0-9A-F]{{40}}87') then 'P2SH'
                    when regexp_full_match(script, '0014[0-9A-F]{{40}}') then 'P2WPKH'
                    when regexp_full_match(script, '0020[0-9A-F]{{64}}') then 'P2WSH'
                    when starts_with(script, '6A') then 'NULL'
                    when regexp_full_match(script, '51(21[0-9A-F]{{66}}){{2}}52AE') then 'MULTISIG'
                    else 'UNKNOWN' end as template
        from scripts""",
    "decode_op_n": f"""
        with {_SCRIPTS}
        select c_custkey, opcode,
               case when opcode = 0 then 0 when opcode = 79 then -1 when opcode between 81 and 96 then opcode - 80 end
                 as number
        from (select c_custkey, ('0x' || script[:2])::int as opcode from scripts)""",
    "shard_assignment": f"select c_custkey, c_name as address, {_shard('c_name')} from customer",
    "latest_per_key": f"""
        with {_CHANGES}
        select * from changes qualify row_number() over (partition by address order by ts desc) = 1""",
    "transfers_keyed_json": f"""
        with {_NET}
        select concat_ws('-', height, tx_pos, address) as key, {_shard("address")}, value < 0 as "in",
               value / 1e8::double as value
        from net""",
    "transfers_json_roundtrip": f"""
        with {_NET}
        select value < 0 as "in", ts, height, tx_pos as "txPos", value / 1e8::double as value, address from net""",
    "raw_block_records": f"""
        with {_CHAIN}
        select h::int as height, length(block) // 2 as bytes, sha256(from_hex(block)) as block_sha256
        from (select h, '01000000' || repeat('00', 64) || {_le("raw_ts", 4)} || repeat('00', 8)
                     || case when h = 0 then '01' else '02' end || cb
                     || case when h = 0 then '' else
                          '01000000' || case when h % 2 = 1 then '0001' else '' end || '01' || parent
                          || '0000000000FFFFFFFF02' || {_le("h + 4000000000", 8)} || '160014' || d0
                          || {_le("999999999 - cents", 8)} || '17A914' || d1 || '87'
                          || case when h % 2 = 1 then '0102ABCD' else '' end || '00000000' end as block
              from chain)""",
    "stream_net_changes": f"with {_STREAM_NET} select * from netted",
    "stream_stack_changes": f"with recursive {_STREAM_NET}, {_FOLD} select * from stack",
    "runs_net_changes": f"with {_STREAM_NET} select * from netted",
    "runs_stack_changes": f"with recursive {_STREAM_NET}, {_FOLD} select * from stack",
    "runs_transfers": f"with {_CHAIN_LEGS}, {_MODELLED} select * from transfers",
    "address_layout": f"""
        with {_NET}
        select address, height, tx_pos, value,
               row_number() over (partition by address order by height, tx_pos) as place
        from net""",
    "parse_blocks": f"with {_CHAIN} select * from parsed",
    "chain_net_changes": f"with {_CHAIN_NET} select * from chain_net",
    "chain_account_changes": f"""
        with {_CHAIN_NET}, {_addresses("(select address as script from chain_net)")}
        select value < 0 as "in", ts, height, tx_pos as "txPos", value / 1e8::double as value, a.address
        from chain_net n join addresses a on a.script = n.address""",
    "chain_transfers": f"with {_CHAIN_LEGS}, {_MODELLED} select * from transfers",
    "chain_processed_txs": f"with {_CHAIN_LEGS} {_processed('all_legs')}",
    "key_addresses": f"""
        with {_KEY_SCRIPTS}
        select c_custkey,
               case shape
                 when 2 then 'unknown:invalidpubkey:' || base64(unhex(bad || 'AC'))
                 when 3 then 'multisig:1:2:' || a1 || ':' || a2 when 4 then a1
                 when 5 then 'multisig:2:3:' || a1 || ':' || a2 when 6 then ''
                 when 7 then 'unknown:' || base64(unhex('51' || p1 || '52AE')) else a1 end as address,
               case when shape < 2 then 'P2PK' when shape in (3, 4, 5) then 'MULTISIG'
                    when shape = 6 then 'NULL' else 'UNKNOWN' end as kind
        from chosen""",
    "encode_addresses": f"""
        with {_HASH_SCRIPTS}, {_addresses("scripts")}
        select c_custkey, address, kind from scripts join addresses using (script)""",
}
