"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from checks.fixtures import AS_OF, END, LANDED_FROM, SLID_TO, START, STORED_BEFORE
from quotewright import schemas as s

ORACLES: dict[str, str] = {}


def r2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(28,8)), 2) as double)"


_T = "row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)"
VIEWS = {
    "bars": f"""
        select concat_ws(':', cast(l_suppkey as varchar), cast(cast(l_shipdate as date) as varchar)) as transaction_id,
               cast(l_suppkey as varchar) as stock_id, min(s_name) as ticker_symbol, cast(l_shipdate as date) as date,
               min(l_extendedprice) as low, arg_min(l_extendedprice, {_T}) as open, max(l_extendedprice) as high,
               cast(sum(l_quantity) as bigint) as volume, arg_max(l_extendedprice, {_T}) as close
        from lineitem join supplier on l_suppkey = s_suppkey
        group by l_suppkey, cast(l_shipdate as date)""",
    "ticks": """
        select concat_ws(':', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                         cast(cast(l_extendedprice as decimal(18,2)) as varchar)) as transaction_id,
               cast(l_suppkey as varchar) as stock_id, s_name as ticker_symbol, cast(l_shipdate as date) as date,
               nullif(cast(l_quantity as bigint) % 7, 0) as volume, l_quantity as close
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "companies": """
        select cast(s_suppkey as varchar) as stock_id, s_name as ticker_symbol, n_name as country, r_name as exchange,
               nullif(cast(s_suppkey % 5 as varchar), '0') as category_name, s_acctbal >= 5000 as technical,
               n_regionkey as region
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "watchlists": """
        select distinct concat_ws('-', cast(o_custkey as varchar), o_orderpriority) as watchlist_id,
               o_custkey as user_id, o_orderpriority as watchlist_name
        from orders""",
    "members": """
        select distinct concat_ws('-', cast(o_custkey as varchar), o_orderpriority) as watchlist_id,
               cast(l_suppkey as varchar) as stock_id, s_name as ticker_symbol
        from orders join lineitem on o_orderkey = l_orderkey join supplier on l_suppkey = s_suppkey""",
    "requests": f"""
        select ticker_symbol, country, technical, date '{START}' as start_date, date '{END}' as end_date
        from (select ticker_symbol, country, technical from companies
              union all select ticker_symbol, exchange, technical from companies
              union all select c_name, n_name, true from customer join nation on c_nationkey = n_nationkey)""",
    "stored": f"select * from bars where date < date '{STORED_BEFORE}'",
    "landed": f"select * from bars where date >= date '{LANDED_FROM}'",
    "newest": "select stock_id, max(date) as newest from stored group by stock_id",
    "refreshed": """
        select * from stored union all
        select landed.* from landed where (stock_id, date) not in (select stock_id, date from stored)""",
    "gapped": f"select * from stored where day(date) <> 15 or date >= date '{START}'",
    "moves": """
        select *, close - lag(close) over (partition by stock_id order by date, transaction_id) as delta from bars""",
    "tick_moves": """
        select *, close - lag(close) over (partition by stock_id order by date, transaction_id) as delta
        from (select * from ticks
              qualify row_number() over (partition by stock_id, ticker_symbol, date, close order by transaction_id) = 1)""",
    "open_requests": """
        select ticker_symbol, country, technical, stock_id, region,
               case when region in (0, 2, 4) then make_date(1996 + region, 3, 1) end as start_date,
               case when region in (1, 2) then make_date(1997 + region, 7, 31) end as end_date
        from companies""",
    "home": """
        select c_custkey as user_id, c_acctbal, cast(k as varchar) as stock_id, s_name as ticker_symbol
        from customer join (select s_nationkey as n, min(s_suppkey) as k from supplier group by 1) on c_nationkey = n
        join supplier on s_suppkey = k""",
}


def _frames(moves: str = "moves") -> str:
    parts = ["transaction_id, stock_id, ticker_symbol, date, close"]
    windows = []
    for p in sorted({*s.MA_PERIODS, *s.BAND_PERIODS, *s.RSI_PERIODS}):
        windows.append(
            f"w{p} as (partition by stock_id order by date, transaction_id rows between {p - 1} preceding and current row)"
        )
        parts += [
            f"avg(close) over w{p} as sma_{p}",
            f"list(close) over w{p} as list_{p}",
            f"stddev_samp(close) over w{p} as dev_{p}",
            f"avg(case when delta > 0 then delta else 0e0 end) over w{p} as gain_{p}",
            f"avg(case when delta < 0 then -delta else 0e0 end) over w{p} as loss_{p}",
        ]
    return f"select {', '.join(parts)} from {moves} window {', '.join(windows)}"


def _ema(p: int, seed: str = "newest") -> str:
    a = 2 / (p + 1)
    values = f"list_reverse(list_{p})" if seed == "newest" else f"list_{p}"
    return f"list_reduce({values}, lambda a, x: {a!r} * x + {(1 - a)!r} * a)"


def _rsi(p: int, lossless: str = "") -> str:
    g, l = f"gain_{p}", f"loss_{p}"
    lossless = lossless or f"100e0 - 100e0 / (1 + {g})"
    return (
        f"case when {l} = 0 and {g} <> 0 then {lossless} when {l} <> 0 and {g} = 0 then 0e0 "
        f"when {l} = 0 then 100e0 else 100e0 - 100e0 / (1 + {g} / {l}) end"
    )


def _sma_columns(prefix=""):
    return [f'{r2(f"sma_{p}")} as "{prefix}{p}_days_sma"' for p in s.MA_PERIODS]


def _ema_columns(prefix="", seed="newest"):
    return [f'{r2(_ema(p, seed))} as "{prefix}{p}_days_ema"' for p in s.MA_PERIODS]


def _band_columns(prefix=""):
    return [
        f'{r2(f"{r2(_ema(p))} {sign} 2 * dev_{p}")} as "{prefix}{p}_{side}_band"'
        for side, sign in (("upper", "+"), ("lower", "-"))
        for p in s.BAND_PERIODS
    ]


def _rsi_columns(lossless=""):
    return [f'{r2(_rsi(p, lossless))} as "{p}_days_rsi"' for p in s.RSI_PERIODS]


VIEWS["frames"] = _frames()
VIEWS["tick_frames"] = _frames("tick_moves")
_WIDE = [*_sma_columns("ma_"), *_ema_columns("ma_"), *_band_columns("bb_"), *_rsi_columns()]
VIEWS["tech"] = f"""
    select transaction_id as cal_id, transaction_id, stock_id, ticker_symbol, date, close, {', '.join(_WIDE)}
    from frames"""

# What each view reads, so that a query states only the ones it needs.
READS = {
    "requests": ["companies"],
    "stored": ["bars"],
    "landed": ["bars"],
    "newest": ["stored"],
    "refreshed": ["stored", "landed"],
    "gapped": ["stored"],
    "tick_moves": ["ticks"],
    "tick_frames": ["tick_moves"],
    "open_requests": ["companies"],
    "moves": ["bars"],
    "frames": ["moves"],
    "tech": ["frames"],
}


def _with(names: str) -> str:
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in READS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered)


def oracle(name: str, views: str, body: str, dates: str = "") -> None:
    """Register ``body``; the columns named in ``dates`` are shown as ISO text."""
    shown = ", ".join(f"cast({d} as varchar) as {d}" for d in dates.split())
    chosen = f"* replace ({shown})" if shown else "*"
    ORACLES[name] = f"{_with(views)}\nselect {chosen} from ({body})"


PRICES = "transaction_id, stock_id, ticker_symbol, date, low, open, high, volume, close"
KEYS = "cal_id, transaction_id, stock_id, ticker_symbol, date"
IN_RANGE = f"date between date '{START}' and date '{END}'"


def quoted(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


VIEW = quoted(s.VIEW_COLUMNS)
NARROW_MA = ", ".join(f'"ma_{c}" as "{c}"' for c in s.MA_COLUMNS)
NARROW_BANDS = ", ".join(f'"bb_{c}" as "{c}"' for c in s.BAND_COLUMNS)

for _name in (
    "conform_prices",
    "chart_json_explode",
    "normalize_history",
    "overwrite_readback",
    "export_combined",
):
    oracle(_name, "bars", f"select {PRICES} from bars", "date")
oracle("csv_roundtrip", "bars", "select date, low, open, high, volume, close from bars", "date")
oracle(
    "companies_default_unknown",
    "companies",
    """select 'id-' || ticker_symbol as stock_id, ticker_symbol, 'UNKNOWN' as company_name, exchange,
              coalesce(category_name, 'UNKNOWN') as category_name, country from companies""",
)
ORACLES["request_symbols_split"] = """
    select s_suppkey, cast(position as bigint) as position,
           case when position = 0 then s_name else 'X' || cast(s_suppkey as varchar) end as ticker_symbol
    from supplier cross join (values (0), (1)) t(position)"""

oracle(
    "watchlist_changes",
    "watchlists members home",
    """with asked as (select watchlists.*, stock_id as home, case when stock_id is not null then user_id % 4 end as kind
                      from watchlists left join home using (user_id)),
            held as (select watchlist_id, stock_id from asked join members using (watchlist_id)
                     where kind is null or kind = 0 or (kind = 3 and stock_id <> home)
                     union all select watchlist_id, home from asked where kind = 2),
            counted as (select watchlist_id, count(*) as n, min(stock_id) as least, max(stock_id) as most from held group by 1)
       select watchlist_id, case when kind = 2 then user_id + 1 else user_id end as user_id,
              watchlist_name || case kind when 0 then ' renamed' when 2 then ' anew' else '' end as watchlist_name,
              coalesce(n, 0) as n, least, most
       from asked left join counted using (watchlist_id) where kind is null or kind <> 1""",
)
oracle(
    "csv_rejects",
    "bars",
    """select case cast(stock_id as bigint) % 6 when 0 then 'good' when 1 then 'date' when 2 then 'volume' when 5 then 'no volume'
                  else 'fields' end as cause, count(*) as rows,
              case when min(cast(stock_id as bigint) % 6) in (0, 5) then cast(round(sum(close), 0) as bigint) end as closes
       from bars group by 1""",
)
oracle(
    "publish_batches",
    "bars",
    f"select {PRICES}, cast(year(date) as varchar) as batch from bars where year(date) not in (1996, 1997)",
    "date",
)
oracle("append_prices", "stored landed", f"select {PRICES} from stored union all select {PRICES} from landed", "date")
oracle("append_with_indicators", "tech", f"select {VIEW} from tech", "date")
oracle("split_moving_averages", "tech", f"select {KEYS}, {NARROW_MA} from tech", "date")
oracle("split_bollinger", "tech", f"select {KEYS}, {NARROW_BANDS} from tech", "date")
oracle("split_rsi", "tech", f"select {KEYS}, {quoted(s.RSI_COLUMNS)} from tech", "date")
oracle(
    "export_per_ticker",
    "bars",
    "select transaction_id, date, low, open, high, volume, close, ticker_symbol from bars",
    "date",
)
_HORIZON = f"date between date '{AS_OF}' - {s.VIEW_DAYS} and date '{AS_OF}'"
for _name in ("technical_view", "batch_view"):
    oracle(_name, "tech", f"select {VIEW} from tech where {_HORIZON}", "date")
oracle(
    "upsert_by_key",
    "bars",
    f"""with named as (select *, case when cast(stock_id as bigint) % 7 <> 0 then ticker_symbol end as view_name from bars),
             busy as (select view_name, min(date) as start_date, max(date) as end_date
                      from named where {IN_RANGE} and volume > 120 group by 1),
             every as (select view_name, min(date) as start_date, max(date) as end_date from named group by 1)
        select every.view_name, coalesce(busy.start_date, every.start_date) as start_date,
               coalesce(busy.end_date, every.end_date) as end_date
        from every left join busy on busy.view_name is not distinct from every.view_name""",
    "start_date end_date",
)
oracle(
    "cascade_delete",
    "bars frames",
    f"""select transaction_id, date, {r2("sma_5")} as "5_days_sma" from frames
        where transaction_id in (select transaction_id from bars where volume >= 10)""",
    "date",
)

oracle("price_history", "bars", "select transaction_id, date, low, open, high, volume, close from bars", "date")
oracle(
    "prices_in_range",
    "bars",
    f"select transaction_id, stock_id, ticker_symbol, date, close, volume from bars where {IN_RANGE}",
    "date",
)
oracle("date_range_filter", "bars", f"select {PRICES} from bars where {IN_RANGE}", "date")
oracle("company_lookup", "companies", "select ticker_symbol, country, stock_id from companies")
oracle(
    "stocks_in_view",
    "bars",
    f"select distinct stock_id, ticker_symbol from bars where date between date '{START}' and date '1998-01-07'",
)
oracle("txn_ids_dates", "bars", "select transaction_id, date from bars", "date")
oracle("read_moving_averages", "tech", f"select stock_id, ticker_symbol, date, {NARROW_MA} from tech", "date")
oracle("read_bollinger", "tech", f"select stock_id, ticker_symbol, date, {NARROW_BANDS} from tech", "date")
oracle("read_rsi", "tech", f"select stock_id, ticker_symbol, date, {quoted(s.RSI_COLUMNS)} from tech", "date")
oracle("technical_from_view", "tech", f"select {VIEW} from tech where {IN_RANGE}", "date")
oracle(
    "chart_frame",
    "tech",
    f"""select stock_id, date, close, "ma_20_days_ema" as "20_ema", "ma_50_days_sma" as "50_sma",
               "ma_200_days_sma" as "200_sma", "ma_50_days_ema" as "50_ema", "ma_200_days_ema" as "200_ema",
               "bb_20_lower_band" as "20_lower_band", "bb_20_upper_band" as "20_upper_band", "20_days_rsi"
        from tech where {IN_RANGE}""",
    "date",
)
oracle("close_series", "bars", "select stock_id, date, close as close_prices from bars", "date")
oracle(
    "rsi_zone",
    "frames",
    f"""select *, case when "20_days_rsi" > {s.OVERBOUGHT} then 'overbought'
                       when "20_days_rsi" < {s.OVERSOLD} then 'oversold' else 'neutral' end as zone
        from (select transaction_id, {r2(_rsi(20))} as "20_days_rsi" from frames)""",
)
oracle(
    "range_overlap",
    "bars requests",
    """select ticker_symbol, country, year, cast(f <= end_date and l >= start_date as bigint) as overlaps
       from requests join (select ticker_symbol, year(date) as year, min(date) as f, max(date) as l
                           from bars group by 1, 2) using (ticker_symbol)""",
)

oracle("technical_join", "tech", f"select {VIEW} from tech where {IN_RANGE}", "date")
oracle(
    "request_prices",
    "bars companies",
    f"""select ticker_symbol, country, stock_id, date, transaction_id, close, volume
        from bars join companies using (stock_id, ticker_symbol) where {IN_RANGE}""",
    "date",
)
oracle(
    "fk_violations",
    "bars members companies",
    """with unrated as (select stock_id, ticker_symbol from companies where category_name is null)
       select 'price to rated company' as relation, stock_id || '|' || ticker_symbol as key_value, count(*) as rows
       from bars join unrated using (stock_id, ticker_symbol) where cast(stock_id as bigint) % 7 <> 0 group by 1, 2
       union all
       select 'member to rated company', stock_id || '|' || ticker_symbol, count(*)
       from members join unrated using (stock_id, ticker_symbol) group by 1, 2""",
)

oracle(
    "fill_volume",
    "ticks",
    "select transaction_id, stock_id, ticker_symbol, date, coalesce(volume, 0) as volume, close from ticks",
    "date",
)
oracle(
    "missing_volume_rows",
    "ticks",
    "select transaction_id, stock_id, date, close from ticks where volume is null",
    "date",
)
for _name, _keys in (("dedup_ticker", "stock_id, ticker_symbol, date, close"), ("dedup_global", "date, close")):
    oracle(
        _name,
        "ticks",
        f"""select transaction_id, stock_id, ticker_symbol, date, coalesce(volume, 0) as volume, close from ticks
            qualify row_number() over (partition by {_keys} order by transaction_id) = 1""",
        "date",
    )
oracle(
    "null_counts",
    "ticks",
    "select "
    + ", ".join(
        f"count(*) filter (where {c} is null) as {c}_missing"
        for c in ("transaction_id", "stock_id", "ticker_symbol", "date", "volume", "close")
    )
    + " from ticks",
)
oracle(
    "duplicate_groups",
    "ticks",
    "select date, close, count(*) as count from ticks group by date, close having count(*) > 1",
    "date",
)
oracle(
    "duplicate_dates",
    "ticks",
    """select stock_id, date, count(distinct close) as count from ticks
       group by stock_id, date having count(distinct close) > 1""",
    "date",
)
oracle(
    "pk_violations",
    "ticks companies",
    """select 'ticks' as table_name, 'bar_id' as key_name, stock_id || ':' || cast(date as varchar) as key_value,
              count(*) as count from ticks group by stock_id, date having count(*) > 1
       union all
       select 'companies', 'category_name', category_name, count(*) from companies
       group by category_name having count(*) > 1 or category_name is null""",
)
oracle("distinct_stocks", "bars", "select distinct stock_id, ticker_symbol from bars")
oracle(
    "staleness",
    "bars",
    f"""select stock_id, ticker_symbol, max(date) as latest_date, date_diff('day', max(date), date '{AS_OF}') as days_stale
        from bars group by 1, 2""",
    "latest_date",
)
oracle(
    "summary_stats",
    "bars",
    " union all ".join(
        f"""select '{c}' as column_name, {r2("count(*)")} as count, {r2(f"avg({c})")} as mean,
                   {r2(f"stddev_samp({c})")} as stddev, {r2(f"min({c})")} as min, {r2(f"max({c})")} as max from bars"""
        for c in ("low", "open", "high", "volume", "close")
    ),
)
oracle(
    "bars_nested",
    "bars",
    """select stock_id, ticker_symbol, cast(0 as bigint) as page, count(*) as n,
              string_agg(transaction_id || '@' || cast(volume as varchar), ',' order by date) as bars
       from bars group by 1, 2""",
)
oracle("latest_n", "bars", f"select {PRICES} from bars order by date desc, transaction_id desc limit 200", "date")
for _name, _n in (("latest_n_per_ticker", 200), ("latest_per_ticker", 1)):
    oracle(
        _name,
        "bars",
        f"""select {PRICES} from bars
            qualify row_number() over (partition by ticker_symbol order by date desc) <= {_n}""",
        "date",
    )
ORACLES["union_tickers"] = ORACLES["append_prices"]

oracle("sma", "frames", f"select transaction_id, {', '.join(_sma_columns())} from frames")
oracle("ema_reference", "frames", f"select transaction_id, {', '.join(_ema_columns())} from frames")
oracle("ema_oldest_seed", "frames", f"select transaction_id, {', '.join(_ema_columns(seed='oldest'))} from frames")
oracle("bollinger", "frames", f"select transaction_id, {', '.join(_band_columns())} from frames")
oracle(
    "bollinger_sma",
    "frames",
    f"""select transaction_id, {r2("sma_20")} as "20_days_sma",
               {r2(f"{r2('sma_20')} + 2 * {r2('dev_20')}")} as "20_upper_band",
               {r2(f"{r2('sma_20')} - 2 * {r2('dev_20')}")} as "20_lower_band" from frames""",
)
oracle(
    "rolling_stddev",
    "frames",
    "select transaction_id, " + ", ".join(f'{r2(f"dev_{p}")} as "{p}_days_stddev"' for p in s.BAND_PERIODS) + " from frames",
)
oracle("price_change", "moves", f"select transaction_id, {r2('delta')} as price_change from moves")
oracle(
    "gain_loss",
    "moves",
    f"""select transaction_id, {r2("coalesce(delta, 0)")} as price_change,
               {r2("case when delta > 0 then delta else 0e0 end")} as gain,
               {r2("case when delta < 0 then -delta else 0e0 end")} as loss from moves""",
)
oracle("rsi", "frames", f"select transaction_id, {', '.join(_rsi_columns())} from frames")
oracle("rsi_zero_loss_hundred", "frames", f"select transaction_id, {', '.join(_rsi_columns('100e0'))} from frames")

oracle(
    "watchlist_nested",
    "watchlists members",
    """select watchlist_id, user_id, watchlist_name, cast(0 as bigint) as page,
              coalesce(string_agg(stock_id || '@' || ticker_symbol, ',' order by stock_id), '') as stocks
       from watchlists left join members using (watchlist_id) group by 1, 2, 3""",
)
oracle(
    "watchlist_find",
    "watchlists",
    """select watchlist_id, user_id, watchlist_name from watchlists
       where watchlist_name = '1-URGENT' and user_id in (select c_custkey from customer)""",
)
oracle(
    "watchlist_add",
    "watchlists members home",
    """with added as (select user_id, name, user_id || '-' || name as watchlist_id, stock_id, ticker_symbol
                      from home cross join (values ('1-URGENT'), ('FAVOURITES')) t(name)),
            lists as (select * from watchlists union select watchlist_id, user_id, name from added),
            stocks as (select * from members union select watchlist_id, stock_id, ticker_symbol from added)
       select watchlist_id, user_id, watchlist_name, stock_id, ticker_symbol
       from lists left join stocks using (watchlist_id)""",
)
oracle(
    "watchlist_delete",
    "watchlists members",
    """select watchlist_id, user_id, watchlist_name, stock_id, ticker_symbol
       from watchlists left join members using (watchlist_id)
       where user_id not in (select c_custkey from customer where c_acctbal < 0)""",
)
oracle(
    "watchlist_rename",
    "watchlists",
    """select watchlist_id, user_id,
              case when watchlist_name = '1-URGENT' then 'TOP' else watchlist_name end as watchlist_name
       from watchlists""",
)
oracle(
    "watchlist_replace",
    "watchlists members home",
    """with replaced as (select * from watchlists where watchlist_name = '3-MEDIUM')
       select * from members where watchlist_id not in (select watchlist_id from replaced)
       union all
       select watchlist_id, stock_id, ticker_symbol from home join replaced using (user_id) where c_acctbal >= 0""",
)

oracle("technical_frame", "tech", f"select {KEYS}, close, {quoted(s.WIDE_COLUMNS)} from tech", "date")
oracle("technical_range", "tech", f"select {KEYS}, close, {quoted(s.WIDE_COLUMNS)} from tech where {IN_RANGE}", "date")
oracle("daily_refresh", "refreshed", f"select {PRICES} from refreshed", "date")
oracle("stream_ingest", "bars", f"select {PRICES} from bars", "date")
oracle(
    "refresh_indicators",
    "tech newest",
    f"""select {KEYS}, close, {quoted(s.WIDE_COLUMNS)} from tech left join newest using (stock_id)
        where newest is null or date > newest""",
    "date",
)
_NO_BARS = ", ".join(f"null as {c}" for c in ("transaction_id", "low", "open", "high", "volume"))
_NO_INDICATORS = ", ".join(f'null as "{c}"' for c in s.WIDE_COLUMNS)
oracle(
    "resolve_requests",
    "tech companies",
    f"""with asked as (select stock_id, ticker_symbol, country, date '{START}' as start_date, date '{END}' as end_date,
                              cast(technical as bigint) as technical, region,
                              case when region = 4 then case when technical then 'computed' else 'landed' end
                                   when not technical or region = 3 then 'stored'
                                   when region = 2 then 'joined' else 'view' end as source
                       from companies)
        select ticker_symbol, country, start_date, end_date, technical, stock_id, source, date, close,
               cast(null as varchar) as transaction_id, cast(null as double) as low, cast(null as double) as open,
               cast(null as double) as high, cast(null as double) as volume, {quoted(s.WIDE_COLUMNS)}
        from asked join tech using (stock_id, ticker_symbol)
        where source in ('view', 'joined', 'computed') and {IN_RANGE}
        union all
        select ticker_symbol, country, start_date, end_date, technical, stock_id, source, date, close,
               transaction_id, low, open, high, cast(volume as double), {_NO_INDICATORS}
        from asked join bars using (stock_id, ticker_symbol)
        where source in ('stored', 'landed') and {IN_RANGE}""",
    "start_date end_date date",
)
oracle(
    "resolve_new_prices",
    "bars companies",
    f"select {PRICES} from bars where stock_id in (select stock_id from companies where region = 4)",
    "date",
)

oracle(
    "sliding_view",
    "tech",
    f"""select transaction_id, {VIEW}, date '{SLID_TO}' - {s.VIEW_DAYS} as start_date, date '{SLID_TO}' as end_date
        from tech where date between date '{SLID_TO}' - {s.VIEW_DAYS} and date '{SLID_TO}'""",
    "date start_date end_date",
)
oracle(
    "store_of_ticks",
    "tick_frames",
    f"""select stock_id, ticker_symbol, date, close, {r2("sma_20")} as "ma_20_days_sma",
               {r2(f"{r2(_ema(20))} + 2 * dev_20")} as "bb_20_upper_band", {r2(_rsi(20))} as "20_days_rsi"
        from tick_frames""",
    "date",
)
oracle(
    "overlap_join",
    "bars open_requests",
    """select ticker_symbol, country, start_date, end_date, year, quarter,
              greatest(coalesce(start_date, f), f) as overlap_start, least(coalesce(end_date, l), l) as overlap_end,
              date_diff('day', greatest(coalesce(start_date, f), f), least(coalesce(end_date, l), l)) + 1 as days
       from open_requests join (select ticker_symbol, year(date) as year, quarter(date) as quarter, min(date) as f, max(date) as l
                                from bars group by 1, 2, 3) using (ticker_symbol)
       where coalesce(start_date, f) <= l and coalesce(end_date, l) >= f""",
    "start_date end_date overlap_start overlap_end",
)

_OPEN = "(start_date is null or date >= start_date) and (end_date is null or date <= end_date)"
oracle(
    "view_of_ticks",
    "tick_frames",
    f"""select stock_id, ticker_symbol, date, close, {r2("sma_20")} as "ma_20_days_sma",
               {r2(f"{r2(_ema(20))} + 2 * dev_20")} as "bb_20_upper_band", {r2(_rsi(20))} as "20_days_rsi"
        from tick_frames where {_HORIZON}""",
    "date",
)
oracle(
    "view_horizon",
    "tech",
    f"select {VIEW} from tech where date between date '{END}' - {s.VIEW_DAYS} and date '{END}' and date >= date '{START}'",
    "date",
)
oracle(
    "batch_coverage",
    "bars",
    f"""select unnest(['prices', 'averages', 'bands', 'strength', 'view']) as part, count(*) as rows,
               date '{AS_OF}' - {s.VIEW_DAYS} as start_date, date '{AS_OF}' as end_date from bars""",
    "start_date end_date",
)
oracle(
    "refresh_gaps",
    "tech gapped",
    f"""select {KEYS}, close, {quoted(s.WIDE_COLUMNS)} from (
            select *, max(added) over (partition by stock_id order by date rows between 200 preceding and current row) as reached
            from (select tech.*, cast(gapped.transaction_id is null as bigint) as added
                  from tech left join gapped using (transaction_id)
                  where tech.date < date '{STORED_BEFORE}'))
        where reached = 1""",
    "date",
)
oracle(
    "refresh_store",
    "tech gapped bars",
    f"""select transaction_id, {VIEW},
               (select count(*) from bars) - (select count(*) from gapped) as first_prices,
               cast(0 as bigint) as second_prices, cast(0 as bigint) as second_strength from tech""",
    "date",
)
oracle(
    "bulk_load",
    "bars gapped",
    f"select {PRICES} from bars where transaction_id not in (select transaction_id from gapped)",
    "date",
)
oracle(
    "open_requests",
    "bars open_requests",
    f"""select ticker_symbol, country, start_date, end_date, transaction_id, date, close
        from bars join open_requests using (stock_id, ticker_symbol) where {_OPEN}""",
    "start_date end_date date",
)
oracle(
    "resolve_open_requests",
    "tech open_requests",
    f"""select stock_id, start_date, end_date, case when region <> 4 then 'stored' when technical then 'computed'
                                                    else 'landed' end as source, date, close,
               case when region = 4 and technical then "ma_20_days_sma" end as "ma_20_days_sma"
        from tech join open_requests using (stock_id, ticker_symbol) where {_OPEN}""",
    "start_date end_date date",
)
_CENTS = ", ".join(f"cast(cast(round({c} * 100) as bigint) as varchar)" for c in ("low", "open", "high", "volume", "close"))
oracle(
    "bars_pages",
    "bars",
    f"""select stock_id, page, count(*) as n, string_agg(text, ',' order by place) as bars
        from (select stock_id, place, place // 100 as page,
                     concat_ws('@', transaction_id, cast(date as varchar), {_CENTS}) as text
              from (select *, row_number() over (partition by stock_id order by date, transaction_id) - 1 as place from bars))
        group by stock_id, page""",
)
oracle(
    "rounded_large",
    "bars",
    f"""select transaction_id, place, case when abs(x) >= 4.5e13 then x else {r2("if(abs(x) >= 4.5e13, 0, x)")} end as rounded
        from (select transaction_id, cast(unnest(range(8)) as bigint) as place, unnest([close * 1e0, close * 1e5, close * 1e7,
              close * 1e12, close * 1e15, close * 1e100, 'inf'::double, '-inf'::double]) as x from bars)""",
)
oracle(
    "latest_n_deep",
    "bars",
    f"select {PRICES} from bars qualify row_number() over (partition by ticker_symbol order by date desc) <= 1500",
    "date",
)
oracle(
    "watchlist_pages",
    "watchlists members",
    """select watchlist_id, user_id, watchlist_name, coalesce(page, 0) as page, coalesce(stocks, '') as stocks
       from watchlists left join (
           select watchlist_id, page, string_agg(stock_id || '@' || ticker_symbol, ',' order by stock_id, ticker_symbol) as stocks
           from (select *, (row_number() over (partition by watchlist_id order by stock_id, ticker_symbol) - 1) // 3 as page
                 from members) group by 1, 2) using (watchlist_id)""",
)
oracle(
    "watchlist_replace_owned",
    "watchlists members home",
    """with replaced as (select * from watchlists where watchlist_name = '3-MEDIUM')
       select * from members where watchlist_id not in (select watchlist_id from replaced)
       union all
       select watchlist_id, stock_id, ticker_symbol from home join replaced using (user_id)""",
)
oracle(
    "chart_rejects",
    "bars",
    """select stock_id, ticker_symbol, case when cast(stock_id as bigint) % 5 in (0, 4) then count(*) end as bars
       from bars group by 1, 2""",
)
oracle(
    "stored_market",
    "tech companies",
    f"""select attempt, ticker_symbol, source, count(*) as rows, max(close) as highest,
               case when source in ('view', 'computed') then max("ma_20_days_ema") end as average
        from (select attempt, ticker_symbol, close, "ma_20_days_ema",
                     case when region <= 2 or attempt = 2 then case when technical then 'view' else 'stored' end
                          when technical then 'computed' else 'landed' end as source
              from tech join companies using (stock_id, ticker_symbol), (values (cast(1 as bigint)), (cast(2 as bigint))) as tries(attempt)
              where {IN_RANGE})
        group by 1, 2, 3""",
)
