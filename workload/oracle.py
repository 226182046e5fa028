"""The SQL twin of every query that SQL can express (DuckDB dialect)."""

from __future__ import annotations

from tapeloom.operators.features import FeatureConfig
from workload import queries as q
from workload.adapters import ASOF_CONFIG, BRAND_CONFIG, EVENT_CONFIG, TICK_CONFIG


def _round(expr: str) -> str:
    # adding zero turns -0.0 into 0.0
    return f"round({expr} + {q.NUDGE!r}, {q.DIGITS}) + 0.0"


def _clean(expr: str) -> str:
    return f"CASE WHEN NOT isnan({expr}) THEN {_round(expr)} END"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- bars

LINE_ORD = (
    "(l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 1009 + l_suppkey) % 1048576"
)


def _bars(unit: str = "CAST(ts AS DATE)", day: str = "trade_date") -> str:
    return f"""bars AS (
      SELECT ticker, {unit} AS {day},
             arg_min(price, ord) AS open, max(price) AS high, min(price) AS low,
             arg_max(price, ord) AS close, arg_max(price, ord) AS adj_close,
             CAST(sum(size) AS BIGINT) AS volume
      FROM ticks GROUP BY 1, 2)"""


BRAND_TICKS = f"""ticks AS (
      SELECT p_brand AS ticker, l_shipdate AS ts, l_extendedprice / l_quantity AS price,
             l_quantity AS size, {LINE_ORD} AS ord
      FROM lineitem JOIN part ON l_partkey = p_partkey)"""
PART_TICKS = f"""ticks AS (
      SELECT CAST(l_partkey AS VARCHAR) AS ticker, l_shipdate AS ts,
             l_extendedprice / l_quantity AS price, l_quantity AS size, {LINE_ORD} AS ord
      FROM lineitem)"""
SEGMENT_TICKS = """ticks AS (
      SELECT c_mktsegment AS ticker, o_orderdate AS ts, o_totalprice AS price, 1 AS size,
             o_orderkey AS ord
      FROM orders JOIN customer ON o_custkey = c_custkey)"""
EVENT_TICKS = """ticks AS (
      SELECT event_type AS ticker, ts, event_id, value AS price, 1 AS size,
             row(ts, event_id) AS ord
      FROM events)"""

BRAND_BARS = f"{BRAND_TICKS},\n{_bars()}"
PART_BARS = f"{PART_TICKS},\n{_bars()}"
NAN_BARS = """nan_bars AS (
      SELECT * REPLACE (CASE WHEN month(trade_date) = 12 AND day(trade_date) = 13
                             THEN CAST('nan' AS DOUBLE) ELSE adj_close END AS adj_close)
      FROM bars)"""

BROKEN_BARS = """broken AS (
      SELECT * REPLACE (CASE WHEN day(trade_date) = 7 THEN NULL
                             WHEN month(trade_date) = 12 AND day(trade_date) = 13
                             THEN CAST('nan' AS DOUBLE) ELSE adj_close END AS adj_close,
                        CASE WHEN day(trade_date) <> 21 THEN volume END AS volume)
      FROM bars)"""

# ------------------------------------------------------------ features


def _returns(
    source: str = "bars", order: str = "trade_date", price: str = "adj_close"
) -> str:
    return f"""prev AS (
      SELECT *, lag({price}) OVER (PARTITION BY ticker ORDER BY {order}) AS previous
      FROM {source}),
    returns AS (
      SELECT *, CASE WHEN previous > 0 AND {price} / previous > 0
                     THEN ln({price} / previous) END AS log_return
      FROM prev)"""


def _frame(size: int, order: str) -> str:
    return (
        f"(PARTITION BY ticker ORDER BY {order} "
        f"ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    )


def _volatility(config: FeatureConfig, order: str) -> dict[str, str]:
    return {
        f"volatility_{n}d": f"stddev_samp(log_return) OVER {_frame(n, order)}"
        for n in config.volatility_windows
    }


def _averages(config: FeatureConfig, order: str) -> dict[str, str]:
    return {
        f"ma_{n}": f"avg({config.price_column}) OVER {_frame(n, order)}"
        for n in config.ma_windows
    }


def _strength(config: FeatureConfig, order: str) -> str:
    change = f"({config.price_column} - previous)"
    frame = _frame(config.rsi_window, order)
    gain = f"avg(CASE WHEN {change} > 0 THEN {change} ELSE 0.0 END) OVER {frame}"
    loss = f"avg(CASE WHEN {change} < 0 THEN -{change} ELSE 0.0 END) OVER {frame}"
    return f"CASE WHEN {loss} = 0 THEN 100.0 ELSE 100 - 100 / (1 + {gain} / {loss}) END"


def _correlation(config: FeatureConfig, order: str) -> str:
    return f"corr(log_return, reference_return) OVER {_frame(config.correlation_window, order)}"


def _reference(config: FeatureConfig, day: str, order: str = "log_return") -> str:
    # one reference row per time: the first in the order of the series
    asof = config.reference_match == "asof"
    return f"""joined AS (
      SELECT r.*, f.reference_return FROM returns r {"ASOF LEFT" if asof else "LEFT"} JOIN (
        SELECT {day}, log_return AS reference_return FROM returns
        WHERE ticker = '{config.reference_ticker}'
        QUALIFY row_number() OVER (PARTITION BY {day} ORDER BY {order}) = 1) f
      ON r.{day} {">=" if asof else "="} f.{day})"""


def _silver(
    source: str,
    config: FeatureConfig,
    day: str,
    columns: list[str],
    order: str | None = None,
    digits: bool = True,
) -> str:
    order = order or day
    derived = {
        **_volatility(config, order),
        **_averages(config, order),
        "rsi": _strength(config, order),
        config.correlation_column: _correlation(config, order),
    }
    exempt = ", ".join(f"'{t}'" for t in config.volume_exempt_tickers)
    raw = ",\n             ".join(f"{expr} AS {name}" for name, expr in derived.items())
    clean = _clean if digits else lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END"
    final = ", ".join(f"{clean(name)} AS {name}" for name in ["log_return", *derived])
    kept = ", ".join(columns)
    return f"""{_returns(source, order, config.price_column)},
    {_reference(config, day, order.split(", ")[-1])},
    featured AS (
      SELECT {kept}, log_return,
             CASE WHEN ticker IN ({exempt}) THEN FALSE
                  ELSE volume <= {config.illiquid_volume_threshold} END AS is_illiquid,
             {raw}
      FROM joined),
    silver AS (
      SELECT {kept}, is_illiquid, {final} FROM featured)"""


# Bar columns in order.
BAR_COLUMNS = ["ticker", "trade_date", "open", "high", "low", "close", "adj_close", "volume"]
SILVER = _silver("bars", BRAND_CONFIG, "trade_date", BAR_COLUMNS)
SILVER_EXACT = _silver("bars", BRAND_CONFIG, "trade_date", BAR_COLUMNS, digits=False)


def _simple_feature(names: dict[str, str], source: str = "returns", pre: str = "") -> str:
    columns = ", ".join(f"{_round(expr)} AS {name}" for name, expr in names.items())
    return (
        _with(BRAND_BARS, _returns() + pre)
        + f"SELECT ticker, trade_date, {columns} FROM {source}"
    )


# ---------------------------------------------------------- dimensions


def _band(price: str) -> str:
    cases = " ".join(f"WHEN {price} < {upper} THEN '{name}'" for upper, name in q.BANDS)
    return f"CASE {cases} ELSE 'midcap_plus' END"


def _latest(source: str, where: str = "TRUE") -> str:
    return f"""SELECT ticker, adj_close FROM {source}
      WHERE {where} AND adj_close IS NOT NULL AND NOT isnan(adj_close)
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) = 1"""


def _dim(name: str, source: str, where: str = "TRUE", key: str = "BIGINT") -> str:
    return f"""{name} AS (
      SELECT CAST(row_number() OVER (ORDER BY s.ticker) AS {key}) AS ticker_sk, s.ticker,
             CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS sector,
             {_band('p.adj_close')} AS market_cap_category,
             s.effective_from, CAST(NULL AS DATE) AS effective_to,
             TRUE AS is_current, FALSE AS is_inferred
      FROM (SELECT ticker, min(trade_date) AS effective_from FROM {source}
            WHERE {where} GROUP BY 1) s
      JOIN ({_latest(source, where)}) p ON s.ticker = p.ticker)"""


OLD = f"trade_date <= DATE '{q.OLD_STATE_END}'"
SCD2 = f"""{PART_BARS},
    {_dim('dim', 'bars', OLD)},
    state AS (SELECT ticker, {_band('adj_close')} AS new_category FROM ({_latest('bars')})),
    changes AS (
      SELECT d.ticker_sk, d.ticker, d.market_cap_category, s.new_category
      FROM dim d JOIN state s ON d.ticker = s.ticker
      WHERE d.is_current AND d.market_cap_category <> s.new_category)"""


def _state(cut: str) -> str:
    return f"(SELECT ticker, {_band('adj_close')} AS c FROM ({_latest('bars', f"trade_date <= DATE '{cut}'")}))"


# a version for every cut that finds another band than the cut before it
VERSIONS = f"""found AS (
      SELECT s.ticker, s.c AS market_cap_category, b.first AS effective_from, NULL AS before
      FROM {_state(q.VERSION_CUTS[0])} s JOIN (
        SELECT ticker, min(trade_date) AS first FROM bars
        WHERE trade_date <= DATE '{q.VERSION_CUTS[0]}' GROUP BY ticker) b ON b.ticker = s.ticker
      UNION ALL {" UNION ALL ".join(
          f"SELECT o.ticker, n.c, DATE '{new}', o.c FROM {_state(old)} o JOIN {_state(new)} n ON n.ticker = o.ticker "
          f"WHERE o.ticker IN (SELECT ticker FROM {_state(q.VERSION_CUTS[0])})"
          for old, new in zip(q.VERSION_CUTS, q.VERSION_CUTS[1:]))}),
    versions AS (
      SELECT *, lead(effective_from) OVER (PARTITION BY ticker ORDER BY effective_from) AS effective_to
      FROM found WHERE before IS NULL OR before <> market_cap_category)"""

CALENDAR_COLUMNS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date,
             strftime(d, '%A') AS day_of_week, CAST(day(d) AS INTEGER) AS day_of_month,
             CAST(strftime(d, '%W') AS INTEGER) AS week_of_year,
             CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
             CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
             isodow(d) >= 6 AS is_weekend"""


def _calendar(source: str, day: str) -> str:
    return f"""SELECT {CALENDAR_COLUMNS} FROM (
        SELECT CAST(unnest(generate_series(date_trunc('year', min({day})),
                 date_trunc('year', max({day})) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                 INTERVAL 1 DAY)) AS DATE) AS d
        FROM {source})"""


STAR = f"""{BRAND_BARS},
    {SILVER},
    {_dim('known', 'silver', f"trade_date <= DATE '{q.DIM_CUTOFF}'", 'INTEGER')},
    members AS (
      SELECT ticker, ticker_sk FROM known
      UNION ALL
      SELECT ticker, CAST((SELECT max(ticker_sk) FROM known)
                          + row_number() OVER (ORDER BY ticker) AS INTEGER)
      FROM (SELECT DISTINCT ticker FROM silver WHERE ticker NOT IN (SELECT ticker FROM known))),
    calendar AS ({_calendar('silver', 'trade_date')}),
    fact AS (
      SELECT m.ticker_sk, c.date_sk, s.*
      FROM silver s JOIN members m ON s.ticker = m.ticker
      JOIN calendar c ON s.trade_date = c.full_date)"""

# ------------------------------------------------------------- regimes

# Features of the clustering and of the classifier.
CLUSTER = ["log_return", "volatility_20d", "rsi", "corr_vix_60d"]
CLASSIFIER = [
    "log_return",
    "volatility_20d",
    "volatility_60d",
    "ma_20",
    "ma_50",
    "ma_200",
    "rsi",
    "corr_vix_60d",
]


def _complete(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


SCALED = f"""{BRAND_BARS},
    {SILVER_EXACT},
    scaled AS (
      SELECT ticker, trade_date,
             {", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z_{c}" for c in CLUSTER)}
      FROM silver WHERE {_complete(CLUSTER)}),
    centres AS (
      SELECT * FROM (VALUES {", ".join(str((i, *c)) for i, c in enumerate(q.CENTRES))})
             AS v(id, {", ".join(f"c_{c}" for c in CLUSTER)}))"""


def _nearest(k: int) -> str:
    """Cluster of every scaled row among the first k centres."""
    distance = " + ".join(f"pow(z_{c} - c_{c}, 2)" for c in CLUSTER)
    return f"""SELECT ticker, trade_date, arg_min(id, {distance}) AS cluster
      FROM scaled CROSS JOIN (SELECT * FROM centres WHERE id < {k}) GROUP BY ALL"""


def _silhouette(k: int) -> str:
    """Mean silhouette by squared distances, from the count, sum and squares of each cluster."""
    names = [f"z_{c}" for c in CLUSTER]
    dot = " + ".join(f"r.{n} * t.s_{n}" for n in names)
    return f"""SELECT CAST({k} AS INTEGER) AS k,
             {_round("avg(CASE WHEN own_n = 1 THEN 0 ELSE (other - own) / greatest(other, own) END)")} AS silhouette
      FROM (SELECT ticker, trade_date,
                   max(n) FILTER (WHERE cluster = peer) AS own_n,
                   max(apart / (n - 1)) FILTER (WHERE cluster = peer) AS own,
                   min(apart / n) FILTER (WHERE cluster <> peer) AS other
            FROM (SELECT r.ticker, r.trade_date, r.cluster, t.cluster AS peer, t.n,
                         r.norm * t.n + t.squares - 2 * ({dot}) AS apart
                  FROM placed{k} r CROSS JOIN (
                    SELECT cluster, count(*) AS n, sum(norm) AS squares,
                           {", ".join(f"sum({n}) AS s_{n}" for n in names)}
                    FROM placed{k} GROUP BY cluster) t)
            GROUP BY ticker, trade_date)"""


def _placed(k: int) -> str:
    norm = " + ".join(f"z_{c} * z_{c}" for c in CLUSTER)
    return f"""placed{k} AS (
      SELECT s.*, n.cluster, {norm} AS norm
      FROM scaled s JOIN ({_nearest(k)}) n USING (ticker, trade_date))"""



def _lloyd(k: int) -> list[str]:
    """The centres of k after each step, from the first k given ones; sums are of whole units."""
    distance = " + ".join(f"pow(z_{c} - c_{c}, 2)" for c in CLUSTER)
    members = lambda step: f"""members{k}_{step} AS (
      SELECT any_value(s) AS s, arg_min(id, {distance}) AS id
      FROM (SELECT s, s.*, o.* FROM scaled s CROSS JOIN steps{k}_{step} o) GROUP BY ticker, trade_date)"""  # noqa: E731
    mean = lambda c: f"sum(CAST(round(s.z_{c} * 1048576) AS BIGINT)) / 1048576.0 / count(*)"
    parts = [f"steps{k}_0 AS (SELECT * FROM centres WHERE id < {k})"]
    for step in range(q.LLOYD_STEPS):
        parts += [
            members(step),
            f"""steps{k}_{step + 1} AS (
      SELECT o.id, {", ".join(f"coalesce(m.{c}, o.c_{c}) AS c_{c}" for c in CLUSTER)}
      FROM steps{k}_{step} o LEFT JOIN (
        SELECT id, {", ".join(f"{mean(c)} AS {c}" for c in CLUSTER)} FROM members{k}_{step} GROUP BY id) m
      ON m.id = o.id)""",
        ]
    return [*parts, members(q.LLOYD_STEPS)]


def _lloyd_rows(k: int) -> str:
    centres = ", ".join(f"{_round(f'c_{c}')} AS c_{c}" for c in CLUSTER)
    return f"""SELECT CAST({k} AS INTEGER) AS k, CAST(o.id AS INTEGER) AS cluster,
             (SELECT count(*) FROM members{k}_{q.LLOYD_STEPS} m WHERE m.id = o.id) AS members, {centres}
      FROM steps{k}_{q.LLOYD_STEPS} o"""


CALM, MOMENTUM, SELLOFF = q.RULE_LABELS
REGIMES = f"""{BRAND_BARS},
    {SILVER_EXACT},
    regimes AS (
      SELECT *, CASE WHEN volatility_20d <= {q.CALM_LIMIT} THEN '{CALM}'
                     WHEN log_return >= 0 THEN '{MOMENTUM}' ELSE '{SELLOFF}' END AS regime_label
      FROM silver WHERE {_complete(CLUSTER)}),
    targets AS (
      SELECT * FROM (
        SELECT *, lead(regime_label) OVER (PARTITION BY ticker ORDER BY trade_date)
                  AS next_day_regime
        FROM regimes)
      WHERE next_day_regime IS NOT NULL AND {_complete(CLASSIFIER)}),
    split AS (
      SELECT *, CASE WHEN trade_date <= DATE '{q.TRAIN_END}' THEN 'train' ELSE 'test' END AS split
      FROM targets WHERE ticker <> 'Brand#1'),
    label_index AS (
      SELECT next_day_regime, count(*) AS rows,
             CAST(row_number() OVER (ORDER BY count(*) DESC, next_day_regime) - 1 AS DOUBLE)
               AS label
      FROM split WHERE split = 'train' GROUP BY 1),
    persistence AS (
      SELECT ticker, trade_date, next_day_regime,
             CAST(list_position(['{CALM}', '{MOMENTUM}', '{SELLOFF}'], next_day_regime) - 1
                  AS DOUBLE) AS label,
             CAST(list_position(['{CALM}', '{MOMENTUM}', '{SELLOFF}'], regime_label) - 1
                  AS DOUBLE) AS prediction
      FROM split WHERE split = 'test'),
    confusion AS (
      SELECT label, prediction, count(*) AS rows FROM persistence GROUP BY 1, 2),
    per_class AS (
      SELECT label, CAST(sum(support) AS BIGINT) AS support,
             CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits
      FROM (SELECT label, rows AS support, 0 AS predicted,
                   CASE WHEN label = prediction THEN rows ELSE 0 END AS hits FROM confusion
            UNION ALL
            SELECT prediction, 0, rows, 0 FROM confusion)
      GROUP BY 1),
    scores AS (
      SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END AS precision,
                CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall
      FROM per_class),
    f_scores AS (
      SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM scores)"""

UNIVERSE_ROWS = ", ".join(
    f"('{group}', '{ticker}')" for group, tickers in q.UNIVERSE.items() for ticker in tickers
)
UNIVERSE_CTE = f"universe(group_name, ticker) AS (VALUES {UNIVERSE_ROWS})"

PROFILED = ["open", "high", "low", "close", "adj_close", "log_return"]


def _profile_row(name: str) -> str:
    nans = f"count(*) FILTER (WHERE isnan({name}))" if name in PROFILED else "0"
    return (
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count, "
        f"CAST({nans} AS BIGINT) AS nan_count, count(*) AS row_count FROM returns"
    )


ORACLE: dict[str, str] = {
    "daily_bars": _with(BRAND_BARS) + "SELECT * FROM bars",
    "daily_bars_range": _with(BRAND_BARS)
    + "SELECT * FROM bars WHERE trade_date >= DATE '1996-01-01' AND trade_date < DATE '1999-01-01'",
    "weekly_bars": _with(BRAND_TICKS, _bars("CAST(date_trunc('week', ts) AS DATE)"))
    + "SELECT * FROM bars",
    "segment_bars": _with(SEGMENT_TICKS, _bars()) + "SELECT * FROM bars",
    "hourly_bars": _with(EVENT_TICKS, _bars("date_trunc('hour', ts)", "bar_start"))
    + "SELECT * FROM bars",
    "conform_bars": _with(BRAND_BARS)
    + """SELECT ticker, trade_date, open, high, low, close, CAST(NULL AS DOUBLE) AS adj_close,
           CASE WHEN day(trade_date) <> 13 THEN volume END AS volume FROM bars""",
    "universe_filter": _with(BRAND_BARS, UNIVERSE_CTE)
    + "SELECT * FROM bars WHERE ticker IN (SELECT ticker FROM universe)",
    "missing_tickers": _with(BRAND_BARS, UNIVERSE_CTE)
    + "SELECT * FROM universe WHERE ticker NOT IN (SELECT ticker FROM bars)",
    "illiquid_flag": _with(BRAND_BARS)
    + """SELECT ticker, trade_date, volume,
           CASE WHEN ticker = 'Brand#1' THEN FALSE ELSE volume <= 20 END AS is_illiquid FROM bars""",
    "log_returns": _simple_feature({"log_return": "log_return"}),
    "rolling_volatility": _simple_feature(_volatility(BRAND_CONFIG, "trade_date")),
    "moving_averages": _simple_feature(_averages(BRAND_CONFIG, "trade_date")),
    "rsi": _simple_feature({"rsi": _strength(BRAND_CONFIG, "trade_date")}),
    "rolling_corr": _with(
        BRAND_BARS,
        _returns(),
        _reference(BRAND_CONFIG, "trade_date"),
        f"c AS (SELECT *, {_correlation(BRAND_CONFIG, 'trade_date')} AS c FROM joined)",
    )
    + f"SELECT ticker, trade_date, {_clean('c')} AS corr_vix_60d FROM c",
    "clean_nan": _with(
        BRAND_BARS,
        NAN_BARS,
        _returns("nan_bars"),
        "v AS (SELECT *, stddev_samp(log_return) OVER "
        + _frame(20, "trade_date")
        + " AS v FROM returns)",
    )
    + f"""SELECT ticker, trade_date, {_clean('log_return')} AS log_return,
            {_clean('v')} AS volatility_20d FROM v""",
    "silver_features": _with(BRAND_BARS, SILVER) + "SELECT * FROM silver",
    "silver_features_parts": _with(PART_BARS, SILVER) + "SELECT * FROM silver",
    "hourly_features": _with(
        EVENT_TICKS,
        _bars("date_trunc('hour', ts)", "bar_start"),
        _silver(
            "bars",
            EVENT_CONFIG,
            "bar_start",
            ["bar_start" if c == "trade_date" else c for c in BAR_COLUMNS],
        ),
    )
    + "SELECT * FROM silver",
    "tick_features": _with(
        EVENT_TICKS,
        "trades AS (SELECT ticker, ts, event_id, price, size AS volume FROM ticks)",
        _silver(
            "trades",
            TICK_CONFIG,
            "ts",
            ["ticker", "ts", "event_id", "price", "volume"],
            order="ts, event_id",
        ),
    )
    + "SELECT * FROM silver",
    "tick_features_asof": _with(
        EVENT_TICKS,
        "trades AS (SELECT ticker, ts, event_id, price, size AS volume FROM ticks)",
        _silver(
            "trades",
            ASOF_CONFIG,
            "ts",
            ["ticker", "ts", "event_id", "price", "volume"],
            order="ts, event_id",
        ),
    )
    + "SELECT * FROM silver",
    "silver_incremental": _with(BRAND_BARS, SILVER) + "SELECT * FROM silver",
    "late_bars": _with(BRAND_BARS) + "SELECT * FROM bars",
    "fact_by_year": _with(BRAND_BARS)
    + f"""SELECT ticker, trade_date, close, lag(close) OVER w AS previous_close,
             CAST(row_number() OVER w AS INTEGER) AS day_number
      FROM bars WHERE trade_date >= DATE '{q.FACT_START}'
      WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)""",
    "fact_versions": _with(PART_BARS, VERSIONS)
    + """SELECT b.ticker, b.trade_date, b.adj_close, v.market_cap_category, v.effective_from, v.effective_to
      FROM bars b LEFT JOIN versions v ON v.ticker = b.ticker AND b.trade_date >= v.effective_from
        AND (v.effective_to IS NULL OR b.trade_date < v.effective_to)""",
    "dim_date": _calendar("orders", "CAST(o_orderdate AS DATE)"),
    "price_band": _with(BRAND_BARS)
    + f"SELECT ticker, trade_date, {_band('adj_close')} AS market_cap_category FROM bars",
    "latest_price": _with(PART_BARS, NAN_BARS) + _latest("nan_bars"),
    "scd2_initial": _with(PART_BARS, NAN_BARS, _dim("dim", "nan_bars")) + "SELECT * FROM dim",
    "scd2_changes": _with(SCD2) + "SELECT * FROM changes",
    "scd2_apply": _with(SCD2)
    + f"""SELECT d.ticker_sk, d.ticker, d.company_name, d.sector, d.market_cap_category,
             d.effective_from,
             CASE WHEN c.ticker IS NOT NULL THEN DATE '{q.AS_OF}' END AS effective_to,
             c.ticker IS NULL AS is_current, d.is_inferred
      FROM dim d LEFT JOIN changes c ON d.ticker = c.ticker
      UNION ALL
      SELECT (SELECT max(ticker_sk) FROM dim) + row_number() OVER (ORDER BY ticker), ticker,
             NULL, NULL, new_category, DATE '{q.AS_OF}', NULL, TRUE, FALSE
      FROM changes""",
    "inferred_members": _with(
        PART_BARS, _dim("dim", "bars", f"trade_date <= DATE '{q.PART_DIM_CUTOFF}'")
    )
    + f"""SELECT (SELECT coalesce(max(ticker_sk), 0) FROM dim)
                 + row_number() OVER (ORDER BY ticker) AS ticker_sk,
             ticker, CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS sector,
             CAST(NULL AS VARCHAR) AS market_cap_category, DATE '{q.AS_OF}' AS effective_from,
             CAST(NULL AS DATE) AS effective_to, TRUE AS is_current, TRUE AS is_inferred
      FROM (SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (SELECT ticker FROM dim))""",
    "fact_bars": _with(STAR) + "SELECT * FROM fact",
    "fact_append": _with(STAR)
    + f"""SELECT ticker_sk, date_sk, ticker, trade_date, open, high, low, close, adj_close, volume
      FROM fact WHERE NOT ({OLD})""",
    "referential_integrity": _with(STAR)
    + """SELECT CAST(t AS BIGINT) AS orphan_ticker_keys, CAST(d AS BIGINT) AS orphan_date_keys,
             t = 0 AND d = 0 AS is_healthy
      FROM (SELECT count(DISTINCT ticker_sk) AS t FROM fact
            WHERE ticker_sk NOT IN (SELECT ticker_sk FROM known)),
           (SELECT count(DISTINCT date_sk) AS d FROM fact
            WHERE date_sk NOT IN (SELECT date_sk FROM calendar WHERE year < 2000))""",
    "fact_integrity": _with(STAR)
    + """SELECT CAST(0 AS BIGINT) AS orphan_ticker_keys, CAST(0 AS BIGINT) AS orphan_date_keys,
             count(*) = (SELECT count(*) FROM bars) AS is_healthy FROM fact""",
    "fact_calendar_gap": _with(BRAND_BARS)
    + f"""SELECT ticker, trade_date FROM bars
          WHERE year(trade_date) > (SELECT max(year(trade_date)) FROM bars
                                    WHERE trade_date <= DATE '{q.CALENDAR_GAP_END}')""",
    "silver_features_nan": _with(BRAND_BARS, BROKEN_BARS, _silver("broken", BRAND_CONFIG, "trade_date", BAR_COLUMNS))
    + "SELECT * FROM silver",
    "quality_profile": _with(BRAND_BARS, NAN_BARS, _returns("nan_bars"))
    + " UNION ALL ".join(
        _profile_row(c)
        for c in ["ticker", "trade_date", *PROFILED[:-1], "volume", "log_return"]
    ),
    "profiled_write": _with(BRAND_BARS, BROKEN_BARS, _silver("broken", BRAND_CONFIG, "trade_date", BAR_COLUMNS, digits=False))
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
             count(*) FILTER ({f"isnan({c})" if c not in ("ticker", "trade_date", "volume") else "FALSE"}) AS nan_count,
             count(*) AS row_count FROM silver"""
        for c in [*BAR_COLUMNS, *BRAND_CONFIG.derived_columns]
    )
    + """ UNION ALL SELECT 'is_illiquid', count(*) FILTER (is_illiquid), 0, count(*) FROM silver""",
    "quarantine": _with(BRAND_BARS)
    + """SELECT reason, count(*) AS rows, CAST(sum(CASE WHEN reason <> 'malformed' THEN size END) AS BIGINT) AS volume
      FROM (SELECT CASE WHEN day(trade_date) = 7 THEN 'malformed' WHEN day(trade_date) = 19 THEN 'no_key'
                        WHEN day(trade_date) = 11 AND low < high THEN 'crossed_range'
                        WHEN day(trade_date) = 23 AND volume > 0 THEN 'negative_volume' ELSE 'kept' END AS reason,
                   CASE WHEN day(trade_date) = 23 THEN -volume ELSE volume END AS size
            FROM bars) GROUP BY reason""",
    "flag_profile": _with(BRAND_BARS)
    + """SELECT count(*) FILTER (WHERE volume <= 20 AND ticker <> 'Brand#1') AS low_volume_rows,
             count(*) FILTER (WHERE volume <= 20 AND ticker <> 'Brand#1') AS low_volume_flagged,
             CAST(0 AS BIGINT) AS exempt_flagged
      FROM bars""",
    "zscore_features": _with(BRAND_BARS, SILVER_EXACT)
    + "SELECT ticker, trade_date, "
    + ", ".join(
        f"{_round(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} AS z_{c}"
        for c in CLUSTER
    )
    + f" FROM silver WHERE {_complete(CLUSTER)}",
    "kmeans_assign": _with(SCALED)
    + f"SELECT ticker, trade_date, CAST(cluster AS INTEGER) AS cluster FROM ({_nearest(len(q.CENTRES))})",
    "silhouette_sweep": _with(SCALED, *(_placed(k) for k in (2, 3, 4)))
    + " UNION ALL ".join(_silhouette(k) for k in (2, 3, 4)),
    "kmeans_fit": _with(BRAND_BARS, SILVER)
    + f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS away, CAST(0 AS BIGINT) AS misnamed,
             CAST(4 AS BIGINT) AS clusters
      FROM silver WHERE {_complete(CLUSTER)}""",
    "forest_fit": _with(REGIMES)
    + """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misnamed, TRUE AS accuracy_agrees,
             TRUE AS importances_add_up
      FROM split JOIN label_index USING (next_day_regime) WHERE split = 'test'""",
    "lloyd_sweep": _with(SCALED, *_lloyd(2), *_lloyd(3), *_lloyd(4))
    + " UNION ALL ".join(_lloyd_rows(k) for k in (2, 3, 4)),
    "label_regimes": _with(BRAND_BARS)
    + """SELECT ticker, trade_date, CAST(quarter(trade_date) - 1 AS INTEGER) AS cluster,
             CASE quarter(trade_date) WHEN 1 THEN 'calm_low_vol' WHEN 2 THEN 'high_vol_momentum'
                  WHEN 3 THEN 'high_vol_selloff' ELSE 'unknown' END AS regime_label
      FROM bars""",
    "next_day_target": _with(REGIMES)
    + "SELECT ticker, trade_date, regime_label, next_day_regime FROM targets",
    "time_split": _with(REGIMES) + "SELECT ticker, trade_date, next_day_regime, split FROM split",
    "label_index": _with(REGIMES) + "SELECT * FROM label_index",
    "class_weights": _with(REGIMES)
    + f"""SELECT *, {_round('sum(rows) OVER () / (count(*) OVER () * rows)')} AS class_weight
      FROM label_index""",
    "confusion_table": _with(REGIMES) + "SELECT * FROM confusion",
    "class_metrics": _with(REGIMES)
    + f"""SELECT label, support, predicted, hits, {_round('precision')} AS precision,
             {_round('recall')} AS recall, {_round('f1')} AS f1
      FROM f_scores""",
    "classification_metrics": _with(REGIMES)
    + f"""SELECT {_round('sum(hits) / sum(support)')} AS accuracy,
             {_round('sum(f1 * support) / sum(support)')} AS f1_weighted,
             {_round('sum(precision * support) / sum(support)')} AS weighted_precision,
             {_round('sum(recall * support) / sum(support)')} AS weighted_recall
      FROM f_scores""",
    "decode_prediction": _with(REGIMES)
    + f"""SELECT *, CASE prediction WHEN 0 THEN '{CALM}' WHEN 1 THEN '{MOMENTUM}' END
             AS predicted_regime
      FROM persistence""",
    "group_sum": """SELECT c_nationkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)
             AS total_price
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "table_scan": "SELECT * FROM lineitem",
    "limit_rows": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
}
