"""SQL for the registered queries, written from the fixture rules and not from the Spark code."""

from clearspark.plans import fixtures as fx

SIZE = fx.MAX_SIZE
_WAIT = "(SELECT 36000000000000 // count(*) FROM events)"

_TRADE = """
pos AS (
  SELECT event_id AS e, CAST(event_id % 4 AS INTEGER) AS part, event_id * 2 AS off,
    epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ms, event_type AS coin,
    CASE WHEN event_id % 97 = 0 THEN 'X' WHEN user_id % 2 = 0 THEN 'B' ELSE 'A' END AS letter,
    CAST(value AS DECIMAL(18,2)) AS p, json_extract_string(props, '$.k') AS sz
  FROM events),
trade AS (
  SELECT *, ms || '-' || coin || '-' || e AS tid, CAST(p AS VARCHAR) AS px,
    CASE letter WHEN 'B' THEN 'buy' WHEN 'A' THEN 'sell' ELSE letter END AS dir,
    CAST(p * CAST(sz AS INTEGER) AS DECIMAL(38,2)) AS worth,
    letter <> 'X' AND p > 0 AND CAST(sz AS INTEGER) > 0 AS valid,
    CASE WHEN letter = 'X' THEN 'invalid side "X"'
      WHEN p <= 0 THEN 'non-positive price "' || CAST(p AS VARCHAR) || '"'
      WHEN CAST(sz AS INTEGER) <= 0 THEN 'non-positive size "' || sz || '"' END AS why
  FROM pos),
delivery AS (
  SELECT * FROM trade
  UNION ALL
  SELECT * REPLACE (off + 15 AS off) FROM trade WHERE e % 10 = 3)"""


def _canonical(value: str) -> str:
    text = f"regexp_replace(CAST({value} AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1')"
    return f"regexp_replace({text}, '\\.$', '')"


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def _log(rows: str, ok: str = "TRUE") -> str:
    return f"log AS (SELECT *, {ok} AS ok FROM {rows})"


_SEGMENT_BY_SIZE = f"""
seg AS (
  SELECT *, COALESCE(SUM(CAST(ok AS INTEGER)) OVER (PARTITION BY part ORDER BY off
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {SIZE} AS k
  FROM log)"""

_CLOSES = f"w.n > 0 AND (w.n >= {SIZE} OR r.us - w.first >= {_WAIT})"
_SEGMENT_BY_SIZE_OR_TIME = f"""
num AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY off) AS rn FROM log),
walk AS (
  SELECT part, rn, 0 AS k, CAST(ok AS INTEGER) AS n, CASE WHEN ok THEN us END AS first
  FROM num WHERE rn = 1
  UNION ALL
  SELECT r.part, r.rn,
    CASE WHEN {_CLOSES} THEN w.k + 1 ELSE w.k END,
    CASE WHEN {_CLOSES} THEN 0 ELSE w.n END + CAST(r.ok AS INTEGER),
    CASE WHEN w.n > 0 AND NOT ({_CLOSES}) THEN w.first WHEN r.ok THEN r.us END
  FROM walk w JOIN num r ON r.part = w.part AND r.rn = w.rn + 1),
seg AS (SELECT num.*, walk.k FROM num JOIN walk USING (part, rn))"""

_BATCH = f"""
batch AS (
  SELECT part, k, min(off) AS lo, 'batch-p' || part || '_' || min(off) || '_' || max(off) AS batch_id,
    count(*) FILTER (WHERE ok) AS n, sum(worth) FILTER (WHERE ok) AS total,
    CASE WHEN count(*) FILTER (WHERE ok) >= {SIZE} THEN 'size' ELSE 'time' END AS reason
  FROM seg GROUP BY part, k HAVING count(*) FILTER (WHERE ok) > 0)"""

_CLEAN = "(SELECT * FROM trade WHERE valid)"
_CLEAN_BY_SIZE = (_TRADE, _log(_CLEAN), _SEGMENT_BY_SIZE, _BATCH)

# What the corruption of FIXTURES.md B4 makes of a batch.
_JUDGED = f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY part, k ORDER BY off) - 1 AS i FROM seg WHERE ok),
bad AS (
  SELECT part, k, min_by('trade[' || i || '] invalid: ' || why, i) AS why
  FROM placed WHERE why IS NOT NULL GROUP BY part, k),
opening AS (SELECT part, k, tid AS head FROM placed WHERE i = 0),
judged AS (
  SELECT b.*, lo % 7 AS kind,
    CASE WHEN lo % 17 = 0 THEN 'unparseable-settlement_batches-p' || b.part || '_' || lo
      WHEN lo % 7 = 3 THEN '' ELSE batch_id END AS given_id,
    CASE WHEN lo % 17 = 0 THEN 'unparseable_batch'
      WHEN lo % 7 = 3 THEN 'empty batch_id'
      WHEN lo % 7 = 4 THEN 'non-positive trade_count 0'
      WHEN lo % 7 = 0 THEN 'trade_count ' || (n + 1) || ' != len(trades) ' || n
      WHEN bad.why IS NOT NULL THEN bad.why
      WHEN lo % 7 = 2 THEN 'duplicate trade_id "' || head || '" in batch'
      WHEN lo % 7 = 1 THEN 'total_notional "' || CAST(total + 1 AS DECIMAL(38,2))
        || '" != recomputed "' || {_canonical("total")} || '"'
      WHEN lo % 7 = 6 THEN 'total_notional "' || {_canonical("total")} || CASE WHEN contains({_canonical("total")}, '.')
        THEN '' ELSE '.' END || repeat('0', 30) || '1" != recomputed "' || {_canonical("total")} || '"'
    END AS reject
  FROM batch b JOIN opening o USING (part, k) LEFT JOIN bad USING (part, k))"""

_TRIES = f"""
tries AS (
  SELECT part, k, min(a) AS won
  FROM batch CROSS JOIN generate_series(1, {fx.MAX_ATTEMPTS}) AS t(a)
  WHERE (lo // 2 + a * 7) % 5 <> 0 AND lo % 11 <> 0
  GROUP BY part, k)"""

_DECIDED = f"""
decided AS (
  SELECT j.*, won,
    CASE WHEN reject IS NULL AND won IS NOT NULL THEN 'settled' ELSE 'dead_letter' END AS outcome,
    CASE WHEN reject = 'unparseable_batch' THEN reject
      WHEN reject IS NOT NULL THEN 'validation_failed'
      WHEN won IS NULL THEN 'submit_exhausted' ELSE '' END AS failure_reason,
    CAST(CASE WHEN reject IS NOT NULL THEN 0 ELSE COALESCE(won, {fx.MAX_ATTEMPTS}) END AS BIGINT) AS attempts,
    CASE WHEN reject IS NOT NULL THEN reject
      WHEN won IS NULL THEN 'transient error, try {fx.MAX_ATTEMPTS}' ELSE '' END AS last_error
  FROM judged j LEFT JOIN tries USING (part, k))"""

_CLEAN_DECIDED = (*_CLEAN_BY_SIZE, _JUDGED, _TRIES, _DECIDED)

_FEED = """
feed AS (
  SELECT *, e % 211 <> 0 AS whole,
    CASE e % 50 WHEN 7 THEN 'pong' WHEN 8 THEN 'subscriptionResponse' WHEN 9 THEN 'orderUpdates'
      ELSE 'trades' END AS channel
  FROM trade),
raw AS (
  SELECT * FROM feed WHERE whole AND channel = 'trades' AND e % 223 <> 0)"""

_JSON = (
    """'{"trade_id":"' || tid || '","coin":"' || coin || '","side":"' || dir || '","price":"' || px"""
    """ || '","size":"' || sz || '","notional":"' || worth || '","event_time_ms":' || ms"""
    """ || ',"hash":"0x' || printf('%X', e)"""
    f""" || '","ingest_time_ms":{fx.INGEST_MS},"source":"{fx.SOURCE}"}}'"""
)

_TRADE_COLUMNS = f"""tid AS trade_id, coin, dir AS side, px AS price, sz AS size,
  {{notional}} AS notional, ms AS event_time_ms, '0x' || printf('%X', e) AS hash,
  CAST({fx.INGEST_MS} AS BIGINT) AS ingest_time_ms, '{fx.SOURCE}' AS source"""

_BATCH_COLUMNS = "batch_id, reason AS flush_reason, n AS trade_count"
_TOTAL = "CAST(total AS DECIMAL(38,16)) AS total_notional"


def _fifo(capacity: int, shards: int, steps: int = 1) -> str:
    seen = "list_contains(w.mem, r.key)"
    return f"""WITH RECURSIVE
keyed AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id * 2 AS "offset",
    CAST(user_id AS VARCHAR) AS key,
    (epoch_us(ts) - lo) * {steps} // (hi - lo + 1) AS step,
    CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % {shards} AS shard
  FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)),
num AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY step, partition, "offset") AS rn FROM keyed),
walk AS (
  SELECT shard, rn, [key] AS mem, TRUE AS admitted FROM num WHERE rn = 1
  UNION ALL
  SELECT r.shard, r.rn,
    CASE WHEN {seen} THEN w.mem
      WHEN len(w.mem) = {capacity} THEN list_append(w.mem[2:], r.key)
      ELSE list_append(w.mem, r.key) END,
    NOT {seen}
  FROM walk w JOIN num r ON r.shard = w.shard AND r.rn = w.rn + 1)
SELECT partition, "offset", admitted FROM num JOIN walk USING (shard, rn)"""


ORACLES: dict[str, str] = {}


def _by_topic() -> str:
    return (
        _with(_TRADE)
        + """SELECT topic, part AS partition, count(*) AS messages, max(off) + 1 AS high_water
FROM (SELECT 'feed' AS topic, part, off FROM trade
  UNION ALL SELECT 'trades', part, off FROM delivery
  UNION ALL SELECT 'trades.normalized', part, off FROM trade)
GROUP BY topic, part"""
    )


ORACLES["topic_high_water"] = _by_topic()

ORACLES["topic_routing"] = (
    _with(_TRADE)
    + """SELECT coin, d.n AS trades, f.n AS feed
FROM (SELECT coin, count(*) AS n FROM delivery GROUP BY coin) d
JOIN (SELECT coin, count(*) AS n FROM trade GROUP BY coin) f USING (coin)"""
)

ORACLES["keyed_order"] = (
    _with(_TRADE) + 'SELECT coin, part AS partition, off AS "offset" FROM delivery'
)

ORACLES["keyed_order_ranks"] = (
    _with(_TRADE)
    + """SELECT coin, part AS partition, off AS "offset",
  row_number() OVER (ORDER BY coin, part, off) - 1 AS rank, CAST(0 AS BIGINT) AS breaks
FROM delivery"""
)

ORACLES["strict_decode"] = (
    _with(_TRADE)
    + """SELECT e AS event_id, parsed,
  CASE WHEN NOT parsed THEN '-' WHEN e % 11 = 4 THEN '' ELSE coin END AS coin,
  CASE WHEN NOT parsed THEN '-' ELSE px END AS price,
  CASE WHEN NOT parsed THEN -1 ELSE ms END AS event_time_ms
FROM (SELECT *, e % 11 NOT IN (0, 1, 2, 3, 6) AS parsed FROM trade)"""
)

ORACLES["encode_round_trip"] = (
    _with(_TRADE)
    + f"SELECT {_TRADE_COLUMNS.format(notional='CAST(worth AS VARCHAR)')} FROM trade"
)

ORACLES["message_routes"] = (
    _with(_TRADE, _FEED)
    + """SELECT CASE WHEN whole THEN channel ELSE '-' END AS channel,
  CASE WHEN NOT whole THEN 'bad_envelope' WHEN channel = 'trades' THEN 'trades'
    WHEN channel = 'orderUpdates' THEN 'ignored' ELSE 'control' END AS route,
  count(*) AS messages
FROM feed GROUP BY 1, 2"""
)

ORACLES["normalize_trades"] = (
    _with(_TRADE, _FEED)
    + f"SELECT {_TRADE_COLUMNS.format(notional=_canonical('worth'))} FROM raw WHERE letter <> 'X'"
)

ORACLES["normalize_rejects"] = (
    _with(_TRADE, _FEED)
    + """SELECT reject_reason, count(*) AS skipped FROM (
  SELECT 'unknown side "X"' AS reject_reason FROM raw WHERE letter = 'X'
  UNION ALL SELECT 'missing required field' FROM raw WHERE e % 13 = 0
  UNION ALL SELECT 'undecodable trades' FROM feed
    WHERE whole AND channel = 'trades' AND e % 223 = 0)
GROUP BY reject_reason"""
)

ORACLES["feed_counters"] = (
    _with(_TRADE, _FEED)
    + """SELECT produced, bad_sides + halves + broken AS skipped FROM
  (SELECT count(*) FILTER (WHERE letter <> 'X') AS produced,
    count(*) FILTER (WHERE letter = 'X') AS bad_sides,
    count(*) FILTER (WHERE e % 13 = 0) AS halves FROM raw),
  (SELECT count(*) AS broken FROM feed WHERE whole AND channel = 'trades' AND e % 223 = 0)"""
)

ORACLES["exact_notional_by_coin"] = (
    _with(_TRADE, _FEED)
    + """SELECT coin, side, trades, regexp_replace(regexp_replace(
    (b * 1000000000000000000::HUGEINT + c // 100) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') || lpad(CAST(a AS VARCHAR), 20, '0'),
    '0+$', ''), '\\.$', '') AS notional
FROM (SELECT coin, dir AS side, count(*) AS trades,
    COALESCE(sum(CAST(worth * 100 AS HUGEINT)) FILTER (WHERE e % 3 = 0), 0)::HUGEINT AS a,
    COALESCE(sum(CAST(worth * 100 AS HUGEINT)) FILTER (WHERE e % 3 = 1), 0)::HUGEINT AS b,
    COALESCE(sum(CAST(worth * 100 AS HUGEINT)) FILTER (WHERE e % 3 = 2), 0)::HUGEINT AS c
  FROM raw WHERE letter <> 'X' GROUP BY coin, dir)"""
)

_LINE_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

ORACLES["canonical_decimal"] = f"""SELECT l_orderkey, l_linenumber,
  {_canonical(f"{_LINE_PRICE} * CAST(l_quantity AS DECIMAL(18,2))")} AS worth
FROM lineitem"""

ORACLES["decimal_checks"] = f"""SELECT l_linenumber, count(*) AS n_rows,
  count(*) FILTER (WHERE odd <> 3) AS numbers,
  count(*) FILTER (WHERE odd IN (2, 5, 6) OR (odd IN (0, 4) AND p > 0)) AS positive,
  count(*) FILTER (WHERE odd = 0 OR (odd IN (1, 4) AND p = 0)) AS equal,
  count(*) AS equal_with_zero,
  CAST(0 AS BIGINT) AS equal_to_text
FROM (SELECT l_linenumber, l_linenumber % 7 AS odd, {_LINE_PRICE} AS p FROM lineitem)
GROUP BY l_linenumber"""

ORACLES["trade_validation_reasons"] = (
    _with(_TRADE)
    + "SELECT COALESCE(why, 'valid') AS reason, count(*) AS trades FROM delivery GROUP BY 1"
)

ORACLES["ingest_accepted"] = (
    _with(_TRADE)
    + f"""SELECT part AS partition, off AS "offset", coin, md5({_JSON}) AS value_md5
FROM trade WHERE valid"""
)

ORACLES["ingest_counters"] = (
    _with(_TRADE)
    + """SELECT count(*) AS consumed, count(DISTINCT tid) FILTER (WHERE valid) AS forwarded,
  count(*) FILTER (WHERE NOT valid) AS dropped,
  count(*) FILTER (WHERE valid) - count(DISTINCT tid) FILTER (WHERE valid) AS deduped
FROM delivery"""
)

ORACLES["dedup_keep_first"] = (
    _with(_TRADE)
    + """SELECT partition, "offset", trade_id FROM (
  SELECT part AS partition, off AS "offset", tid AS trade_id,
    row_number() OVER (PARTITION BY tid ORDER BY part, off) AS rn
  FROM delivery) WHERE rn = 1"""
)

ORACLES["dedup_lineitem_keys"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST({_LINE_PRICE} * CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(38,4)) AS worth
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLES["batch_by_size"] = (
    _with(*_CLEAN_BY_SIZE) + f"SELECT {_BATCH_COLUMNS}, {_TOTAL} FROM batch"
)

ORACLES["batch_size_or_time"] = (
    _with(_TRADE, _log(_CLEAN), _SEGMENT_BY_SIZE_OR_TIME, _BATCH, recursive=True)
    + f"SELECT {_BATCH_COLUMNS}, {_TOTAL} FROM batch"
)

ORACLES["batch_with_undecodable"] = (
    _with(_TRADE, _log("trade", "e % 211 <> 0"), _SEGMENT_BY_SIZE_OR_TIME, _BATCH, recursive=True)
    + f"SELECT {_BATCH_COLUMNS} FROM batch"
)

ORACLES["flush_reason_counts"] = (
    _with(_TRADE, _log("trade"), _SEGMENT_BY_SIZE_OR_TIME, _BATCH, recursive=True)
    + """SELECT reason AS flush_reason, count(*) AS batches_out, CAST(sum(n) AS BIGINT) AS trades_out,
  """
    + _canonical("sum(total)")
    + """ AS total_notional
FROM batch GROUP BY reason"""
)

ORACLES["batch_payload"] = (
    _with(*_CLEAN_BY_SIZE)
    + f"""SELECT batch_id AS message_key, batch_id, CAST({fx.CREATED_MS} AS BIGINT) AS created_at_ms,
  'batch-publisher' AS producer, n AS trade_count, trade_ids, prices
FROM batch JOIN (
  SELECT part, k, string_agg(tid, ',' ORDER BY off) AS trade_ids,
    string_agg(px, ',' ORDER BY off) AS prices
  FROM seg GROUP BY part, k) USING (part, k)"""
)

ORACLES["batch_validation"] = (
    _with(_TRADE, _log("trade"), _SEGMENT_BY_SIZE, _BATCH, _JUDGED)
    + """SELECT part AS partition, lo AS "offset", COALESCE(reject, 'valid') AS reason FROM judged"""
)

ORACLES["settlement_outcomes"] = (
    _with(*_CLEAN_DECIDED)
    + """SELECT part AS partition, lo AS "offset", given_id AS batch_id, outcome, failure_reason,
  attempts, last_error FROM decided"""
)

ORACLES["dead_letters"] = (
    _with(*_CLEAN_DECIDED)
    + f"""SELECT given_id AS message_key, given_id AS batch_id, failure_reason, attempts,
  CAST({fx.FAILED_MS} AS BIGINT) AS failed_at_ms,
  CAST(CASE WHEN lo % 17 = 0 OR kind = 4 THEN 0 WHEN kind IN (0, 2) THEN n + 1 ELSE n END AS BIGINT)
    AS declared_trades,
  CAST(CASE WHEN lo % 17 = 0 OR kind = 4 THEN 0 WHEN kind = 2 THEN n + 1 ELSE n END AS BIGINT)
    AS kept_trades
FROM decided WHERE outcome = 'dead_letter'"""
)

ORACLES["submitter_counters"] = (
    _with(*_CLEAN_DECIDED)
    + "SELECT outcome, failure_reason, count(*) AS batches FROM decided GROUP BY ALL"
)

ORACLES["settle_idempotent"] = (
    _with(*_CLEAN_DECIDED)
    + """SELECT batch_id, '0x' || sha256(batch_id) AS tx_hash, attempts, n AS trade_count
FROM decided WHERE outcome = 'settled' AND lo % 3 <> 0"""
)

ORACLES["backoff_schedule"] = """SELECT attempt, delay_ms, count(*) AS n_rows
FROM (SELECT event_id % 13 AS attempt,
    CAST(least(200 * pow(2, greatest(event_id % 13, 1) - 1), 5000) AS BIGINT) AS delay_ms FROM events)
GROUP BY attempt, delay_ms"""

ORACLES["jitter_bounds"] = """SELECT event_id % 13 AS attempt, count(*) AS draws,
  count(*) AS within, TRUE AS spread FROM events GROUP BY 1"""

ORACLES["reconcile_summary"] = (
    _with(*_CLEAN_BY_SIZE, _TRIES)
    + """SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS sum_trade_count,
  CAST(sum(n) AS BIGINT) AS distinct_trade_ids,
  count(*) FILTER (WHERE won IS NULL) AS dead_letter_records,
  CAST(sum(n) FILTER (WHERE won IS NULL) AS BIGINT) AS dead_letter_distinct_trade_ids,
  'OK' AS verdict
FROM batch LEFT JOIN tries USING (part, k)"""
)

ORACLES["reconcile_lost_repeated"] = """SELECT CAST(o_orderkey AS VARCHAR) AS trade_id,
  CASE WHEN n IS NULL THEN 'lost' ELSE 'repeated' END AS problem,
  CAST(1 AS BIGINT) AS in_source, COALESCE(n, 0) AS in_batches
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey
WHERE n IS NULL OR n > 1"""

ORACLES["reconcile_trades"] = (
    _with(_TRADE)
    + """SELECT tid AS trade_id, CASE WHEN valid THEN 'repeated' ELSE 'lost' END AS problem,
  CAST(1 AS BIGINT) AS in_source, CAST(CASE WHEN valid THEN 2 ELSE 0 END AS BIGINT) AS in_batches
FROM trade WHERE NOT valid OR e % 10 = 3"""
)

ORACLES["run_event_summary"] = (
    _with(*_CLEAN_DECIDED)
    + """SELECT 'batch-publisher' AS component, 'batch flushed' AS msg, count(*) AS lines FROM decided
UNION ALL
SELECT 'chain-submitter', CASE outcome WHEN 'settled' THEN 'batch settled' ELSE 'batch dead-lettered' END,
  count(*) FROM decided GROUP BY outcome
UNION ALL
SELECT 'chain-submitter', 'submit attempt failed',
  CAST(sum(CASE WHEN outcome = 'settled' THEN attempts - 1 ELSE attempts END) AS BIGINT) FROM decided"""
)

ORACLES["dedup_fifo_bounded"] = _fifo(4, 1)

ORACLES["settled_by_coin"] = (
    _with(_TRADE, _log(_CLEAN), _SEGMENT_BY_SIZE_OR_TIME, _BATCH, _TRIES, recursive=True)
    + """SELECT coin, CASE WHEN won IS NULL THEN 'dead_letter' ELSE 'settled' END AS outcome,
  count(*) AS trades, count(DISTINCT batch_id) AS batches,
  """
    + _canonical("sum(worth)")
    + """ AS notional
FROM seg JOIN batch USING (part, k) LEFT JOIN tries USING (part, k)
GROUP BY 1, 2"""
)

ORACLES["stream_dedup"] = _with(_TRADE) + f"SELECT coin, md5({_JSON}) AS value_md5 FROM trade WHERE valid"

ORACLES["stream_dedup_by_table"] = ORACLES["ingest_accepted"]

ORACLES["stream_batches"] = ORACLES["batch_size_or_time"]

ORACLES["stream_time_flush"] = ORACLES["batch_size_or_time"]

ORACLES["stream_restart_no_loss"] = (
    _with(_TRADE, _log(_CLEAN), _SEGMENT_BY_SIZE_OR_TIME, _BATCH, recursive=True)
    + """SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS distinct_trade_ids,
  CAST(sum(n) AS BIGINT) AS trades FROM batch"""
)

ORACLES["stream_settle"] = (
    _with(*_CLEAN_DECIDED)
    + """SELECT batch_id, '0x' || sha256(batch_id) AS tx_hash, attempts, n AS trade_count
FROM decided WHERE outcome = 'settled'"""
)

_FAR = f"lo * {fx.FAR}"
_FAR_ID = f"'batch-p' || part || '_' || ({_FAR}) || '_' || ({_FAR} + 1)"
ORACLES["stream_settle_cells"] = (
    _with(*_CLEAN_DECIDED)
    + f"""SELECT {_FAR_ID} AS batch_id, '0x' || sha256({_FAR_ID}) AS tx_hash, part AS log_partition,
  {_FAR} // 1048576 AS span, lo % 3 AS micro_batch
FROM decided WHERE outcome = 'settled'"""
)

ORACLES["stream_reconcile"] = (
    _with(*_CLEAN_BY_SIZE, _TRIES)
    + """SELECT micro_batch, CAST(sum(b) AS BIGINT) AS batches, CAST(sum(b * n) AS BIGINT) AS sum_trade_count,
  CAST(COALESCE(sum(n) FILTER (WHERE b > 0 OR d), 0) AS BIGINT) AS distinct_trade_ids,
  count(*) FILTER (WHERE d) AS dead_letter_records,
  CAST(COALESCE(sum(n) FILTER (WHERE d), 0) AS BIGINT) AS dead_letter_distinct_trade_ids
FROM (
  SELECT s AS micro_batch, n, CAST(lo % 3 <= s AS INTEGER) + CAST(lo % 5 = 0 AND lo % 3 + 1 <= s AS INTEGER) AS b,
    won IS NULL AND CASE WHEN lo % 7 = 0 THEN 0 ELSE lo % 3 + 1 END <= s AS d
  FROM batch LEFT JOIN tries USING (part, k) CROSS JOIN generate_series(0, 3) AS steps(s))
GROUP BY micro_batch"""
)

ORACLES["stream_fifo"] = (
    f'SELECT partition, "offset" FROM ({_fifo(4, 1, 4)}) WHERE admitted'
)
