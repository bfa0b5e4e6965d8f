"""What each query in `star_queries` means, in plain SQL over the same tables.

Written from the rules, not from the engine: dates by format strings, title case letter by
letter, joins spelled out. Regular expressions are in RE2 syntax.
"""

from __future__ import annotations


def _ascii(x: str) -> str:
    return rf"regexp_replace({x}, '[^\x00-\x7F]', '', 'g')"


def _clean(x: str) -> str:
    return rf"regexp_replace({_ascii(x)}, '^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g')"


def _is_blank(x: str) -> str:
    return rf"regexp_full_match(coalesce({x}, ''), '[\s\x0b\x1c-\x1f]*')"


def _title(x: str) -> str:
    letter = (
        "CASE WHEN i > 1 AND regexp_matches(substr(s, i - 1, 1), '[a-zA-Z]') "
        "THEN lower(substr(s, i, 1)) ELSE upper(substr(s, i, 1)) END"
    ).replace("substr(s", f"substr({_ascii(x)}")
    return (
        f"CASE WHEN {_is_blank(x)} THEN NULL ELSE coalesce(list_aggregate(list_transform("
        f"range(1, length({_ascii(x)}) + 1), lambda i: {letter}), 'string_agg', ''), '') END"
    )


def _key(x: str) -> str:
    return f"CASE WHEN {_is_blank(x)} THEN ' ' ELSE {x} END"


def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _play(raw: str) -> str:
    """A play date in one of the forms the lines use."""
    return f"CAST(try_strptime({raw}, ['%Y-%m-%d', '%m/%d/%Y', '%d%m%Y']) AS DATE)"


def _release(raw: str) -> str:
    return f"CAST(try_strptime({raw}, '%d-%b-%Y') AS DATE)"


_FILE = "c_mktsegment || '_' || strftime(o_orderdate, '%b_%Y') || '.csv'"
_MONTH = r"CAST(last_day(strptime(regexp_extract(file_name, '_([A-Za-z]+_\d+)\.csv$', 1), '%b_%Y')) AS DATE)"
_SONG_ID = f"md5(concat_ws(chr(1), ISRC, Artist, Track, Album, {_iso('Release_Date')}))"

_LINES = f"""
lines AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, n_nationkey AS vendor_key,
    c_mktsegment AS deal_name, n_name AS vendor_name, {_FILE} AS file_name,
    CAST(last_day(o_orderdate) AS DATE) AS report_date,
    p_brand AS Artist, p_name AS Track, p_type || ' vol-' || l_suppkey AS Album,
    CASE WHEN p_size % 5 = 0 THEN '' ELSE 'IS' || p_partkey END AS ISRC,
    CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN 2 THEN strftime(l_shipdate, '%-m/%-d/%Y') ELSE strftime(l_shipdate, '%d%m%Y') END AS Play_Date,
    n_nationkey % 5 = 3 AND month(o_orderdate) = 2 AND l_linenumber = 1 AS spoiled,
    CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate - INTERVAL 30 DAY, '%-d-%b-%Y')
      ELSE '' END AS Release_Date,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS Quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS money, CAST(l_tax AS DECIMAL(18,2)) AS tax,
    lower(n_name) AS Service_Provider, o_orderpriority AS Service_Type, r_name AS Territory,
    'type ' || l_linestatus AS Type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_ORDER_FILES = """
order_files AS (
  SELECT c_mktsegment AS deal_name, n_name AS vendor_name, {name} AS file_name, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL
)"""
_MONTHLY = _ORDER_FILES.format(name=_FILE)

_VENDOR_LOOKUP = """
lookup AS (
  SELECT n_name AS vendor_name, 'Cat ' || n_regionkey AS sale_category FROM nation
  WHERE n_nationkey % 4 <> 0
)"""

# Decimal sum as text, with zeros dropped but for the first digit after the point.
_TEXT_SUM = (
    "regexp_replace(CAST(CAST(money + CASE WHEN line_number % 3 = 0 THEN 0 ELSE tax END "
    r"AS DECIMAL(28,10)) AS VARCHAR), '(\.[0-9]+?)0+$', '\1')"
)
_FEE = "CASE WHEN line_number % 3 = 0 THEN NULL ELSE CAST(tax AS VARCHAR) END"

_CONFORMED = f"""
conformed AS (
  SELECT deal_name, vendor_name, file_name, report_date, vendor_key, line_number, money, tax, spoiled,
    k, CASE WHEN k = 2 THEN Service_Provider ELSE vendor_name END AS Source,
    CASE WHEN k <> 2 THEN Artist END AS Artist, CASE WHEN k <> 2 THEN Track END AS Track,
    CASE WHEN k <> 1 THEN Album END AS Album, CASE WHEN k <> 1 THEN nullif(ISRC, '') END AS ISRC,
    CASE WHEN k = 2 THEN NULL WHEN spoiled THEN 'soon' ELSE nullif(Play_Date, '') END AS Play_Date,
    CASE WHEN k = 2 THEN nullif(Release_Date, '') END AS Release_Date,
    CASE WHEN k <> 2 THEN Quantity END AS Quantity,
    CASE WHEN k = 1 THEN {_TEXT_SUM} ELSE '$' || money END AS Net_Payment,
    CAST(NULL AS VARCHAR) AS Service_Provider, CASE WHEN k = 2 THEN Service_Type END AS Service_Type,
    CASE WHEN k = 0 THEN Territory END AS Territory, CASE WHEN k = 2 THEN Type END AS Type
  FROM (SELECT *, vendor_key % 3 AS k FROM lines)
)"""

_LOADED = f"""
loaded AS (
  SELECT deal_name, vendor_name, file_name, deal_name AS Deal, Source, {_iso('report_date')} AS Report_Date,
    coalesce(Artist, deal_name) AS Artist, coalesce(Track, Type) AS Track, Album, ISRC,
    {_iso(_play('coalesce(Play_Date, ' + _iso('report_date') + ')'))} AS Play_Date, Release_Date,
    sale_category AS Sale_Category, Quantity, Net_Payment, Service_Provider, Service_Type, Territory,
    CASE WHEN k = 1 THEN coalesce({_FEE}, '0.0') END AS Fee, k <> 2 AND spoiled AS bad,
    money + CASE WHEN k = 1 AND line_number % 3 <> 0 THEN tax ELSE 0 END AS net
  FROM conformed JOIN lookup USING (vendor_name)
)"""
_LOAD = f"WITH {_LINES}, {_VENDOR_LOOKUP}, {_CONFORMED}, {_LOADED}"

_SONG_ROWS = f"""
song_rows AS (
  SELECT order_key, {_key('ISRC')} AS ISRC, Artist, Track, Album, Release_Date AS release_raw,
    coalesce({_play("nullif(Play_Date, '')")}, report_date) AS song_date
  FROM lines
)"""


def _candidates(date: str, where: str = "true") -> str:
    # Title case is applied to the distinct names; grouping again merges equal spellings.
    return f"""
  SELECT ISRC, {_title('Artist')} AS Artist, {_title('Track')} AS Track, {_title('Album')} AS Album,
    min(d) AS Release_Date
  FROM (SELECT ISRC, Artist, Track, Album, min({date}) AS d FROM song_rows WHERE {where} GROUP BY ALL)
  GROUP BY ALL"""


_SIDES = f"""WITH {_LINES}, {_SONG_ROWS},
held AS ({_candidates('song_date', 'order_key % 2 = 0')}),
fresh AS ({_candidates('song_date', 'order_key % 2 = 1')}),
both_sides AS (
  SELECT h.Release_Date AS held_date, f.Release_Date AS new_date,
    coalesce(h.ISRC, f.ISRC) AS ISRC, coalesce(h.Artist, f.Artist) AS Artist,
    coalesce(h.Track, f.Track) AS Track, coalesce(h.Album, f.Album) AS Album
  FROM held h FULL JOIN fresh f
    ON h.ISRC = f.ISRC AND h.Artist = f.Artist AND h.Track = f.Track AND h.Album = f.Album
)"""


def _version(date: str, alias: str = "id") -> str:
    return _SONG_ID.replace("Release_Date", date) + f" AS {alias}"


_FINAL = "ISRC, Artist, Track, Album"
_DELTA = f"""
  SELECT {_version('new_date')}, {_FINAL}, {_iso('new_date')} AS Release_Date, 'Y' AS is_latest
  FROM both_sides WHERE new_date IS NOT NULL"""

# The odd orders' files upon the even orders' songs: each takes effect after those before it.
_HISTORY = f"""{_SIDES},
by_file AS (
  SELECT ISRC, {_title('Artist')} AS Artist, {_title('Track')} AS Track, {_title('Album')} AS Album,
    report_date, path, min(d) AS d
  FROM (
    SELECT {_key('ISRC')} AS ISRC, Artist, Track, Album, report_date,
      deal_name || '/' || vendor_name || '/' || file_name AS path,
      min(coalesce({_play("nullif(Play_Date, '')")}, report_date)) AS d
    FROM lines WHERE order_key % 2 = 1 GROUP BY ALL)
  GROUP BY ALL),
in_turn AS (
  SELECT by_file.*, least(h.Release_Date, min(d) OVER (PARTITION BY by_file.ISRC, by_file.Artist,
      by_file.Track, by_file.Album ORDER BY report_date, path
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS before
  FROM by_file LEFT JOIN held h ON h.ISRC = by_file.ISRC AND h.Artist = by_file.Artist
    AND h.Track = by_file.Track AND h.Album = by_file.Album),
history AS (
  SELECT {_FINAL}, d, before,
    CASE WHEN d = min(d) OVER (PARTITION BY {_FINAL}) THEN 'Y' ELSE 'N' END AS is_latest
  FROM in_turn WHERE before IS NULL OR d < before)"""

_PLANNED = f"""
planned AS (
  SELECT DISTINCT deal_name, vendor_name, file_name, vendor_key % 3 AS k FROM lines
)"""

ORACLES: dict[str, str] = {
    "file_manifest": f"""WITH {_MONTHLY}
SELECT deal_name, vendor_name, file_name, {_iso(_MONTH)} AS report_date, orders FROM order_files""",
    "quarter_report_date": "WITH "
    + _ORDER_FILES.format(name="'sales_qt' || quarter(o_orderdate) || '_' || year(o_orderdate) || '.csv'")
    + r"""
SELECT deal_name, vendor_name, file_name, strftime(last_day(make_date(
  CAST(regexp_extract(file_name, '_(\d+)\.csv', 1) AS INT),
  3 * CAST(regexp_extract(file_name, 'qt(\d)', 1) AS INT), 1)), '%Y-%m-%d') AS report_date, orders
FROM order_files""",
    "pending_files": f"""WITH {_MONTHLY}, dated AS (
  SELECT deal_name, vendor_name, file_name, {_MONTH} AS report_date FROM order_files)
SELECT deal_name, vendor_name, file_name, {_iso('report_date')} AS report_date FROM dated f
WHERE NOT EXISTS (SELECT 1 FROM dated l WHERE l.deal_name = f.deal_name
  AND l.vendor_name = f.vendor_name AND l.file_name = f.file_name AND year(l.report_date) < 1998)""",
    "one_file_per_identity": f"""
SELECT c_mktsegment AS deal_name, 'all' AS vendor_name, {_FILE} AS file_name,
  min('root-' || substr(o_orderpriority, 1, 1) || '/' || c_mktsegment || '/all/' || {_FILE}) AS path
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "new_header_versions": f"""WITH files AS (
  SELECT c_mktsegment AS deal_name, 'V' || c_nationkey AS vendor_name,
    CAST(last_day(o_orderdate) AS DATE) AS report_date,
    'artist ' || lower(o_orderstatus) || ',track,_c2,' || lower(o_orderpriority) AS file_headers
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT deal_name, vendor_name, file_headers, {_iso('min(report_date)')} AS report_date FROM files f
WHERE year(report_date) >= 1996 AND NOT EXISTS (
  SELECT 1 FROM files r WHERE year(r.report_date) < 1996 AND r.deal_name = f.deal_name
    AND r.vendor_name = f.vendor_name AND r.file_headers = f.file_headers)
GROUP BY deal_name, vendor_name, file_headers""",
    "ascii_cleaned": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
    "blank_lines": f"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE {_is_blank('line')}) AS n_blank
FROM l GROUP BY doc_id""",
    "title_case": f"""WITH every AS (
  SELECT p_name || '/' || p_type AS source FROM part
  UNION ALL SELECT c_mktsegment || '''s ' || c_name FROM customer
  UNION ALL SELECT r_name FROM region UNION ALL SELECT o_orderpriority FROM orders)
SELECT source, count(*) AS uses, {_title('source')} AS titled FROM every GROUP BY source""",
    "key_blank_fill": f"""WITH {_LINES}
SELECT {_key('ISRC')} AS ISRC, count(*) AS lines FROM lines GROUP BY ALL""",
    "play_date_normalised": f"""WITH {_LINES}
SELECT {_iso('report_date')} AS report_date,
  {_iso('coalesce(' + _play("nullif(Play_Date, '')") + ', report_date)')} AS play_date,
  {_iso(_release("nullif(Release_Date, '')"))} AS release_date, count(*) AS lines
FROM lines GROUP BY ALL""",
    "combined_amount_lines": f"""WITH {_LINES}
SELECT order_key, line_number, '$' || money AS Net_Payment, coalesce({_FEE}, '') AS Fee,
  {_TEXT_SUM} AS total FROM lines""",
    "header_layouts": f"""WITH {_LINES}, {_PLANNED}
SELECT CASE k WHEN 0 THEN 'performer,song title,release,isrc code,sale date,units,payable,region name'
    WHEN 1 THEN 'net,artist,fee,track,play_date,quantity'
    ELSE 'type,source,album,isrc,release_date,net_payment,service_type' END AS file_headers,
  CASE k WHEN 0 THEN '6' WHEN 1 THEN '0+2' ELSE '5' END AS net_payment_at, count(*) AS files
FROM planned GROUP BY k""",
    "conform_aliases": f"""WITH {_LINES}, {_CONFORMED}
SELECT deal_name, vendor_name, file_name, Source, Artist, Track, Album, ISRC, Play_Date, Release_Date,
  Quantity, Net_Payment, Service_Provider, Service_Type, Territory, Type, count(*) AS lines
FROM conformed GROUP BY ALL""",
    "track_from_type": """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS Track FROM part""",
    "artist_default": """
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 2 THEN c_name ELSE c_mktsegment END AS Artist
FROM customer""",
    "sale_category": f"""WITH {_VENDOR_LOOKUP}
SELECT n_name AS vendor_name, count(*) AS lines, any_value(sale_category) AS sale_category
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN lookup ON n_name = vendor_name GROUP BY n_name""",
    "payment_rows": f"""{_LOAD}
SELECT Deal, Source, Report_Date, {_title('Artist')} AS Artist, {_title('Track')} AS Track,
  {_title('Album')} AS Album, ISRC, Play_Date, Release_Date, Sale_Category, Quantity, Net_Payment,
  {_title('Service_Provider')} AS Service_Provider, {_title('Service_Type')} AS Service_Type,
  {_title('Territory')} AS Territory, file_name AS File_Name, count(*) AS lines
FROM loaded GROUP BY ALL""",
    "payment_rows_wide": f"""{_LOAD}
SELECT Deal, Source, Report_Date, {_title('Artist')} AS Artist, {_title('Track')} AS Track,
  {_title('Album')} AS Album, ISRC, Play_Date, Release_Date, Sale_Category, Quantity, Net_Payment,
  {_title('Service_Provider')} AS Service_Provider, {_title('Service_Type')} AS Service_Type,
  file_name AS File_Name, Fee, Territory AS Market, CAST(NULL AS VARCHAR) AS Currency, count(*) AS lines
FROM loaded GROUP BY ALL""",
    "ledger_totals": f"""WITH {_LINES}
SELECT deal_name, vendor_name, file_name, CAST(sum(money) AS DOUBLE) AS total_net_payment
FROM lines GROUP BY ALL""",
    "rejected_files": f"""{_LOAD}
SELECT 's3://bucket/in/' || deal_name || '/' || vendor_name || '/' || file_name AS file_path,
  'not a date: Play_Date' AS reason, count(*) AS bad_rows FROM loaded WHERE bad GROUP BY ALL""",
    "accepted_totals": f"""{_LOAD}
SELECT deal_name, vendor_name, file_name, CAST(sum(net) AS DOUBLE) AS total_net_payment
FROM loaded GROUP BY ALL HAVING NOT bool_or(bad)""",
    "accepted_lines": f"""{_LOAD}
SELECT 's3://bucket/in/' || deal_name || '/' || vendor_name || '/' || file_name AS file_path,
  count(*) AS lines FROM loaded GROUP BY ALL HAVING NOT bool_or(bad)""",
    "amount_rejects": """
SELECT l_linenumber, amount_text, count(*) AS lines, amount_text NOT IN ('$1,234.50', '7.250') AS rejected
FROM (SELECT l_linenumber, CASE l_orderkey % 6 WHEN 0 THEN '(12.50)' WHEN 1 THEN '1 234' WHEN 2 THEN '$1,234.50'
  WHEN 3 THEN '1234567890123456789.5' WHEN 4 THEN '0.12345678901' ELSE '7.250' END AS amount_text FROM lineitem)
GROUP BY ALL""",
    "files_without_category": f"""WITH {_LINES}, {_PLANNED}, {_VENDOR_LOOKUP}
SELECT vendor_name, 'vendor has no sale category' AS reason, count(*) AS files
FROM planned WHERE vendor_name NOT IN (SELECT vendor_name FROM lookup) GROUP BY vendor_name""",
    "idempotent_append": f"""WITH {_LINES}
SELECT deal_name, vendor_name, file_name, count(*) AS lines, sum(CAST(Quantity AS BIGINT))::BIGINT AS quantity
FROM lines l WHERE NOT EXISTS (SELECT 1 FROM lines h WHERE h.deal_name = l.deal_name
  AND h.vendor_name = l.vendor_name AND h.file_name = l.file_name AND year(h.report_date) < 1998)
GROUP BY ALL""",
    "song_candidates_play": f"""WITH {_LINES}, {_SONG_ROWS}, c AS ({_candidates('song_date')})
SELECT {_FINAL}, {_iso('Release_Date')} AS Release_Date FROM c""",
    "song_candidates_release": f"""WITH {_LINES}, {_SONG_ROWS}, c AS (
{_candidates('coalesce(' + _release("nullif(release_raw, '')") + ', song_date)')})
SELECT {_FINAL}, {_iso('Release_Date')} AS Release_Date FROM c""",
    "song_reconcile": f"""{_SIDES}
SELECT {_FINAL}, {_iso('held_date')} AS held_date, {_iso('new_date')} AS new_date,
  CASE WHEN held_date IS NULL THEN 'insert' WHEN new_date IS NULL THEN 'untouched'
    WHEN new_date < held_date THEN 'update' ELSE 'keep' END AS action FROM both_sides""",
    "song_inserts": f"{_SIDES} {_DELTA} AND held_date IS NULL",
    "song_updates": f"""{_SIDES}
SELECT {_version('new_date')}, {_FINAL}, {_iso('new_date')} AS Release_Date, 'Y' AS is_latest,
  {_version('held_date', 'replaces_id')} FROM both_sides WHERE new_date < held_date""",
    "song_retired": f"{_SIDES} SELECT {_version('held_date')} FROM both_sides WHERE new_date < held_date",
    "song_delta": f"{_SIDES} {_DELTA} AND (held_date IS NULL OR new_date < held_date)",
    "song_table_after": f"""{_SIDES}
SELECT {_version('held_date')}, {_FINAL}, {_iso('held_date')} AS Release_Date,
  CASE WHEN new_date < held_date THEN 'N' ELSE 'Y' END AS is_latest
FROM both_sides WHERE held_date IS NOT NULL
UNION ALL {_DELTA} AND (held_date IS NULL OR new_date < held_date)""",
    "song_history": f"""{_HISTORY}
SELECT {_version('d')}, {_FINAL}, {_iso('d')} AS Release_Date, is_latest,
  CASE WHEN before IS NOT NULL THEN {_version('before').removesuffix(' AS id')} END AS replaces_id FROM history""",
    "song_history_after": f"""{_HISTORY}
SELECT {_version('Release_Date')}, {_FINAL}, {_iso('Release_Date')} AS Release_Date,
  CASE WHEN ({_FINAL}) IN (SELECT ({_FINAL}) FROM history) THEN 'N' ELSE 'Y' END AS is_latest FROM held
UNION ALL SELECT {_version('d')}, {_FINAL}, {_iso('d')}, is_latest FROM history""",
    "song_current_after": f"""{_SIDES}
SELECT {_FINAL}, {_iso('least(held_date, new_date)')} AS Release_Date FROM both_sides""",
    "isrc_backfills": f"""WITH {_LINES}, {_SONG_ROWS},
named AS (
  SELECT order_key % 2 AS side, ISRC, {_title('Artist')} AS Artist, {_title('Track')} AS Track,
    ' ' AS Album, min(song_date) AS d
  FROM (SELECT order_key % 2 AS order_key, ISRC, Artist, Track, min(song_date) AS song_date
        FROM song_rows GROUP BY ALL) GROUP BY ALL),
held AS (
  SELECT CASE WHEN length(ISRC) % 2 = 1 THEN ' ' ELSE ISRC END AS ISRC, Artist, Track, Album, min(d) AS d
  FROM named WHERE side = 0 GROUP BY ALL),
fresh AS (SELECT ISRC, Artist, Track, Album, d FROM named WHERE side = 1),
chosen AS (
  SELECT Artist, Track, Album, min(ISRC) AS ISRC, arg_min(d, ISRC) AS d FROM fresh
  WHERE ISRC <> ' ' AND NOT EXISTS (SELECT 1 FROM held h WHERE h.ISRC = fresh.ISRC
    AND h.Artist = fresh.Artist AND h.Track = fresh.Track) GROUP BY ALL),
filled AS (
  SELECT c.ISRC, c.Artist, c.Track, c.Album, h.d AS held_date, least(h.d, c.d, b.d) AS new_date,
    {_SONG_ID.replace('Release_Date', 'h.d').replace('ISRC, Artist, Track, Album', "' ', h.Artist, h.Track, ' '")}
      AS replaces_id
  FROM chosen c JOIN held h ON h.ISRC = ' ' AND h.Artist = c.Artist AND h.Track = c.Track
    LEFT JOIN fresh b ON b.ISRC = ' ' AND b.Artist = c.Artist AND b.Track = c.Track)
SELECT {_version('new_date')}, {_FINAL}, {_iso('new_date')} AS Release_Date, replaces_id FROM filled""",
    "song_history_backfilled": f"""WITH {_LINES},
named AS (
  SELECT side, ISRC, {_title('Artist')} AS Artist, {_title('Track')} AS Track, ' ' AS Album, report_date, path,
    min(d) AS d
  FROM (
    SELECT order_key % 2 AS side, Artist, Track, report_date,
      CASE WHEN line_number IN (2, 6) AND ISRC <> '' THEN ISRC || '-' || line_number ELSE ' ' END AS ISRC,
      deal_name || '/' || vendor_name || '/' || file_name AS path,
      min(coalesce({_play("nullif(Play_Date, '')")}, report_date)) AS d
    FROM lines WHERE order_key % 2 = 1 OR order_key % 8 = 0 GROUP BY ALL)
  GROUP BY ALL),
held AS (SELECT {_FINAL}, min(d) AS d FROM named WHERE side = 0 GROUP BY ALL),
held_titles AS (
  SELECT Artist, Track, min(ISRC) FILTER (ISRC <> ' ') AS isrc, min(d) FILTER (ISRC = ' ') AS d
  FROM held GROUP BY ALL),
titles AS (
  SELECT Artist, Track, report_date, path, min(ISRC) FILTER (ISRC <> ' ') AS own, min(d) FILTER (ISRC = ' ') AS d
  FROM named WHERE side = 1 GROUP BY ALL),
turns AS (
  SELECT t.Artist, t.Track, report_date, path, t.d, coalesce(least(min(own) OVER before, h.isrc), own) AS heir,
    least(min(t.d) OVER before, h.d) AS held_d
  FROM titles t LEFT JOIN held_titles h ON h.Artist = t.Artist AND h.Track = t.Track
  WINDOW before AS (PARTITION BY t.Artist, t.Track ORDER BY report_date, path
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
firsts AS (
  SELECT * FROM turns WHERE heir IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY Artist, Track ORDER BY report_date, path) = 1),
taken AS (SELECT * FROM firsts WHERE held_d IS NOT NULL),
by_file AS (
  SELECT {_FINAL}, report_date, path, min(d) AS d, min(fill) AS fill
  FROM (
    SELECT {_FINAL}, report_date, path, d, NULL AS fill FROM named WHERE side = 1 AND ISRC <> ' '
    UNION ALL SELECT coalesce(heir, ' '), Artist, Track, ' ', report_date, path, d, NULL FROM turns WHERE d IS NOT NULL
    UNION ALL SELECT heir, Artist, Track, ' ', report_date, path, held_d, held_d FROM taken)
  GROUP BY ALL),
in_turn AS (
  SELECT by_file.*, least(h.d, min(by_file.d) OVER (PARTITION BY by_file.ISRC, by_file.Artist, by_file.Track
      ORDER BY report_date, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS before
  FROM by_file LEFT JOIN held h ON h.ISRC = by_file.ISRC AND h.Artist = by_file.Artist AND h.Track = by_file.Track),
versions AS (
  SELECT {_FINAL}, d, NULL AS before, NULL AS fill FROM held
  UNION ALL SELECT {_FINAL}, d, before, fill FROM in_turn WHERE before IS NULL OR d < before)
SELECT {_version('d')}, {_FINAL}, {_iso('d')} AS Release_Date,
  CASE WHEN d = min(d) OVER (PARTITION BY {_FINAL})
    AND NOT (ISRC = ' ' AND (Artist, Track) IN (SELECT (Artist, Track) FROM taken)) THEN 'Y' ELSE 'N' END AS is_latest,
  CASE WHEN before IS NOT NULL THEN {_version('before').removesuffix(' AS id')}
    WHEN fill IS NOT NULL THEN {_version('fill').replace('ISRC, ', "' ', ").removesuffix(' AS id')} END AS replaces_id
FROM versions""",
}
