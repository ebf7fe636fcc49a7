"""The registered queries as independent SQL over the given tables, for comparison."""

from __future__ import annotations

from ebbline.functions.series import NUMERIC_FEATURES
from ebbline.params import SEED

# Shared subqueries: name -> (subqueries it reads, text).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, body: str, *needs: str) -> None:
    PARTS[name] = (needs, body)


def with_parts(body: str, *names: str) -> str:
    """The query with the subqueries it needs, each once, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in PARTS[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + body


def r(value: str, name: str = "", digits: int = 6) -> str:
    """A rounded double without negative zero; the shift keeps exact halves off the boundary."""
    half = f"{0.5 * 10**-digits:.10f}"
    shifted = f"(({value})::DOUBLE + 3e-{digits + 2})"
    return f"CASE WHEN abs{shifted} < {half} THEN 0.0 ELSE round({shifted}, {digits}) END AS {name or value}"


def rs(*names: str, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names)


def dense(keys: list[str], salt: object = "") -> str:
    """Position in hash order, as the surrogate keys are numbered."""
    text = " || '|' || ".join(f"coalesce({k}::VARCHAR, '')" for k in keys)
    return f"row_number() OVER (ORDER BY md5('{salt}|' || {text}), {', '.join(keys)})"


ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
META_UTC = "'2024-01-01T00:00:00+00:00'"

part(
    "monthly",
    """SELECT l_partkey AS app_id, date_trunc('month', l_shipdate)::DATE AS month,
       avg(CASE WHEN l_discount > 0 THEN l_quantity END) AS avg_players,
       max(CASE WHEN l_tax > 0 THEN l_extendedprice ELSE 0 END) AS peak_players,
       max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1, 2""",
)
part(
    "long",
    f"""SELECT app_id, month_index, strftime(month, '%B %Y') AS month_label, avg_players, peak_players,
       strftime(last_ship, {ISO}) AS scraped_utc, last_ship,
       'https://activity.example.org/app/' || app_id || '?view="avg, peak"' AS url
FROM (SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY month DESC) AS month_index FROM monthly)""",
    "monthly",
)
part("newest", "SELECT * FROM long WHERE month_index <= 12", "long")
part(
    "outcomes",
    f"""SELECT app_id, max(url) AS url, strftime(max(last_ship), {ISO}) AS scraped_utc,
       CASE WHEN zeros >= 2 THEN 'not_found' WHEN missing >= 3 THEN 'error' WHEN missing = 2 THEN 'no_table' ELSE 'ok' END AS status
FROM (SELECT *, count(*) FILTER (WHERE peak_players = 0) OVER (PARTITION BY app_id) AS zeros,
             count(*) FILTER (WHERE avg_players IS NULL) OVER (PARTITION BY app_id) AS missing FROM newest)
GROUP BY app_id, zeros, missing""",
    "newest",
)
part(
    "open_ids",
    """SELECT l_partkey AS app_id FROM lineitem UNION SELECT o_custkey FROM orders
EXCEPT SELECT app_id FROM outcomes WHERE status <> 'error'""",
    "outcomes",
)
part(
    "meta",
    f"""SELECT p_partkey AS app_id, p_type = 'PROMO' AS is_free,
       CASE WHEN p_size <> 7 THEN round(p_retailprice - 900, 2) END AS price_usd, released,
       CASE WHEN p_size = 9 THEN NULL WHEN p_type IN ('ECONOMY', 'STANDARD') THEN strftime(released, '%-d %b, %Y')
            WHEN p_type = 'LARGE' THEN strftime(released, '%b %-d, %Y') WHEN p_type = 'MEDIUM' THEN strftime(released, '%b %Y')
            WHEN p_type = 'PROMO' THEN 'Coming Soon' ELSE 'To be announced (TBA)' END AS release_date_str,
       CASE WHEN p_size = 9 OR p_type IN ('PROMO', 'SMALL') THEN NULL
            WHEN p_type = 'MEDIUM' THEN date_trunc('month', released)::DATE ELSE released END AS release_date,
       string_split(p_name, ' ') AS genres, [p_type, p_brand, 'Size-' || p_size] AS categories,
       p_type, p_size, p_brand, p_name
FROM (SELECT *, DATE '1992-01-01' + (p_size * 40 + floor(p_retailprice)::INT)::INT AS released FROM part)""",
)
part(
    "typed",
    """SELECT app_id::INT AS app_id,
       CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'PROMO' THEN 0 END AS is_free,
       CASE WHEN p_size <> 24 THEN price_usd END AS price_usd, release_date_str, release_date,
       array_to_string(genres, '|') AS genres_csv,
       array_to_string([p_type, p_brand, ' Size-' || p_size], '|') AS categories_csv, genres, categories, p_size
FROM meta WHERE p_size NOT IN (21, 23)""",
    "meta",
)
TIER = """CASE WHEN coalesce({free}, false) OR {price} IS NULL OR {price} = 0 THEN 'Free' WHEN {price} < 10 THEN 'Under_10'
 WHEN {price} < 30 THEN '10_29' WHEN {price} < 60 THEN '30_59' ELSE '60_plus' END"""
part(
    "apps",
    f"""SELECT {dense(["app_id"])} AS app_sk, app_id, is_free::BOOLEAN AS is_free, price_usd,
       {TIER.format(free="is_free::BOOLEAN", price="price_usd")} AS price_tier, release_date, release_date_str
FROM typed""",
    "typed",
)
part(
    "dates",
    f"""SELECT {dense(["month_label", "month_index"])} AS date_sk, month_label, month_index,
       strptime('1 ' || month_label, '%-d %B %Y')::DATE AS month_start_date
FROM (SELECT DISTINCT month_label, month_index FROM long)""",
    "long",
)
NORM = "lower(replace(replace(replace(trim({0}), '-', ' '), '_', ' '), '  ', ' '))"
part(
    "items",
    f"""SELECT app_id, kind, trim(tag) AS tag_name, {NORM.format("tag")} AS tag_norm FROM (
  SELECT app_id, 'genre' AS kind, unnest(genres) AS tag FROM typed
  UNION ALL SELECT app_id, 'category', unnest(categories) FROM typed)""",
    "typed",
)
part(
    "tags",
    """SELECT row_number() OVER (PARTITION BY kind ORDER BY md5('|' || tag_norm), tag_norm) AS tag_sk, kind, tag_name, tag_norm
FROM (SELECT kind, tag_norm, min(tag_name) AS tag_name FROM items GROUP BY ALL)""",
    "items",
)
part(
    "bridges",
    """SELECT DISTINCT kind, app_sk, tag_sk, tag_name FROM items JOIN tags USING (kind, tag_norm)
JOIN apps USING (app_id)""".replace("tag_sk, tag_name FROM", "tag_sk, tags.tag_name FROM"),
    "items", "tags", "apps",
)
part(
    "fact",
    """SELECT app_sk, date_sk, avg_players, peak_players, scraped_utc, long.month_index AS month_index
FROM long JOIN dates USING (month_label, month_index) JOIN apps USING (app_id)""",
    "long", "dates", "apps",
)
part(
    "persistence",
    """SELECT app_id, app_sk, price_tier, is_free, recent AS avg_players_recent, past AS avg_players_6mo_ago,
       recent / nullif(past, 0) AS persistence_6m_ratio
FROM (SELECT a.app_id, a.avg_players AS recent, b.avg_players AS past FROM long a
      LEFT JOIN long b ON a.app_id = b.app_id AND strptime(b.month_label, '%B %Y') = strptime(a.month_label, '%B %Y') - INTERVAL 6 MONTH
      WHERE a.month_index = 1)
JOIN apps USING (app_id)""",
    "long", "apps",
)
part(
    "growth",
    """SELECT app_id, price_tier, is_free, avg_players_recent, avg_players_6mo_ago, persistence_6m_ratio,
       CASE WHEN persistence_6m_ratio >= 1 THEN 'Growth' ELSE 'Decay' END AS trend_bucket,
       abs(ln(persistence_6m_ratio)) AS abs_log_change
FROM persistence WHERE persistence_6m_ratio > 0""",
    "persistence",
)
part(
    "curve",
    """SELECT month_index, month_label, count(*) AS row_count, avg(avg_players) AS avg_avg_players, avg(peak_players) AS avg_peak_players
FROM long GROUP BY ALL""",
    "long",
)
part(
    "tag_mart",
    """SELECT kind, tag_name, count(*) AS game_count, avg(persistence_6m_ratio) AS avg_retention_ratio,
       avg(avg_players_recent) AS avg_players_recent, avg(avg_players_6mo_ago) AS avg_players_6mo_ago
FROM bridges JOIN persistence USING (app_sk) GROUP BY ALL""",
    "bridges", "persistence",
)
part(
    "tier_mart",
    """SELECT price_tier, is_free, count(*) AS game_count, avg(persistence_6m_ratio) AS avg_retention_ratio,
       avg(avg_players_recent) AS avg_players_recent, avg(avg_players_6mo_ago) AS avg_players_6mo_ago
FROM persistence GROUP BY ALL""",
    "persistence",
)
part(
    "valid",
    """SELECT app_id, month_label, avg_players, peak_players, count(*) OVER (PARTITION BY app_id) AS n_valid,
       row_number() OVER (PARTITION BY app_id ORDER BY month_index DESC) - 1 AS k_index
FROM newest WHERE avg_players IS NOT NULL AND peak_players IS NOT NULL""",
    "newest",
)
part(
    "lagged",
    """SELECT *, lag(avg_players, 1) OVER w AS a1, lag(avg_players, 2) OVER w AS a2, lead(avg_players, 6) OVER w AS ay,
       lag(peak_players, 1) OVER w AS p1, lag(peak_players, 2) OVER w AS p2, lead(peak_players, 6) OVER w AS py
FROM valid WINDOW w AS (PARTITION BY app_id ORDER BY k_index)""",
    "valid",
)


def _log_std(c: str, l1: str, l2: str) -> str:
    mean = f"((ln({c}) + ln({l1}) + ln({l2})) / 3)"
    return "sqrt((" + " + ".join(f"power(ln({x}) - {mean}, 2)" for x in (c, l1, l2)) + ") / 3)"


def shape(a: tuple[str, str, str], p: tuple[str, str, str]) -> str:
    """Feature expressions from current, previous and oldest values."""
    (a0, a1, a2), (p0, p1, p2) = a, p
    return f"""{a0} AS avg_k, {a1} AS avg_km1, {a2} AS avg_km2, {p0} AS peak_k, {p1} AS peak_km1, {p2} AS peak_km2,
 {a0} / {a1} - 1 AS avg_growth_k, {a1} / {a2} - 1 AS avg_growth_km1,
 {p0} / {p1} - 1 AS peak_growth_k, {p1} / {p2} - 1 AS peak_growth_km1,
 {a0} / {p0} AS avg_over_peak_k, {a1} / {p1} AS avg_over_peak_km1, ln({a0}) AS log_avg_k, ln({p0}) AS log_peak_k,
 ln({a0}) - ln({a2}) AS trend3_log_avg, ln({p0}) - ln({p2}) AS trend3_log_peak,
 ln({a0}) - 2 * ln({a1}) + ln({a2}) AS curv_log_avg, ln({p0}) - 2 * ln({p1}) + ln({p2}) AS curv_log_peak,
 {_log_std(a0, a1, a2)} AS vol3_log_avg, {_log_std(p0, p1, p2)} AS vol3_log_peak,
 ln({p0}) - ln({a0}) AS shock_log_peak_avg"""


part(
    "panel_base",
    f"""SELECT app_id, k_index, k_index::DOUBLE AS age_months,
       ((year(m) - year(release_date)) * 12 + month(m) - month(release_date))::DOUBLE AS age_since_release_months,
       month_label AS month_k_label, ay AS y_avg, py AS y_peak, ln(ay) AS y_log_avg, ln(py) AS y_log_peak,
       {shape(("avg_players", "a1", "a2"), ("peak_players", "p1", "p2"))},
       is_free::INT AS is_free, price_usd, release_date_str, genres, categories
FROM (SELECT *, strptime('1 ' || month_label, '%-d %B %Y')::DATE AS m FROM lagged
      WHERE n_valid >= 12 AND least(avg_players, a1, a2, ay, peak_players, p1, p2, py) > 0
        AND a2 IS NOT NULL AND ay IS NOT NULL)
JOIN meta USING (app_id)""",
    "lagged", "meta",
)
part(
    "rows_",
    "SELECT *, ln(greatest(avg_k, 1e-9)) AS base_log, y_log_avg - ln(greatest(avg_k, 1e-9)) AS delta FROM panel_base",
    "panel_base",
)
part(
    "predicted",
    """SELECT *, 0.5 * trend3_log_avg - 0.3 AS d10, 0.5 * trend3_log_avg AS d50, 0.5 * trend3_log_avg + 0.3 AS d90 FROM rows_""",
    "rows_",
)
part("wide_ids", "SELECT DISTINCT app_id FROM long", "long")
part(
    "vocab_counts",
    """SELECT kind, tag, count(*) AS tag_count FROM (
  SELECT 'genre' AS kind, unnest(genres) AS tag FROM meta JOIN wide_ids USING (app_id)
  UNION ALL SELECT 'category', unnest(categories) FROM meta JOIN wide_ids USING (app_id)) GROUP BY ALL""",
    "meta", "wide_ids",
)
part(
    "vocab_ranked",
    "SELECT *, row_number() OVER (PARTITION BY kind ORDER BY tag_count DESC, tag) AS rank FROM vocab_counts",
    "vocab_counts",
)
part(
    "vocab",
    "SELECT * FROM vocab_ranked WHERE rank <= CASE kind WHEN 'genre' THEN 80 ELSE 120 END",
    "vocab_ranked",
)
part(
    "score_in",
    """SELECT app_id,
       max(avg_players) FILTER (WHERE month_index = 3) AS a1, max(avg_players) FILTER (WHERE month_index = 2) AS a2,
       max(avg_players) FILTER (WHERE month_index = 1) AS a3, max(peak_players) FILTER (WHERE month_index = 3) AS p1,
       max(peak_players) FILTER (WHERE month_index = 2) AS p2, max(peak_players) FILTER (WHERE month_index = 1) AS p3
FROM long GROUP BY app_id""",
    "long",
)
part(
    "scored",
    """SELECT s.*, m.*, CASE WHEN a1 IS NULL THEN 'Missing value: avg_m1' WHEN a2 IS NULL THEN 'Missing value: avg_m2'
       WHEN a3 IS NULL THEN 'Missing value: avg_m3' WHEN p1 IS NULL THEN 'Missing value: peak_m1'
       WHEN p2 IS NULL THEN 'Missing value: peak_m2' WHEN p3 IS NULL THEN 'Missing value: peak_m3'
       WHEN least(a1, a2, a3, p1, p2, p3) <= 0 THEN 'All avg/peak values must be > 0.'
       WHEN p_size = 31 AND p_type <> 'PROMO' THEN 'invalid literal for int() with base 10: ''maybe''' ELSE '' END AS row_error
FROM score_in s JOIN (SELECT * EXCLUDE (app_id), app_id AS part_id FROM meta) m ON s.app_id = part_id""",
    "score_in", "meta",
)
WIDE_COLUMNS = [f"month{i}_{c}" for i in range(1, 13) for c in ("label", "avg_players", "peak_players")]


def _wide() -> str:
    out = []
    for i in range(1, 13):
        at = f"FILTER (WHERE month_index = {i})"
        out.append(f"max(month_label) {at} AS month{i}_label")
        out.append(r(f"max(avg_players) {at}", f"month{i}_avg_players"))
        out.append(r(f"max(peak_players) {at}", f"month{i}_peak_players"))
    return ", ".join(out)


PART_SHOWN = f"""SELECT app_id, status, CASE WHEN status = 'not_found' THEN 404 WHEN status = 'no_table' THEN 200 END AS status_code,
 CASE WHEN status = 'error' THEN 'timeout' END AS error, scraped_utc, url, CASE WHEN status = 'ok' THEN 1234.5::DOUBLE END AS last30_avg_players,
 {r("max(peak_players) FILTER (WHERE month_index = 1)", "last30_peak_players")}, {_wide()}
FROM (SELECT o.app_id, status, o.scraped_utc, o.url, month_index, CASE WHEN status = 'ok' THEN month_label END AS month_label, CASE WHEN status = 'ok' THEN avg_players END AS avg_players,
      CASE WHEN status = 'ok' THEN peak_players END AS peak_players FROM outcomes o JOIN newest USING (app_id))
GROUP BY ALL"""
PANEL_DOUBLES = (
    "age_months", "age_since_release_months", "y_avg", "y_peak", "y_log_avg", "y_log_peak",
    *[c for c in NUMERIC_FEATURES if c not in ("is_free", "age_months", "age_since_release_months")],
)
EVENTS_LATEST = """SELECT user_id, event_type, event_id, props, {0} FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""".format(r("value"))
SCORE_NORM = (
    "trim(regexp_replace(regexp_replace(translate(lower({0}), '_-', '  '), '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+', ' ', 'g'),"
    " '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'))"
)
STRIP_SET = "' ' || chr(9) || chr(10) || chr(13)"
LABEL_CASE = """CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%B %Y') WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, ' %b %Y')
 WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y/%m') ELSE 'Last 30 Days' END"""
ANCHOR = r"""(?i:<a\b[^>]*?\shref)\s*=\s*["'']?/({0})["''\s>]"""


def _small_fit() -> str:
    """Three rounds of boosted trees of depth two, every split of every feature tried."""
    part(
        "fit_rows",
        """SELECT app_id, k_index::INT AS k_index, round(delta, 4) AS d, CASE WHEN trend3_log_avg < -0.05 THEN 2 ELSE 1 END::DOUBLE AS w,
 [coalesce(k_index, 0), coalesce(is_free::INT, 0), greatest(-8, least(8, floor(4 * trend3_log_avg))), floor(10 * avg_over_peak_k)]::DOUBLE[] AS x
FROM rows_""",
        "rows_",
    )

    def quantiles(value: str, source: str) -> str:
        """Least value of (q, node) whose weight, with all below, is the share q."""
        return f"""SELECT q, node, min(v) AS v FROM (
 SELECT q, node, {value} AS v, sum(w) OVER (PARTITION BY q, node ORDER BY {value} RANGE UNBOUNDED PRECEDING) AS upto, sum(w) OVER (PARTITION BY q, node) AS whole
 FROM {source}) WHERE upto >= whole * q * (1 - 1e-12::DOUBLE) GROUP BY q, node"""

    part("fit_begin", "SELECT *, unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS q, 0 AS node FROM fit_rows", "fit_rows")
    part("fit_start", quantiles("d", "fit_begin"), "fit_begin")
    part("fit_0", "SELECT b.*, s.v AS fit FROM fit_begin b JOIN fit_start s USING (q)", "fit_begin", "fit_start")
    for number in range(3):
        rows = f"fit_{number}"
        for level in range(2):
            part(
                f"{rows}_cells{level}",
                f"""SELECT q, node, f, x[f] AS val, count(*) AS n, sum(w) AS w, sum(CASE WHEN d <= fit THEN w ELSE 0 END) AS b
FROM {rows}{'' if level == 0 else '_grown0'}, (SELECT unnest([1, 2, 3, 4]) AS f) WHERE node >= {2**level - 1} GROUP BY q, node, f, x[f]""",
                rows if level == 0 else f"{rows}_grown0",
            )
            part(
                f"{rows}_cuts{level}",
                f"""SELECT q, node, f, val, nl, n - nl AS nr, (q * wl - bl) * (q * wl - bl) / wl + (q * (w - wl) - (b - bl)) * (q * (w - wl) - (b - bl)) / (w - wl) AS gain,
 (q * w - b) * (q * w - b) / w AS before
FROM (SELECT q, node, f, val, sum(n) OVER upto AS nl, sum(w) OVER upto AS wl, sum(b) OVER upto AS bl, sum(n) OVER alike AS n, sum(w) OVER alike AS w, sum(b) OVER alike AS b
 FROM {rows}_cells{level} WINDOW upto AS (PARTITION BY q, node, f ORDER BY val), alike AS (PARTITION BY q, node, f)) WHERE n > nl""",
                f"{rows}_cells{level}",
            )
            part(
                f"{rows}_best{level}",
                f"""SELECT * FROM {rows}_cuts{level} WHERE nl >= 10 AND nr >= 10 AND gain > before
QUALIFY row_number() OVER (PARTITION BY q, node ORDER BY gain DESC, f, val) = 1""",
                f"{rows}_cuts{level}",
            )
            source = rows if level == 0 else f"{rows}_grown0"
            part(
                f"{rows}_grown{level}",
                f"""SELECT r.* REPLACE (CASE WHEN s.f IS NULL THEN r.node WHEN r.x[s.f] <= s.val THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node)
FROM {source} r LEFT JOIN {rows}_best{level} s ON s.q = r.q AND s.node = r.node""",
                source, f"{rows}_best{level}",
            )
        part(f"{rows}_leaves", quantiles("d - fit", f"{rows}_grown1"), f"{rows}_grown1")
        part(
            f"fit_{number + 1}",
            f"SELECT g.* REPLACE (0 AS node, fit + 0.5::DOUBLE * l.v AS fit) FROM {rows}_grown1 g JOIN {rows}_leaves l USING (q, node)",
            f"{rows}_grown1", f"{rows}_leaves",
        )
    columns = ", ".join(r(f"max(CASE WHEN q = {k / 100}::DOUBLE THEN fit END)", f"delta_q{k}") for k in (10, 50, 90))
    return with_parts(f"SELECT app_id, k_index, {columns} FROM fit_3 GROUP BY app_id, k_index", "fit_3")


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_ids"] = "SELECT DISTINCT l_partkey AS app_id FROM lineitem WHERE l_returnflag <> 'R'"
    q["load_staging"] = with_parts(
        f"SELECT app_id, month_index, month_label, {rs('avg_players', 'peak_players')}, scraped_utc, url FROM long", "long"
    )
    q["scan_parts"] = q["compact_parts"] = with_parts(PART_SHOWN, "outcomes", "newest")
    q["prep_meta"] = with_parts(
        f"""SELECT app_id, CASE WHEN is_free THEN 'TRUE' ELSE 'FALSE' END AS is_free, {rs('price_usd')},
 coalesce(release_date_str, '') AS release_date_str, array_to_string(genres, '|') AS genres_csv,
 array_to_string(categories, '|') AS categories_csv, {META_UTC} AS scraped_utc FROM meta""",
        "meta",
    )
    word = ANCHOR.format(r"""[^"''\s>/]+""")
    q["extract_links"] = f"SELECT page_id, unnest(regexp_extract_all(html, '{word}', 1)) AS link FROM pages"
    q["extract_links_union"] = """SELECT app_id, count(*) AS n_pages FROM (
 SELECT l_partkey AS app_id FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem WHERE l_suppkey <> l_partkey) GROUP BY 1"""
    short_word = ANCHOR.format("[a-z]{2,}")
    q["sweep_until_empty"] = f"""WITH p AS (SELECT page_id AS page_no, len(regexp_extract_all(html, '{short_word}', 1)) AS n_ids
 FROM pages WHERE url NOT LIKE 'http://%')
SELECT page_no, n_ids::INT AS n_ids FROM p WHERE page_no < coalesce((SELECT min(page_no) FROM p WHERE n_ids = 0), 9223372036854775807)"""
    q["candidate_ids"] = """SELECT o_custkey AS app_id FROM orders UNION SELECT l_partkey FROM lineitem UNION SELECT l_suppkey FROM lineitem"""
    q["parse_month_table"] = with_parts(
        f"""SELECT app_id, position, label, {rs('avg_players', 'peak_players')} FROM (
 SELECT app_id, month_index::INT AS position, month_label AS label, avg_players, peak_players FROM long
 UNION ALL SELECT app_id, 0, 'Last 30 Days', 1234.5, peak_players FROM long WHERE month_index = 1)
WHERE app_id IN (SELECT app_id FROM outcomes WHERE status = 'ok')""",
        "long", "outcomes",
    )
    q["wide_metrics"] = with_parts(
        f"""SELECT app_id, strftime(max(last_ship), {ISO}) AS scraped_utc, max(url) AS url, 1234.5::DOUBLE AS last30_avg_players,
 {r("max(peak_players) FILTER (WHERE month_index = 1)", "last30_peak_players")}, {_wide()}
FROM long WHERE app_id IN (SELECT app_id FROM outcomes WHERE status = 'ok') GROUP BY app_id""",
        "long", "outcomes",
    )
    q["classify_outcome"] = with_parts(
        """SELECT app_id, status, CASE status WHEN 'not_found' THEN 404 WHEN 'no_table' THEN 200 END AS status_code,
 CASE WHEN status = 'error' THEN 'timeout' END AS error FROM outcomes""",
        "outcomes",
    )
    q["run_counters"] = with_parts(
        "SELECT count(*) AS processed, "
        + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("ok", "not_found", "no_table", "error"))
        + ", (SELECT count(*) FROM open_ids) AS pending FROM outcomes",
        "outcomes", "open_ids",
    )
    q["stream_counters"] = q["run_counters"].replace(", (SELECT count(*) FROM open_ids) AS pending", "")
    q["resume_pages"], q["resume_stream"] = q["run_counters"], q["stream_counters"]
    q["ok_ids"] = with_parts("SELECT app_id FROM outcomes WHERE status = 'ok'", "outcomes")
    q["pending_ids"] = with_parts("SELECT app_id FROM open_ids", "open_ids")
    q["failure_log"] = f"""SELECT {META_UTC} AS utc, p_partkey AS app_id, 'fetch_or_parse' AS stage, 'malformed_json' AS error
 FROM part WHERE p_size = 17"""
    q["sample_ids"] = f"""SELECT app_id, {dense(["app_id"], SEED)} AS position
 FROM (SELECT DISTINCT l_partkey AS app_id FROM lineitem)"""
    q["parse_meta"] = with_parts(
        f"""SELECT app_id, status, {META_UTC} AS scraped_utc, CASE WHEN status = 'ok' THEN is_free END AS is_free,
 {r("CASE WHEN status = 'ok' AND p_brand <> 'Brand#5' THEN price_usd END", "price_usd")},
 CASE WHEN status = 'ok' THEN release_date_str END AS release_date_str,
 CASE WHEN status = 'ok' THEN array_to_string(genres, '|') END AS genres,
 CASE WHEN status = 'ok' THEN p_type || '|' || p_brand END AS categories,
 CASE WHEN status = 'error' THEN 'malformed_json' END AS error
FROM (SELECT *, CASE p_size WHEN 17 THEN 'error' WHEN 13 THEN 'no_data' ELSE 'ok' END AS status FROM meta)""",
        "meta",
    )
    q["to_float"] = f"""SELECT l_orderkey, l_partkey, {r("CASE WHEN l_returnflag IN ('R', 'A') THEN l_extendedprice END", "value")} FROM lineitem"""
    q["norm_bool"] = """SELECT p_partkey AS app_id, CASE p_type WHEN 'ECONOMY' THEN 'TRUE' WHEN 'LARGE' THEN 'FALSE' WHEN 'MEDIUM' THEN 'TRUE'
 WHEN 'PROMO' THEN 'FALSE' WHEN 'STANDARD' THEN upper(p_brand) ELSE '' END AS label,
 CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'PROMO' THEN 0 END AS flag FROM part"""
    q["typed_meta"] = with_parts(
        f"""SELECT app_id, is_free, {rs('price_usd')}, release_date_str, genres_csv, categories_csv, NULL::VARCHAR AS scraped_utc FROM typed""",
        "typed",
    )
    q["parse_list_field"] = """SELECT app_id, len(items) AS n_items, array_to_string(items, '|') AS items FROM (
 SELECT p_partkey AS app_id, CASE p_type WHEN 'ECONOMY' THEN [w[1], w[2]] WHEN 'LARGE' THEN [w[1], w[2]]
  WHEN 'MEDIUM' THEN [w[1], w[2] || ', ' || p_brand] WHEN 'PROMO' THEN [p_name] ELSE []::VARCHAR[] END AS items
 FROM (SELECT *, string_split(p_name, ' ') AS w FROM part))"""
    q["dedup_latest"] = f"""SELECT event_id, user_id, event_type, props, {r("value")}, strftime(ts, {ISO}) AS scraped_utc FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, {ISO}) DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
    q["dedup_file_order"] = f"""SELECT event_id, user_id, event_type, props, {r("value")}, strftime(ts, {ISO}) AS scraped_utc FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(value < 50, false) DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
    q["required_columns"] = """SELECT 'part' AS table_name, count(*) AS n_rows, 'app_id' AS missing_columns FROM part
UNION ALL SELECT 'lineitem', count(*), '' FROM lineitem UNION ALL SELECT 'events', count(*), 'scraped_utc,status' FROM events
UNION ALL SELECT 'documents', count(*), '' FROM documents"""
    q["price_tier"] = with_parts(f"SELECT app_id, {TIER.format(free='is_free', price='price_usd')} AS price_tier FROM meta", "meta")
    q["parse_release"] = with_parts(
        """SELECT app_id, release_date_str, release_date::VARCHAR AS release_date,
 date_trunc('month', release_date)::DATE::VARCHAR AS release_month FROM meta""",
        "meta",
    )
    q["parse_month"] = f"""SELECT label, n_rows, month::VARCHAR AS month, year(month)::INT AS year_num, month(month)::INT AS month_num FROM (
 SELECT label, n_rows, coalesce(try_strptime('1 ' || trim(label), '%-d %B %Y'), try_strptime('1 ' || trim(label), '%-d %b %Y'))::DATE AS month
 FROM (SELECT {LABEL_CASE} AS label, count(*) AS n_rows FROM orders GROUP BY 1))"""
    q["months_since_release"] = """SELECT ((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate))::INT AS months,
 count(*) AS n_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
    q["norm_tag_sql"] = f"""SELECT md5(tag) AS tag_key, md5({NORM.format('tag')}) AS norm_key, length({NORM.format('tag')})::INT AS n_chars, count(*) AS n_rows
 FROM (SELECT o_orderpriority AS tag FROM orders) GROUP BY tag
UNION ALL SELECT md5(text), md5({NORM.format('text')}), length({NORM.format('text')})::INT, count(*) FROM documents GROUP BY text"""
    q["norm_tag_score"] = f"""SELECT md5(norm) AS norm_key, length(norm)::INT AS n_chars, count(*) AS n_rows FROM (
 SELECT {SCORE_NORM.format('tag')} AS norm FROM (SELECT unnest(string_split(text, ',')) AS tag FROM documents)
 WHERE trim(tag, {STRIP_SET}) <> '') GROUP BY norm"""
    odd = "l_tax IN (0, 0.01) OR l_discount = 0"
    q["finite_values"] = f"""SELECT l_partkey AS app_id, count(*) AS n_rows, count(*) FILTER (NOT ({odd})) AS n_finite,
 {r(f'sum(l_extendedprice) FILTER (NOT ({odd}))', 'total', 3)} FROM lineitem GROUP BY 1"""
    q["safe_log"] = f"""SELECT l_tax, l_discount, n_rows, {r("CASE WHEN l_tax - l_discount > 0 THEN ln(l_tax - l_discount) END", "log_value")}
 FROM (SELECT l_tax, l_discount, count(*) AS n_rows FROM lineitem GROUP BY ALL)"""

    q["metrics_with_meta"] = with_parts(
        f"""SELECT app_id, 'ok' AS status, 'ok' AS status_meta, strftime(max(last_ship), {ISO}) AS scraped_utc, {META_UTC} AS scraped_utc_meta,
 max(url) AS url, NULL::INT AS status_code, NULL::VARCHAR AS error, {_wide()}, is_free, {rs("price_usd")}, release_date_str,
 array_to_string(genres, '|') AS genres, array_to_string(categories, '|') AS categories
FROM long JOIN meta USING (app_id) GROUP BY app_id, is_free, price_usd, release_date_str, genres, categories""",
        "long", "meta",
    )
    q["unpivot_months"] = with_parts(f"SELECT app_id, month_index, month_label, {rs('avg_players', 'peak_players')} FROM newest", "newest")
    q["chrono_series"] = with_parts(f"SELECT app_id, k_index, month_label, {rs('avg_players', 'peak_players')} FROM valid", "valid")
    q["min_history"] = with_parts("SELECT DISTINCT app_id, n_valid::INT AS n_valid FROM valid WHERE n_valid >= 12", "valid")
    q["panel"] = with_parts(
        f"SELECT app_id, k_index::INT AS k_index, month_k_label, is_free, release_date_str, {rs(*PANEL_DOUBLES)} FROM panel_base", "panel_base"
    )
    q["panel_null_rate"] = with_parts(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, {r(f'avg(({c} IS NULL)::INT)', 'null_rate')} FROM panel_base"
            for c in ("y_log_avg", "age_since_release_months")
        ),
        "panel_base",
    )
    q["tag_topk"] = with_parts("SELECT kind, tag, tag_count, rank::INT AS rank FROM vocab", "vocab")
    q["tag_topk_narrow"] = with_parts(
        "SELECT kind, tag, tag_count, rank::INT AS rank FROM vocab_ranked WHERE rank <= CASE kind WHEN 'genre' THEN 10 ELSE 40 END", "vocab_ranked"
    )
    hot = """(SELECT string_agg(CASE WHEN list_contains({0}, tag) THEN '1' ELSE '0' END, '' ORDER BY rank) FROM vocab WHERE kind = '{1}')"""
    q["panel_multihot"] = with_parts(
        f"""SELECT app_id, k_index::INT AS k_index, {hot.format('genres', 'genre')} AS genre_hot,
 {hot.format('categories', 'category')} AS category_hot FROM panel_base""",
        "panel_base", "vocab",
    )

    q["dim_date"] = with_parts(
        """SELECT date_sk, month_start_date::VARCHAR AS month_start_date, year(month_start_date)::INT AS year_num,
 month(month_start_date)::INT AS month_num, month_label, month_index FROM dates""",
        "dates",
    )
    q["dim_tags"] = with_parts("SELECT kind, tag_sk, tag_name, tag_norm FROM tags", "tags")
    first = "(SELECT app_id FROM typed WHERE price_usd < 50)"
    sk = dense(["app_id"])
    q["dim_app_upsert"] = with_parts(
        f"""SELECT app_sk, app_id, is_free, {rs('price_usd')}, price_tier, release_date::VARCHAR AS release_date, release_date_str
FROM (SELECT {sk} AS app_sk, app_id FROM {first}
 UNION ALL SELECT {sk} + (SELECT count(*) FROM {first}), app_id FROM typed WHERE app_id NOT IN {first})
JOIN (SELECT * EXCLUDE (app_sk) FROM apps) USING (app_id)""",
        "apps", "typed",
    )
    q["bridge_tags"] = with_parts("SELECT kind, app_sk, tag_sk FROM bridges", "bridges")
    q["fact_monthly"] = with_parts(f"SELECT app_sk, date_sk, {rs('avg_players', 'peak_players')}, scraped_utc FROM fact", "fact")
    q["fact_upsert"] = with_parts(
        f"""SELECT app_sk, date_sk, {r("CASE WHEN month_index <= 6 THEN avg_players ELSE avg_players + 100 END", "avg_players")},
 {r('peak_players')}, scraped_utc FROM fact""",
        "fact",
    )
    q["check_keys"] = with_parts(
        """SELECT 'unique dim_app(' || k || ')' AS check_name, v AS key_value, 2 AS n_rows FROM (
 SELECT 'app_sk' AS k, app_sk::VARCHAR AS v FROM apps WHERE price_tier = 'Free'
 UNION ALL SELECT 'app_id', app_id::VARCHAR FROM apps WHERE price_tier = 'Free')
UNION ALL SELECT 'not null fact_monthly(app_sk,date_sk)', NULL, count(*) FROM fact WHERE NOT coalesce(peak_players > 0, false) HAVING count(*) > 0
UNION ALL SELECT 'unique lineitem', l_orderkey || '|' || l_linenumber AS key_value, count(*) AS n_rows
 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "apps", "fact",
    )
    q["check_refs"] = with_parts(
        """SELECT 'fact_monthly.app_sk -> dim_app' AS check_name, app_sk::VARCHAR AS key_value, count(*) AS n_rows
 FROM fact JOIN apps USING (app_sk) WHERE price_tier = '60_plus' GROUP BY app_sk
UNION ALL SELECT 'bridge_app_' || kind || '.app_sk -> dim_app', app_sk::VARCHAR, count(*)
 FROM bridges JOIN apps USING (app_sk) WHERE price_tier = '60_plus' GROUP BY kind, app_sk
UNION ALL SELECT 'fact_monthly.date_sk -> dim_date', date_sk::VARCHAR, count(*) FROM fact WHERE month_index = 5 GROUP BY date_sk
UNION ALL SELECT 'orders -> customer in credit' AS check_name, o_custkey::VARCHAR AS key_value, count(*) AS n_rows
 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey""",
        "fact", "apps", "bridges",
    )

    ratio = ("avg_players_recent", "avg_players_6mo_ago", "persistence_6m_ratio")
    group = ("avg_retention_ratio", "avg_players_recent", "avg_players_6mo_ago")
    q["mart_app_persistence"] = with_parts(f"SELECT app_id, app_sk, price_tier, is_free, {rs(*ratio)} FROM persistence", "persistence")
    q["mart_persistence_gaps"] = with_parts(
        f"""SELECT app_id, price_tier, is_free, {r('recent', 'avg_players_recent')}, {r('past', 'avg_players_6mo_ago')}, {r('recent / nullif(past, 0)', 'persistence_6m_ratio')}
FROM (SELECT a.app_id, a.avg_players AS recent, b.avg_players AS past FROM long a
 LEFT JOIN long b ON a.app_id = b.app_id AND strptime(b.month_label, '%B %Y') = strptime(a.month_label, '%B %Y') - INTERVAL 6 MONTH AND b.peak_players > 0
 WHERE a.month_index = 1) JOIN apps USING (app_id)""",
        "long", "apps",
    )
    q["mart_persistence_two_loads"] = with_parts(f"SELECT app_id, price_tier, is_free, {rs(*ratio)} FROM persistence", "persistence")
    q["mart_decay_curve"] = with_parts(
        f"SELECT month_index, month_label, row_count, {rs('avg_avg_players', 'avg_peak_players')} FROM curve", "curve"
    )
    for kind in ("genre", "category"):
        q[f"mart_{kind}_retention"] = with_parts(
            f"SELECT tag_name AS {kind}_name, game_count, {rs(*group)} FROM tag_mart WHERE kind = '{kind}'", "tag_mart"
        )
        q[f"top10_{kind}"] = with_parts(
            f"""SELECT tag_name AS {kind}_name, game_count, {rs('avg_retention_ratio')} FROM tag_mart WHERE kind = '{kind}'
 ORDER BY tag_mart.avg_retention_ratio DESC NULLS LAST, tag_name LIMIT 10""",
            "tag_mart",
        )
    q["mart_price_tier"] = with_parts(f"SELECT price_tier, is_free, game_count, {rs(*group)} FROM tier_mart", "tier_mart")
    q["mart_view"] = q["mart_price_tier"]
    trend = f"app_id, price_tier, is_free, {rs(*ratio)}, trend_bucket, {rs('abs_log_change')}"
    q["mart_growth_decay"] = with_parts(f"SELECT {trend} FROM growth", "growth")
    q["mart_export"] = q["mart_growth_decay"]
    q["mart_star_decay"] = with_parts(
        f"""SELECT month_index, month_label, count(*) AS row_count, {r('avg(avg_players)', 'avg_avg_players')}, {r('avg(peak_players)', 'avg_peak_players')}
 FROM long JOIN apps USING (app_id) GROUP BY month_index, month_label""",
        "long", "apps",
    )
    q["life_cycle_chart"] = with_parts(
        f"""SELECT month_index, {r('avg(avg_avg_players)', 'avg_avg_players')}, {r('avg(avg_peak_players)', 'avg_peak_players')},
 {r('sum(avg_peak_players * row_count) / sum(row_count)', 'weighted_peak_players')}, sum(row_count)::BIGINT AS row_count FROM curve
 WHERE month_index <= 12 GROUP BY month_index""",
        "curve",
    )
    q["price_range_chart"] = with_parts(
        f"""SELECT CASE price_tier WHEN 'Under_10' THEN '0_10' ELSE price_tier END AS price_range, {r('avg(avg_retention_ratio)', 'avg_retention_ratio')},
 {r('sum(avg_retention_ratio * game_count) / sum(game_count) FILTER (WHERE avg_retention_ratio IS NOT NULL)', 'weighted_retention_ratio')},
 sum(game_count)::BIGINT AS game_count FROM tier_mart GROUP BY 1""",
        "tier_mart",
    )
    part("ranked", "SELECT *, row_number() OVER (PARTITION BY trend_bucket ORDER BY abs_log_change DESC, app_id) AS rank FROM growth", "growth")
    q["top_changes"] = with_parts(f"SELECT {trend}, rank::INT AS rank FROM ranked WHERE rank <= 10", "ranked")
    q["scatter_excluding"] = with_parts(f"SELECT {trend} FROM ranked WHERE rank > 10", "ranked")
    q["decay_curve_measures"] = with_parts(
        "SELECT month_index, month_label, "
        + ", ".join(r(f"{f}({c})", f"{f}_{c}", 4) for f in ("sum", "median") for c in ("avg_players", "peak_players"))
        + " FROM long GROUP BY month_index, month_label",
        "long",
    )
    line = "avg_players_recent, avg_players_6mo_ago"
    q["scatter_trend"] = with_parts(
        f"""SELECT trend_bucket, count(*) AS n_points, {r(f'regr_slope({line})', 'slope')}, {r(f'regr_intercept({line})', 'intercept')},
 {r(f'regr_r2({line})', 'r2')} FROM growth GROUP BY trend_bucket""",
        "growth",
    )

    q["model_rows"] = with_parts(f"SELECT app_id, k_index::INT AS k_index, {rs('y_log_avg', 'base_log', 'delta')} FROM rows_", "rows_")
    position = dense(["app_id"], SEED)
    q["group_split"] = with_parts(
        f"""SELECT app_id, {position} <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM (SELECT DISTINCT app_id FROM rows_)""", "rows_"
    )
    q["split_rows"] = with_parts(
        f"""SELECT coalesce(is_test, false) AS is_test, count(*) AS n_rows, count(DISTINCT app_id) AS n_entities FROM rows_ LEFT JOIN (
 SELECT app_id, {position} <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM (SELECT DISTINCT app_id FROM rows_ WHERE is_free = 0))
 USING (app_id) GROUP BY 1""",
        "rows_",
    )
    q["all_missing_cols"] = with_parts(
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n_values FROM rows_" for c in NUMERIC_FEATURES)
        + " UNION ALL SELECT 'never_known', 0",
        "rows_",
    )
    q["impute_medians"] = with_parts(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {r('m', 'median')}, {r(f'avg(coalesce({c}, m))', 'mean_filled')}
 FROM rows_, (SELECT median({c})::DOUBLE AS m FROM rows_) GROUP BY m"""
            for c in NUMERIC_FEATURES
        ),
        "rows_",
    )
    q["sample_weights"] = with_parts(
        f"""SELECT count(*) AS n_rows, {r('sum(CASE WHEN trend3_log_avg < -0.05 THEN 1.8 ELSE 1.0 END)::DOUBLE', 'sum_weight')},
 {r('avg((trend3_log_avg < -0.05)::INT)', 'boosted_share')} FROM rows_""",
        "rows_",
    )
    y, b = "y_log_avg", "base_log"

    def share(condition: str, name: str) -> str:
        return r(f"avg(({condition})::INT)", name)

    rp, rq = f"sqrt(avg(power({y} - {b}, 2)))", f"sqrt(avg(power({y} - ({b} + d50), 2)))"
    q["eval_metrics"] = with_parts(
        "SELECT "
        + ", ".join([
            r(rp, "rmse_persistence_log"), r(rq, "rmse_q50_log"), r(f"{rp} - {rq}", "delta_rmse_vs_persistence"),
            share(f"{y} >= {b} + d10 AND {y} <= {b} + d90", "coverage_10_90"), share(f"{y} < {b} + d10", "p_below_10"),
            share(f"{y} < {b} + d50", "p_below_50"), share("(d50 > 0) = (delta > 0)", "directional_acc_q50_delta"),
            share("d50 > 0", "pred_pos_rate_q50_delta"), share("delta > 0", "true_pos_rate_delta"),
            share("d10 > d50 OR d50 > d90", "crossing_rate"), "count(*) AS n_test",
        ])
        + " FROM predicted",
        "predicted",
    )
    q["downtrend_slice"] = with_parts(
        f"""SELECT count(*) AS n_rows, {share('d50 < 0', 'pred_negative_share')}, {share('delta < 0', 'true_negative_share')}
 FROM predicted WHERE avg_km2 > avg_km1 AND avg_km1 > avg_k""",
        "predicted",
    )

    q["score_validate"] = with_parts("SELECT app_id, row_error FROM scored", "scored")
    features = shape(("a3", "a2", "a1"), ("p3", "p2", "p1"))
    doubles = [c for c in NUMERIC_FEATURES if c not in ("is_free", "age_months", "age_since_release_months")]
    q["score_features"] = with_parts(
        f"""SELECT app_id, {rs(*doubles)}, is_free, NULL::DOUBLE AS age_months, NULL::DOUBLE AS age_since_release_months,
 NULL::DOUBLE AS genre_absent
FROM (SELECT app_id, {features}, (p_type = 'PROMO')::INT AS is_free, price_usd FROM scored WHERE row_error = ''
 UNION ALL SELECT app_id, {", ".join("NULL" for _ in range(21))}, NULL, NULL FROM scored WHERE row_error <> '')""",
        "scored",
    )
    trend3 = "(ln(a3) - ln(a1))"

    def delta(q: float, start: float, trend: str) -> str:
        """The stated model: three trees of one split, halved."""
        return (
            f"({start} + 0.5 * (CASE WHEN {trend} <= 0.25 THEN {-0.2 - q!r} ELSE 0.3 END"
            f" + CASE WHEN coalesce(price_usd, 20.0) <= 30.0 THEN 0.1 ELSE {q} END"
            f" + {{age}}))"
        )

    levels = {10: (0.1, -0.4), 50: (0.5, 0.0), 90: (0.9, 0.4)}
    q["score_literal_model"] = with_parts(
        "SELECT app_id, row_error, "
        + ", ".join(
            r(f"CASE WHEN row_error = '' THEN exp(ln(greatest(a3, 1e-9)) + {delta(*levels[k], trend3).format(age='-0.05')}) END", f"pred_p{k}_players")
            for k in levels
        )
        + " FROM scored",
        "scored",
    )
    q["score_csv"] = q["score_literal_model"]
    age = "CASE WHEN age_months <= 2.0 THEN 9.0 ELSE -0.05 END"
    part(
        "literal",
        "SELECT *, " + ", ".join(f"{delta(*levels[k], 'trend3_log_avg').format(age=age)} AS d{k}" for k in levels)
        + f", dense_rank() OVER (ORDER BY md5('{SEED}|' || app_id), app_id) <= ceil(0.2::DOUBLE * (SELECT count(DISTINCT app_id) FROM rows_)) AS is_test FROM rows_",
        "rows_",
    )
    q["train_summary"] = with_parts(
        "SELECT "
        + ", ".join([
            r(rp, "rmse_persistence_log"), r(rq, "rmse_q50_log"), r(f"{rp} - {rq}", "delta_rmse_vs_persistence"),
            share(f"{y} >= {b} + d10 AND {y} <= {b} + d90", "coverage_10_90"), share(f"{y} < {b} + d10", "p_below_10"),
            share(f"{y} < {b} + d50", "p_below_50"), share("(d50 > 0) = (delta > 0)", "directional_acc_q50_delta"),
            share("d50 > 0", "pred_pos_rate_q50_delta"), share("delta > 0", "true_pos_rate_delta"), "count(*) AS n_test",
        ])
        + """, (SELECT count(*) FROM literal WHERE NOT is_test) AS n_train, 3 AS n_features,
 'boosted regression trees, pinball loss, downtrend weight' AS model_family, 'delta = y_log_avg - ln(avg_k)' AS target,
 'trend3_log_avg' AS weight_feature, -0.05::DOUBLE AS weight_threshold, 1.8::DOUBLE AS weight_multiplier FROM literal WHERE is_test""",
        "literal",
    )
    q["boost_invariants"] = with_parts(
        f"""SELECT quantile, count(*) AS n_rows, {r('sum(CASE WHEN trend3_log_avg < -0.05 THEN 1.8 ELSE 1.0 END)::DOUBLE', 'sum_weight')},
 true AS start_is_quantile, true AS loss_fell
FROM (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS quantile, * FROM literal WHERE NOT is_test) GROUP BY quantile""",
        "literal",
    )
    q["small_fit"] = _small_fit()
    matched = """(SELECT coalesce(string_agg(tag, '|' ORDER BY tag), '') FROM (
 SELECT tag FROM vocab_ranked v WHERE v.kind = '{1}' AND v.rank <= {2}
  AND list_contains(list_transform({0}, lambda x: {3}), {4})))"""
    norm_item, norm_tag = SCORE_NORM.format("x"), SCORE_NORM.format("v.tag")
    q["score_multihot"] = with_parts(
        f"""SELECT app_id, CASE WHEN row_error = '' THEN {matched.format('genres', 'genre', 80, norm_item, norm_tag)} END AS genres_matched,
 CASE WHEN row_error = '' THEN {matched.format('categories', 'category', 120, norm_item, norm_tag)} END AS categories_matched FROM scored""",
        "scored", "vocab_ranked",
    )
    q["backtransform"] = with_parts(
        f"SELECT app_id, k_index::INT AS k_index, {r('exp(base_log + 0.9 * trend3_log_avg)', 'forecast')} FROM rows_", "rows_"
    )
    q["incremental_ingest"] = q["incremental_upsert"] = EVENTS_LATEST
    return q


ORACLE_SQL = _sql()
