"""DuckDB oracle SQL for the registered queries.

Each string reproduces a query's result from the raw parquet views (region
nation customer supplier part orders lineitem events ...), written
independently of the Spark operators: bindings, operators and products are
spelled out as CTEs.  Column names and types match the Spark results.
"""

from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

# Parameters of the registered runs, as plain values: the engine builds its own from them.
OP_TIME = "2000061500"
COSINE_PARAMS = SimpleNamespace(min_sim=0.7, top_sim=20, min_commons=5, min_rating=2, top_n=10)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


PURCHASE_RATINGS = """
purchase_ratings AS (
  SELECT o.o_custkey AS USER_ID,
         l.l_partkey AS PRODUCT_CODE,
         AVG(1 + FLOOR((l.l_quantity - 1) / 10)) AS SCORE
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  GROUP BY 1, 2
)"""


def sql_cosine(r: str, p: SimpleNamespace) -> str:
    """CTEs dev, pairs, sims, top, pred_unrated, pred_rated, recs over ratings view ``r``."""
    return f"""
cs_mean AS (SELECT USER_ID, AVG(SCORE) AS m FROM {r} GROUP BY USER_ID),
cs_dev AS (
  SELECT x.USER_ID, x.PRODUCT_CODE, ROUND(x.SCORE - s.m, 9) AS d
  FROM {r} x JOIN cs_mean s ON x.USER_ID = s.USER_ID
),
cs_pairs AS (
  SELECT a.PRODUCT_CODE AS PRODUCT_CODE, b.PRODUCT_CODE AS j_PRODUCT_CODE,
         SUM(a.d * b.d) AS "cross", SUM(a.d * a.d) AS i_sq, SUM(b.d * b.d) AS j_sq, COUNT(*) AS n_commons
  FROM cs_dev a JOIN cs_dev b ON a.USER_ID = b.USER_ID AND a.PRODUCT_CODE < b.PRODUCT_CODE
  GROUP BY 1, 2
  HAVING COUNT(*) >= {p.min_commons}
),
cs_half AS (
  SELECT PRODUCT_CODE, j_PRODUCT_CODE,
         ROUND(CASE WHEN i_sq * j_sq = 0 THEN 0.0 ELSE "cross" / (SQRT(i_sq) * SQRT(j_sq)) END, 12) + 0.0 AS simularity
  FROM cs_pairs
),
cs_sims AS (
  SELECT PRODUCT_CODE, j_PRODUCT_CODE, simularity FROM cs_half
  UNION ALL
  SELECT j_PRODUCT_CODE, PRODUCT_CODE, simularity FROM cs_half
),
cs_top AS (
  SELECT PRODUCT_CODE, j_PRODUCT_CODE, simularity FROM (
    SELECT *, RANK() OVER (PARTITION BY PRODUCT_CODE ORDER BY simularity DESC, j_PRODUCT_CODE) AS rk
    FROM cs_sims WHERE simularity >= {p.min_sim}
  ) WHERE rk <= {p.top_sim}
),
cs_contrib AS (
  SELECT s.USER_ID, t.j_PRODUCT_CODE AS PRODUCT_CODE,
         SUM(s.SCORE * t.simularity) AS num, SUM(ABS(t.simularity)) AS den
  FROM {r} s JOIN cs_top t ON s.PRODUCT_CODE = t.PRODUCT_CODE
  WHERE s.SCORE >= {p.min_rating}
  GROUP BY 1, 2
),
cs_pred AS (
  SELECT c.USER_ID, c.PRODUCT_CODE,
         ROUND(CASE WHEN den = 0 THEN -1.0 ELSE num / den END, 12) + 0.0 AS prediction,
         EXISTS (SELECT 1 FROM {r} x WHERE x.USER_ID = c.USER_ID AND x.PRODUCT_CODE = c.PRODUCT_CODE) AS is_rated
  FROM cs_contrib c
),
cs_pred_unrated AS (SELECT USER_ID, PRODUCT_CODE, prediction FROM cs_pred WHERE NOT is_rated),
cs_pred_rated AS (SELECT USER_ID, PRODUCT_CODE, prediction FROM cs_pred WHERE is_rated),
cs_recs AS (
  SELECT USER_ID, PRODUCT_CODE, prediction, CAST(RANK AS INTEGER) AS RANK FROM (
    SELECT *, RANK() OVER (PARTITION BY USER_ID ORDER BY prediction DESC, PRODUCT_CODE) AS RANK
    FROM cs_pred_unrated WHERE prediction >= {p.min_rating}
  ) WHERE RANK <= {p.top_n}
)"""


COSINE = with_(PURCHASE_RATINGS, sql_cosine("purchase_ratings", COSINE_PARAMS))


def cosine_metrics(ctes: str, r: str, p: SimpleNamespace, arguments: str) -> str:
    """Metrics of a cosine run over ratings view ``r``; ``ctes`` ends with ``sql_cosine``'s."""
    return ctes + f""",
cs_checked AS (SELECT (p.prediction - x.SCORE) * (p.prediction - x.SCORE) AS e2
               FROM cs_pred_rated p JOIN {r} x USING (USER_ID, PRODUCT_CODE)),
cs_stats AS (
  SELECT (SELECT COUNT(*) FROM {r}) AS n_ratings,
         (SELECT COUNT(DISTINCT USER_ID) FROM {r}) AS n_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM {r}) AS n_items,
         (SELECT COUNT(DISTINCT USER_ID) FROM cs_recs) AS n_reco_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM cs_recs) AS n_reco_items,
         (SELECT SQRT(AVG(e2)) FROM cs_checked) AS rmse
)
SELECT metric, value FROM (
  SELECT 0 AS pos, 'OP_TIME' AS metric, '{OP_TIME}' AS value FROM cs_stats
  UNION ALL SELECT 1, 'ARGUMENTS', '{arguments}' FROM cs_stats
  UNION ALL SELECT 2, 'NUM_PROCESSED_LOG', CAST(n_ratings AS VARCHAR) FROM cs_stats
  UNION ALL SELECT 3, 'NUM_ALL_USERS', CAST(n_users AS VARCHAR) FROM cs_stats
  UNION ALL SELECT 4, 'NUM_POSSIBLE_USERS', CAST(n_reco_users AS VARCHAR) FROM cs_stats
  UNION ALL SELECT 5, 'NUM_RECOMMEND_ITEMS', CAST(n_reco_items AS VARCHAR) FROM cs_stats
  UNION ALL SELECT 6, 'COVERAGE', COALESCE(printf('%.9f', ROUND(n_reco_items / n_items, 9)), 'NaN') FROM cs_stats
  UNION ALL SELECT 7, 'RMSE', COALESCE(printf('%.9f', ROUND(rmse, 9)), 'NaN') FROM cs_stats
) ORDER BY pos"""


COSINE_METRICS = cosine_metrics(COSINE, "purchase_ratings", COSINE_PARAMS, "0.7_20_5_2_10")


# ----------------------------------------------------------- time / rules

# Season numbers of the registered run, worked out by hand: 2000-06-15 is day
# 167 of its year, 15 days before it is day 152, 15 days after it day 182.
YEAR, FIRST_DAY, THIS_DAY, LAST_DAY = 2000, 152, 167, 182

SEASON_PARAMS = SimpleNamespace(
    end_time=datetime(2000, 6, 15), months=1, tran_days=4, max_items=100,
    min_support=0.02, min_confidence=0.15, top_n=10, holdout=False,
)
FULL_PARAMS = SimpleNamespace(min_support=0.1, min_confidence=0.3, max_items=100, top_n=10)

SHOP = """
shop AS (
  SELECT o.o_custkey AS USER_ID, p.p_brand AS PRODUCT_CODE, o.o_orderdate AS event_time
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey
)"""


def _event_log(name: str, types: str) -> str:
    return f"""
{name} AS (
  SELECT user_id AS USER_ID, json_extract_string(props, '$.k') AS PRODUCT_CODE,
         LEAST(5, 1 + FLOOR(value / 25)) AS SCORE, ts AS event_time
  FROM events WHERE event_type IN ({types})
)"""


CLICKS = _event_log("clicks", "'click'")
VIEWS = _event_log("views", "'view'")
PURCHASES = _event_log("purchases", "'purchase'")
EVENT_SCORES = _event_log("event_scores", "'purchase', 'view'")


def season_window(src: str, name: str) -> str:
    day = "dayofyear(event_time)"
    return f"""
{name} AS (SELECT * FROM {src} WHERE year(event_time) <= {YEAR} AND {day} BETWEEN {FIRST_DAY} AND {LAST_DAY}
  AND (year(event_time) <> {YEAR} OR {day} < {LAST_DAY}))"""


def season_history(src: str, name: str, *, half_open: bool = False) -> str:
    last = THIS_DAY - 1 if half_open else THIS_DAY
    return f"\n{name} AS (SELECT * FROM {src} WHERE year(event_time) = {YEAR} AND dayofyear(event_time) BETWEEN {FIRST_DAY} AND {last})"


def season_future(src: str, name: str) -> str:
    return f"\n{name} AS (SELECT * FROM {src} WHERE year(event_time) = {YEAR} AND dayofyear(event_time) BETWEEN {THIS_DAY} AND {LAST_DAY})"


def itemsets(baskets: str, basket_key: str, p: SimpleNamespace) -> str:
    """Frequent itemsets of size 1-3 and single-consequent rules from them.

    ``baskets`` has one row per (basket key..., PRODUCT_CODE), distinct.
    CTEs: fi_n, f1, f2, f3, freq (ITEMS text, LENGTH, FREQ),
    rules_all (a1, a2, ANTECEDENT text, CONSEQUENT, CONFIDENCE).
    """
    keys = [k.strip() for k in basket_key.split(",")]
    same = lambda x, y: " AND ".join(f"{x}.{k} = {y}.{k}" for k in keys)
    return f"""
fi_n AS (SELECT CEIL({p.min_support} * COUNT(*)) AS t FROM (SELECT DISTINCT {basket_key} FROM {baskets})),
f1 AS (
  SELECT PRODUCT_CODE AS a, COUNT(*) AS freq FROM {baskets}
  GROUP BY 1 HAVING COUNT(*) >= (SELECT t FROM fi_n)
),
fb AS (SELECT b.* FROM {baskets} b WHERE b.PRODUCT_CODE IN (SELECT a FROM f1)),
f2 AS (
  SELECT x.PRODUCT_CODE AS a, y.PRODUCT_CODE AS b, COUNT(*) AS freq
  FROM fb x JOIN fb y ON {same('x', 'y')} AND x.PRODUCT_CODE < y.PRODUCT_CODE
  GROUP BY 1, 2 HAVING COUNT(*) >= (SELECT t FROM fi_n)
),
f3 AS (
  SELECT x.PRODUCT_CODE AS a, y.PRODUCT_CODE AS b, z.PRODUCT_CODE AS c, COUNT(*) AS freq
  FROM fb x JOIN fb y ON {same('x', 'y')} AND x.PRODUCT_CODE < y.PRODUCT_CODE
            JOIN fb z ON {same('x', 'z')} AND y.PRODUCT_CODE < z.PRODUCT_CODE
  WHERE (x.PRODUCT_CODE, y.PRODUCT_CODE) IN (SELECT (a, b) FROM f2)
  GROUP BY 1, 2, 3 HAVING COUNT(*) >= (SELECT t FROM fi_n)
),
freq AS (
  SELECT a AS ITEMS, 1 AS LENGTH, freq AS FREQ FROM f1
  UNION ALL SELECT a || ',' || b, 2, freq FROM f2
  UNION ALL SELECT a || ',' || b || ',' || c, 3, freq FROM f3
),
rules_all AS (
  SELECT * FROM (
    SELECT f2.a AS a1, NULL AS a2, f2.b AS CONSEQUENT, CAST(f2.freq AS DOUBLE) / f1.freq AS CONFIDENCE
    FROM f2 JOIN f1 ON f1.a = f2.a
    UNION ALL
    SELECT f2.b, NULL, f2.a, CAST(f2.freq AS DOUBLE) / f1.freq FROM f2 JOIN f1 ON f1.a = f2.b
    UNION ALL
    SELECT f3.a, f3.b, f3.c, CAST(f3.freq AS DOUBLE) / f2.freq FROM f3 JOIN f2 ON f2.a = f3.a AND f2.b = f3.b
    UNION ALL
    SELECT f3.a, f3.c, f3.b, CAST(f3.freq AS DOUBLE) / f2.freq FROM f3 JOIN f2 ON f2.a = f3.a AND f2.b = f3.c
    UNION ALL
    SELECT f3.b, f3.c, f3.a, CAST(f3.freq AS DOUBLE) / f2.freq FROM f3 JOIN f2 ON f2.a = f3.b AND f2.b = f3.c
  ) WHERE CONFIDENCE >= {p.min_confidence}
),
rules_txt AS (
  SELECT a1, a2, CASE WHEN a2 IS NULL THEN a1 ELSE a1 || ',' || a2 END AS ANTECEDENT, CONSEQUENT, CONFIDENCE
  FROM rules_all
)"""


def rules_apply(history: str, p: SimpleNamespace) -> str:
    """Containment of frequent sets / rule antecedents in a (USER_ID, PRODUCT_CODE) history.

    CTEs: own, priors (USER_ID, ITEMS), matches, candidates, recs.
    """
    return f"""
own AS (SELECT DISTINCT USER_ID, PRODUCT_CODE FROM {history}),
priors AS (
  SELECT h.USER_ID, f1.a AS ITEMS FROM own h JOIN f1 ON h.PRODUCT_CODE = f1.a
  UNION ALL
  SELECT h1.USER_ID, f2.a || ',' || f2.b FROM f2
    JOIN own h1 ON h1.PRODUCT_CODE = f2.a JOIN own h2 ON h2.USER_ID = h1.USER_ID AND h2.PRODUCT_CODE = f2.b
  UNION ALL
  SELECT h1.USER_ID, f3.a || ',' || f3.b || ',' || f3.c FROM f3
    JOIN own h1 ON h1.PRODUCT_CODE = f3.a JOIN own h2 ON h2.USER_ID = h1.USER_ID AND h2.PRODUCT_CODE = f3.b
    JOIN own h3 ON h3.USER_ID = h1.USER_ID AND h3.PRODUCT_CODE = f3.c
),
matches AS (
  SELECT h.USER_ID, r.ANTECEDENT, r.CONSEQUENT, r.CONFIDENCE
  FROM rules_txt r JOIN own h ON h.PRODUCT_CODE = r.a1
  WHERE r.a2 IS NULL OR EXISTS (SELECT 1 FROM own g WHERE g.USER_ID = h.USER_ID AND g.PRODUCT_CODE = r.a2)
),
candidates AS (
  SELECT USER_ID, CONSEQUENT AS PRODUCT_CODE, MAX(CONFIDENCE) AS CONFIDENCE FROM matches m
  WHERE NOT EXISTS (SELECT 1 FROM own g WHERE g.USER_ID = m.USER_ID AND g.PRODUCT_CODE = m.CONSEQUENT)
  GROUP BY 1, 2
),
recs AS (
  SELECT USER_ID, PRODUCT_CODE, CONFIDENCE, CAST(RANK AS INTEGER) AS RANK FROM (
    SELECT *, RANK() OVER (PARTITION BY USER_ID ORDER BY CONFIDENCE DESC, PRODUCT_CODE) AS RANK FROM candidates
  ) WHERE RANK <= {p.top_n}
)"""


def season_base(p: SimpleNamespace) -> str:
    """Binding A, time-window run: win, beh, hist, fut, bk, bk_kept, basket_items, itemsets, recs."""
    train = f" WHERE event_time < TIMESTAMP '{p.end_time:%Y-%m-%d %H:%M:%S}'" if p.holdout else ""
    return with_(
        SHOP,
        season_window("shop", "win"),
        "\nbeh AS (SELECT DISTINCT USER_ID, PRODUCT_CODE, date_trunc('second', event_time) AS event_time FROM win)",
        season_history("beh", "hist", half_open=p.holdout),
        season_future("beh", "fut"),
        f"""
bk AS (SELECT *, (epoch_us(event_time) // 86400000000) // {p.tran_days} AS BUCKET FROM beh{train}),
bk_kept AS (
  SELECT USER_ID, BUCKET, COUNT(*) AS N_ROWS FROM bk GROUP BY 1, 2
  HAVING COUNT(*) > 1 AND COUNT(*) < {p.max_items}
),
basket_items AS (
  SELECT DISTINCT b.USER_ID, b.BUCKET, b.PRODUCT_CODE FROM bk b JOIN bk_kept k USING (USER_ID, BUCKET)
)""",
        itemsets("basket_items", "USER_ID, BUCKET", p),
        rules_apply("hist", p),
    )


def _metrics_sql(rows: list[tuple[str, str]]) -> str:
    parts = [f"SELECT {k} AS pos, '{name}' AS metric, {expr} AS value FROM stats" for k, (name, expr) in enumerate(rows)]
    return "SELECT metric, value FROM (\n  " + "\n  UNION ALL ".join(parts) + "\n) ORDER BY pos"


def _ratio(num: str, den: str) -> str:
    return f"COALESCE(printf('%.9f', ROUND(CASE WHEN {den} = 0 THEN NULL ELSE CAST({num} AS DOUBLE) / {den} END, 9)), 'NaN')"


def _txt(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


def season_metrics(p: SimpleNamespace) -> str:
    return season_base(p) + """,
actual AS (SELECT DISTINCT USER_ID, PRODUCT_CODE FROM fut),
stats AS (
  SELECT (SELECT COUNT(*) FROM shop) AS n_raw,
         (SELECT COUNT(*) FROM beh) AS n_processed,
         (SELECT COUNT(*) FROM bk_kept) AS n_baskets,
         (SELECT COUNT(DISTINCT USER_ID) FROM hist) AS n_users,
         (SELECT COUNT(DISTINCT USER_ID) FROM recs) AS n_reco_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM recs) AS n_reco_items,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM beh) AS n_items,
         (SELECT COUNT(*) FROM recs) AS n_recs,
         (SELECT COUNT(*) FROM actual) AS n_actual,
         (SELECT COUNT(*) FROM recs r WHERE EXISTS (SELECT 1 FROM actual a WHERE a.USER_ID = r.USER_ID AND a.PRODUCT_CODE = r.PRODUCT_CODE)) AS n_hits
)
""" + _metrics_sql([
        ("OP_TIME", f"'{OP_TIME}'"),
        ("ARGUMENTS", "'0.02_0.15_1_100_10_auto'"),
        ("NUM_RAW_LOGS", _txt("n_raw")),
        ("NUM_PROCESSED_LOG", _txt("n_processed")),
        ("NUM_ACTION_TRANSACTIONS", _txt("n_baskets")),
        ("NUM_ALL_USERS", _txt("n_users")),
        ("NUM_POSSIBLE_USERS", _txt("n_reco_users")),
        ("NUM_RECOMMEND_ITEMS", _txt("n_reco_items")),
        ("PRECISION", _ratio("n_hits", "n_recs")),
        ("RECALL", _ratio("n_hits", "n_actual")),
        ("COVERAGE", _ratio("n_reco_items", "n_items")),
    ])


HOLDOUT_PARAMS = SimpleNamespace(**{**vars(SEASON_PARAMS), "holdout": True})
SEASON_BASE = season_base(SEASON_PARAMS)
SEASON_METRICS = season_metrics(SEASON_PARAMS)
HOLDOUT_METRICS = season_metrics(HOLDOUT_PARAMS)

FULL_BASE = with_(
    CLICKS,
    VIEWS,
    """
beh_full AS (
  SELECT DISTINCT USER_ID, PRODUCT_CODE FROM (
    SELECT USER_ID, PRODUCT_CODE FROM clicks UNION ALL SELECT USER_ID, PRODUCT_CODE FROM views
  ) WHERE USER_ID IS NOT NULL AND PRODUCT_CODE IS NOT NULL
)""",
    f"""
ub_kept AS (
  SELECT USER_ID, COUNT(*) AS N_ITEMS FROM beh_full GROUP BY 1
  HAVING COUNT(*) > 1 AND COUNT(*) < {FULL_PARAMS.max_items}
),
user_items AS (SELECT b.USER_ID, b.PRODUCT_CODE FROM beh_full b JOIN ub_kept k USING (USER_ID))""",
    itemsets("user_items", "USER_ID", FULL_PARAMS),
    rules_apply("beh_full", FULL_PARAMS),
)

FULL_METRICS = FULL_BASE + """,
stats AS (
  SELECT (SELECT COUNT(*) FROM clicks) + (SELECT COUNT(*) FROM views) AS n_raw,
         (SELECT COUNT(*) FROM beh_full) AS n_processed,
         (SELECT COUNT(*) FROM ub_kept) AS n_baskets,
         (SELECT COUNT(DISTINCT USER_ID) FROM beh_full) AS n_users,
         (SELECT COUNT(DISTINCT USER_ID) FROM recs) AS n_reco_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM recs) AS n_reco_items,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM beh_full) AS n_items
)
""" + _metrics_sql([
    ("OP_TIME", f"'{OP_TIME}'"),
    ("ARGUMENTS", "'0.1_0.3_100_10_auto'"),
    ("NUM_RAW_LOGS", _txt("n_raw")),
    ("NUM_PROCESSED_LOG", _txt("n_processed")),
    ("NUM_ACTION_TRANSACTIONS", _txt("n_baskets")),
    ("NUM_ALL_USERS", _txt("n_users")),
    ("NUM_POSSIBLE_USERS", _txt("n_reco_users")),
    ("NUM_POSSIBLE_ITEMS", _txt("n_reco_items")),
    ("COVERAGE", _ratio("n_reco_items", "n_items")),
])


# ------------------------------------------- cleansing, ratings, segments

PURCHASE_RES = """
plog AS (
  SELECT o.o_custkey AS USER_ID,
         'R' || CAST(l.l_partkey AS VARCHAR) AS RES_ID,
         CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE l.l_partkey END AS PRODUCT_CODE,
         1 + FLOOR((l.l_quantity - 1) / 10) AS SCORE,
         epoch_us(o.o_orderdate) // 1000 AS SCORE_TIME,
         o.o_orderdate AS event_time
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
),
rmap AS (
  SELECT DISTINCT RES_ID, PRODUCT_CODE FROM (
    SELECT 'R' || CAST(p_partkey AS VARCHAR) AS RES_ID, p_partkey AS PRODUCT_CODE FROM part
    UNION ALL
    SELECT 'R' || CAST(p_partkey AS VARCHAR), p_partkey + 1 FROM part WHERE p_partkey % 50 = 0
  )
),
filled AS (
  SELECT l.USER_ID, COALESCE(l.PRODUCT_CODE, m.PRODUCT_CODE) AS PRODUCT_CODE, l.SCORE
  FROM plog l LEFT JOIN rmap m ON l.RES_ID = m.RES_ID
  WHERE COALESCE(l.PRODUCT_CODE, m.PRODUCT_CODE) IS NOT NULL
)"""

SEGMENTS = """
seg AS (SELECT c_custkey AS USER_ID, c_mktsegment AS prediction FROM customer),
asg AS (SELECT * FROM seg WHERE USER_ID IN (SELECT USER_ID FROM purchase_ratings)),
seg_scores AS (
  SELECT a.prediction, r.PRODUCT_CODE, ROUND(SUM(r.SCORE), 12) + 0.0 AS score_sum
  FROM purchase_ratings r JOIN asg a ON a.USER_ID = r.USER_ID GROUP BY 1, 2
),
seg_top AS (
  SELECT prediction, PRODUCT_CODE, score_sum, CAST(RANK AS INTEGER) AS RANK FROM (
    SELECT *, RANK() OVER (PARTITION BY prediction ORDER BY score_sum DESC, PRODUCT_CODE) AS RANK
    FROM seg_scores WHERE score_sum > 0
  ) WHERE RANK <= 10
),
seg_recs AS (SELECT a.USER_ID, t.PRODUCT_CODE, t.RANK FROM asg a JOIN seg_top t ON t.prediction = a.prediction)"""

SEGMENT_METRICS = with_(PURCHASE_RATINGS, SEGMENTS) + """,
stats AS (
  SELECT (SELECT COUNT(*) FROM purchase_ratings) AS n_scores,
         (SELECT COUNT(DISTINCT USER_ID) FROM asg) AS n_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM purchase_ratings) AS n_items,
         (SELECT COUNT(DISTINCT USER_ID) FROM seg_recs) AS n_reco_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM seg_recs) AS n_reco_items
)
""" + _metrics_sql([
    ("OP_TIME", "'2000061500'"),
    ("ARGUMENTS", "'5_10_10'"),
    ("NUM_PROCESSED_LOG", _txt("n_scores")),
    ("NUM_ALL_USERS", _txt("n_users")),
    ("NUM_POSSIBLE_USERS", _txt("n_reco_users")),
    ("NUM_RECOMMEND_ITEMS", _txt("n_reco_items")),
    ("COVERAGE", _ratio("n_reco_items", "n_items")),
])

PREFERENCE = with_(CLICKS, VIEWS, PURCHASES) + """,
expl AS (
  SELECT USER_ID, PRODUCT_CODE, AVG(SCORE) AS SCORE FROM purchases
  WHERE USER_ID IS NOT NULL AND PRODUCT_CODE IS NOT NULL AND SCORE IS NOT NULL GROUP BY 1, 2
),
umean AS (SELECT USER_ID, AVG(SCORE) AS m FROM expl GROUP BY 1),
centered AS (SELECT e.USER_ID, e.PRODUCT_CODE, e.SCORE - u.m AS x FROM expl e JOIN umean u ON u.USER_ID = e.USER_ID),
implicit AS (
  SELECT USER_ID, PRODUCT_CODE,
         CAST(0.3 AS DOUBLE) * COUNT(*) FILTER (WHERE src = 0) + CAST(0.6 AS DOUBLE) * COUNT(*) FILTER (WHERE src = 1) AS y
  FROM (SELECT USER_ID, PRODUCT_CODE, 0 AS src FROM clicks UNION ALL SELECT USER_ID, PRODUCT_CODE, 1 FROM views)
  WHERE USER_ID IS NOT NULL AND PRODUCT_CODE IS NOT NULL
  GROUP BY 1, 2
),
pref AS (
  SELECT COALESCE(c.USER_ID, i.USER_ID) AS USER_ID, COALESCE(c.PRODUCT_CODE, i.PRODUCT_CODE) AS PRODUCT_CODE,
         ROUND(COALESCE(c.x, i.y), 9) + 0.0 AS SCORE
  FROM centered c FULL OUTER JOIN implicit i ON c.USER_ID = i.USER_ID AND c.PRODUCT_CODE = i.PRODUCT_CODE
)"""

# five centres: mean preferences of the users of one remainder of the id
GIVEN_CENTRES = PREFERENCE + """,
members AS (SELECT USER_ID, CAST(USER_ID % 5 AS INTEGER) AS g FROM (SELECT DISTINCT USER_ID FROM pref)),
sizes AS (SELECT g, COUNT(*) AS n FROM members GROUP BY g),
centres AS (
  SELECT s.g, p.PRODUCT_CODE, ROUND(ROUND(SUM(p.SCORE), 12) / s.n, 9) AS v
  FROM pref p JOIN members m ON m.USER_ID = p.USER_ID JOIN sizes s ON s.g = m.g GROUP BY s.g, s.n, p.PRODUCT_CODE
),
away AS (
  SELECT u.USER_ID, c.g,
         GREATEST(0, ROUND(u.n + c.n - 2 * COALESCE(d.x, 0), 9)) AS distance
  FROM (SELECT USER_ID, SUM(SCORE * SCORE) AS n FROM pref GROUP BY 1) u
  CROSS JOIN (SELECT g, SUM(v * v) AS n FROM centres GROUP BY 1) c
  LEFT JOIN (
    SELECT p.USER_ID, k.g, SUM(p.SCORE * k.v) AS x FROM pref p JOIN centres k ON k.PRODUCT_CODE = p.PRODUCT_CODE GROUP BY 1, 2
  ) d ON d.USER_ID = u.USER_ID AND d.g = c.g
),
nearest AS (
  SELECT USER_ID, g AS prediction, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY USER_ID ORDER BY distance, g) AS rn FROM away
  ) WHERE rn = 1
)"""

LOOKUP_USER = "Customer#000000124"

PEOPLE = f"""
people AS (
  SELECT DISTINCT c_custkey AS USER_ID, 'acct-' || CAST(c_custkey AS VARCHAR) AS ACCOUNT, c_name AS NAME
  FROM customer
),
found AS (
  SELECT * FROM people
  WHERE CAST(USER_ID AS VARCHAR) = '{LOOKUP_USER}' OR NAME = '{LOOKUP_USER}' OR ACCOUNT = '{LOOKUP_USER}'
),
products AS (SELECT DISTINCT p_partkey AS PRODUCT_CODE, p_name AS PRODUCT_NAME FROM part)"""

# ----------------------------------------------- runs with a resource map, runs on event ratings

RES_RATINGS = """
res_ratings AS (
  SELECT USER_ID, PRODUCT_CODE, AVG(SCORE) AS SCORE FROM filled
  WHERE USER_ID IS NOT NULL AND SCORE IS NOT NULL GROUP BY 1, 2
)"""
COSINE_RESOURCE_METRICS = cosine_metrics(
    with_(PURCHASE_RES, RES_RATINGS, sql_cosine("res_ratings", COSINE_PARAMS)), "res_ratings", COSINE_PARAMS, "0.7_20_5_2_10"
)

EVENT_COSINE = SimpleNamespace(min_sim=0.3, top_sim=20, min_commons=5, min_rating=2, top_n=10)
EVENT_RATINGS = """
event_ratings AS (
  SELECT USER_ID, PRODUCT_CODE, AVG(SCORE) AS SCORE FROM event_scores
  WHERE USER_ID IS NOT NULL AND PRODUCT_CODE IS NOT NULL AND SCORE IS NOT NULL GROUP BY 1, 2
)"""
COSINE_EVENTS_METRICS = cosine_metrics(
    with_(EVENT_SCORES, EVENT_RATINGS, sql_cosine("event_ratings", EVENT_COSINE)), "event_ratings", EVENT_COSINE, "0.3_20_5_2_10"
)

RESOURCE_RULES = SimpleNamespace(min_support=0.002, min_confidence=0.3, max_items=60, top_n=10)
FULL_RESOURCE_METRICS = with_(
    PURCHASE_RES,
    """
rf_items AS (SELECT DISTINCT USER_ID, CAST(PRODUCT_CODE AS VARCHAR) AS PRODUCT_CODE FROM filled WHERE USER_ID IS NOT NULL)""",
    f"""
ub_kept AS (
  SELECT USER_ID, COUNT(*) AS N_ITEMS FROM rf_items GROUP BY 1
  HAVING COUNT(*) > 1 AND COUNT(*) < {RESOURCE_RULES.max_items}
),
user_items AS (SELECT b.USER_ID, b.PRODUCT_CODE FROM rf_items b JOIN ub_kept k USING (USER_ID))""",
    itemsets("user_items", "USER_ID", RESOURCE_RULES),
    rules_apply("rf_items", RESOURCE_RULES),
) + """,
stats AS (
  SELECT (SELECT COUNT(*) FROM plog) AS n_raw,
         (SELECT COUNT(*) FROM rf_items) AS n_processed,
         (SELECT COUNT(*) FROM ub_kept) AS n_baskets,
         (SELECT COUNT(DISTINCT USER_ID) FROM rf_items) AS n_users,
         (SELECT COUNT(DISTINCT USER_ID) FROM recs) AS n_reco_users,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM recs) AS n_reco_items,
         (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM rf_items) AS n_items
)
""" + _metrics_sql([
    ("OP_TIME", "'2000061500'"),
    ("ARGUMENTS", "'0.002_0.3_60_10_auto'"),
    ("NUM_RAW_LOGS", _txt("n_raw")),
    ("NUM_PROCESSED_LOG", _txt("n_processed")),
    ("NUM_ACTION_TRANSACTIONS", _txt("n_baskets")),
    ("NUM_ALL_USERS", _txt("n_users")),
    ("NUM_POSSIBLE_USERS", _txt("n_reco_users")),
    ("NUM_POSSIBLE_ITEMS", _txt("n_reco_items")),
    ("COVERAGE", _ratio("n_reco_items", "n_items")),
])

PROFILE_FACTORS = with_(
    PURCHASE_RATINGS,
    """
rated_classes AS (
  SELECT r.USER_ID AS u, r.PRODUCT_CODE AS i, r.SCORE AS s, CAST(p.p_size % 5 + 1 AS INTEGER) AS m
  FROM purchase_ratings r JOIN part p ON p.p_partkey = r.PRODUCT_CODE
),
uf AS (
  SELECT u, """
    + ", ".join(f"COALESCE(ROUND(AVG(s) FILTER (m = {k}), 6), 0) AS f{k}" for k in range(1, 6))
    + """ FROM rated_classes GROUP BY u
),
mf AS (SELECT i, m, ROUND(AVG(s) / 5, 6) AS r FROM rated_classes GROUP BY i, m),
itf AS (
  SELECT i, """
    + ", ".join(f"CASE WHEN m = {k} THEN r ELSE ROUND(r / 4, 6) END AS g{k}" for k in range(1, 6))
    + """ FROM mf
),
scored AS (
  SELECT uf.u, itf.i, ROUND(f1 * g1 + f2 * g2 + f3 * g3 + f4 * g4 + f5 * g5, 9) AS prediction FROM uf, itf
  WHERE NOT EXISTS (SELECT 1 FROM rated_classes r WHERE r.u = uf.u AND r.i = itf.i)
)""",
)

FOLD_ERRORS = (
    PROFILE_FACTORS
    + """,
rated AS (
  SELECT (r.u * 31 + r.i) % 5 AS row_fold, r.s,
         ROUND(f1 * g1 + f2 * g2 + f3 * g3 + f4 * g4 + f5 * g5, 9) AS p
  FROM rated_classes r JOIN uf ON uf.u = r.u JOIN itf ON itf.i = r.i
)
SELECT CAST(f AS INTEGER) AS fold,
       COUNT(*) FILTER (row_fold <> f) AS n_train,
       COUNT(*) FILTER (row_fold = f) AS n_test,
       ROUND(SQRT(AVG((p - s) * (p - s)) FILTER (row_fold <> f)), 6) AS train_rmse,
       ROUND(SQRT(AVG((p - s) * (p - s)) FILTER (row_fold = f)), 6) AS test_rmse
FROM rated, range(5) t(f) GROUP BY f"""
)
