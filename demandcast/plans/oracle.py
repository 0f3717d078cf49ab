"""Oracle SQL (DuckDB dialect) for the registered queries.

Written on purpose in the *literal* form of the original pipeline — one
self-join per lag, range joins for trailing windows, correlated look-backs for
last sale, a plain row-based LAG for the price shift — so it checks the fused
window plans of the Spark side instead of mirroring them.  Tables
``lineitem part supplier nation`` are views registered by the caller.
"""

from __future__ import annotations

from demandcast.spec import FIXTURE, FactSpec

FACT = """fact AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INT) AS date_block_num,
         s_nationkey AS campaign_id,
         p_size AS product_id,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (1 - CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS purchase_price,
         CAST(l_quantity AS INT) AS orders
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

ITEMS = """items AS (
  SELECT p_size AS id, min_by(p_name, p_partkey) AS name, min_by(p_type, p_partkey) AS short_description,
         CAST(regexp_extract(min_by(p_brand, p_partkey), '[0-9]+', 0) AS INT) AS categories_id,
         min_by(p_brand, p_partkey) AS categories_name
  FROM part GROUP BY p_size HAVING p_size NOT IN (17, 34))"""

MARKETING = """marketing AS (
  SELECT s_nationkey AS ID, CAST(SUM(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) / 10 AS Marketing_Cost_Day
  FROM supplier GROUP BY s_nationkey)"""

COSTS = """costs AS (SELECT n_name AS item, CAST(1000 * (n_nationkey + 1) AS BIGINT) AS cost FROM nation)"""

CELLS = """cells AS (
  SELECT date_block_num, campaign_id, product_id,
         CAST(SUM(orders) AS BIGINT) AS item_cnt_month,
         SUM((price - purchase_price) * orders) AS profit_month
  FROM fact GROUP BY date_block_num, campaign_id, product_id)"""

MATRIX = """matrix AS (
  SELECT c.date_block_num, c.campaign_id, c.product_id, c.item_cnt_month, c.profit_month,
         i.name, i.short_description, i.categories_id, i.categories_name
  FROM cells c LEFT JOIN items i ON c.product_id = i.id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (FACT, ITEMS, CELLS, MATRIX)


def _trailing_stats(name: str, keys: list[str], prefix: str, periods, src: str = "matrix") -> str:
    """Group sums, then a range self-join over the previous max(periods) months."""
    k = ", ".join(keys)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    on = " AND ".join(f"h.{c} = g.{c}" for c in keys)
    pmax = max(periods)
    sums = []
    for p in periods:
        sums.append(f"COALESCE(SUM(CASE WHEN h.date_block_num >= g.date_block_num - {p} THEN h.x END), 0) AS s{p}")
        sums.append(f"CAST(COALESCE(SUM(CASE WHEN h.date_block_num >= g.date_block_num - {p} THEN h.x * h.x END), 0)"
                    f" AS DOUBLE) AS q{p}")
    raw = []
    for p in periods:
        raw.append(f"CAST(s{p} AS DOUBLE) / {p} AS a{p}")
        raw.append(f"sqrt(greatest(q{p} / {p} - (CAST(s{p} AS DOUBLE) / {p}) * (CAST(s{p} AS DOUBLE) / {p}), 0.0)) AS d{p}")
    outs = []
    for p in periods:
        outs.append(f"a{p} / NULLIF(CAST(SUM(s{p}) OVER () AS DOUBLE) / ({p} * COUNT(*) OVER ()), 0)"
                    f" AS {prefix}_avg_sale_last_{p}")
        outs.append(f"round(d{p} / NULLIF(AVG(d{p}) OVER (), 0), 6) AS {prefix}_std_sale_last_{p}")
    gk = ", ".join(f"g.{c}" for c in keys)
    return f"""{name}_g AS (SELECT date_block_num, {k}, SUM(item_cnt_month) AS x FROM {src}
    WHERE {notnull} GROUP BY date_block_num, {k}),
{name}_s AS (SELECT g.date_block_num, {gk}, {", ".join(sums)}
    FROM {name}_g g LEFT JOIN {name}_g h ON {on}
         AND h.date_block_num BETWEEN g.date_block_num - {pmax} AND g.date_block_num - 1
    GROUP BY g.date_block_num, {gk}),
{name}_r AS (SELECT date_block_num, {k}, {", ".join(s.split(" AS ")[-1] for s in sums)}, {", ".join(raw)} FROM {name}_s),
{name} AS (SELECT date_block_num, {k}, {", ".join(outs)} FROM {name}_r)"""


def _encoding(name: str, keys: list[str], col: str) -> str:
    gk = ", ".join(["date_block_num", *keys])
    notnull = " AND ".join([f"{c} IS NOT NULL" for c in keys] or ["TRUE"])
    return (f"{name} AS (SELECT {gk}, CAST(SUM(item_cnt_month) AS DOUBLE) / COUNT(*) AS {col} "
            f"FROM matrix WHERE {notnull} GROUP BY {gk})")


def feature_ctes(spec: FactSpec = FIXTURE) -> list[str]:
    """CTEs ending in ``features`` (the reference feature matrix, literal form)."""
    ctes = list(BASE)
    stat_names = []
    for keys, prefix, periods in spec.group_stats:
        n = f"gs_{prefix}"
        ctes.append(_trailing_stats(n, list(keys), prefix, periods))
        stat_names.append((n, list(keys), prefix, periods))
    enc_names = []
    for keys, col, lags in spec.encodings:
        n = f"te_{col}"
        ctes.append(_encoding(n, list(keys), col))
        enc_names.append((n, list(keys), col, lags))
    # revenue delta per (month, campaign)
    ctes.append("""cr AS (SELECT date_block_num, campaign_id, SUM(price - purchase_price) AS rev FROM fact
    GROUP BY date_block_num, campaign_id),
ca AS (SELECT campaign_id, CAST(SUM(rev) AS DOUBLE) / COUNT(*) AS avg_rev FROM cr GROUP BY campaign_id),
cd AS (SELECT cr.date_block_num, cr.campaign_id, (CAST(cr.rev AS DOUBLE) - ca.avg_rev) / NULLIF(ca.avg_rev, 0) AS delta_revenue
    FROM cr JOIN ca ON cr.campaign_id = ca.campaign_id)""")
    # matrix with the unlagged encodings and revenue delta, for the lag self-joins
    te_cols = ", ".join(f"{n}.{col}" for n, _, col, _ in enc_names)
    te_joins = "\n    ".join(
        f"LEFT JOIN {n} ON {n}.date_block_num = m.date_block_num"
        + "".join(f" AND {n}.{k} = m.{k}" for k in keys)
        for n, keys, _, _ in enc_names)
    ctes.append(f"""mte AS (SELECT m.*, {te_cols}, cd.delta_revenue FROM matrix m
    {te_joins}
    LEFT JOIN cd ON cd.date_block_num = m.date_block_num AND cd.campaign_id = m.campaign_id)""")
    # price row lags (R3): plain row-based LAG inside the product in matrix order
    k_max = max(spec.price_lags)
    lag_cols = ", ".join(
        f"LAG(pmp.mp, {k}) OVER (PARTITION BY m.product_id ORDER BY m.date_block_num, m.campaign_id) AS l{k}"
        for k in spec.price_lags)
    deltas = ", ".join(f"(l{k} - ap) / NULLIF(ap, 0)" for k in spec.price_lags)
    ctes.append(f"""pmp AS (SELECT date_block_num, product_id, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS mp FROM fact
    GROUP BY date_block_num, product_id),
ip AS (SELECT product_id, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS ap FROM fact GROUP BY product_id),
pr AS (SELECT m.date_block_num, m.campaign_id, m.product_id, ip.ap, {lag_cols}
    FROM matrix m LEFT JOIN pmp ON pmp.date_block_num = m.date_block_num AND pmp.product_id = m.product_id
    LEFT JOIN ip ON ip.product_id = m.product_id),
prt AS (SELECT date_block_num, campaign_id, product_id, COALESCE({deltas}, 0.0) AS delta_price_lag FROM pr)""")
    _ = k_max
    # recency / tenure
    cap = "" if spec.max_month is None else f" AND m.date_block_num <= {spec.max_month}"
    ctes.append(f"""rec AS (SELECT m.date_block_num, m.campaign_id, m.product_id,
    (SELECT MAX(h.date_block_num) FROM matrix h WHERE h.campaign_id = m.campaign_id AND h.product_id = m.product_id
        AND h.date_block_num < m.date_block_num AND h.item_cnt_month > 0{cap}) AS item_campaign_last_sale,
    (SELECT MAX(h.date_block_num) FROM matrix h WHERE h.product_id = m.product_id
        AND h.date_block_num < m.date_block_num AND h.item_cnt_month > 0{cap}) AS item_last_sale,
    m.date_block_num - (SELECT MIN(h.date_block_num) FROM matrix h WHERE h.campaign_id = m.campaign_id
        AND h.product_id = m.product_id) AS item_campaign_first_sale,
    m.date_block_num - (SELECT MIN(h.date_block_num) FROM matrix h WHERE h.product_id = m.product_id) AS item_first_sale
    FROM matrix m)""")
    # assemble
    distances = sorted({i for i in spec.count_lags} | {i for _, _, _, lags in enc_names for i in lags} | {1})
    joins = "\n  ".join(
        f"LEFT JOIN mte t{i} ON t{i}.campaign_id = m.campaign_id AND t{i}.product_id = m.product_id"
        f" AND t{i}.date_block_num = m.date_block_num - {i}" for i in distances)
    sel = ["m.date_block_num", "m.campaign_id", "m.product_id", "m.item_cnt_month",
           "CAST(m.profit_month AS DOUBLE) AS profit_month", "m.name", "m.short_description",
           "m.categories_id", "m.categories_name"]
    sel += [f"t{i}.item_cnt_month AS item_cnt_month_lag_{i}" for i in spec.count_lags]
    stat_joins = []
    for n, keys, prefix, periods in stat_names:
        for p in periods:
            sel += [f"{n}.{prefix}_avg_sale_last_{p}", f"{n}.{prefix}_std_sale_last_{p}"]
        stat_joins.append(f"LEFT JOIN {n} ON {n}.date_block_num = m.date_block_num"
                          + "".join(f" AND {n}.{k} = m.{k}" for k in keys))
    for n, keys, col, lags in enc_names:
        sel += [f"t{i}.{col} AS {col}_lag_{i}" for i in lags]
    sel += ["prt.delta_price_lag", "t1.delta_revenue AS delta_revenue_lag_1", "rec.item_campaign_last_sale",
            "rec.item_last_sale", "rec.item_campaign_first_sale", "rec.item_first_sale"]
    sj = "\n  ".join(stat_joins)
    key_join = lambda t: (f"LEFT JOIN {t} ON {t}.date_block_num = m.date_block_num AND {t}.campaign_id = m.campaign_id"
                          f" AND {t}.product_id = m.product_id")
    ctes.append(f"""features AS (SELECT {", ".join(sel)}
  FROM matrix m
  {joins}
  {sj}
  {key_join("prt")}
  {key_join("rec")})""")
    return ctes


def features_sql(spec: FactSpec = FIXTURE, tail: str = "SELECT * FROM features") -> str:
    return with_ctes(*feature_ctes(spec)) + tail
