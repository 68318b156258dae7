"""SQL texts shared by the cross-checks."""

from __future__ import annotations

from larder.plans import retail
from larder.plans.retail import FIRST_LOAD, SECOND_LOAD, Retail

T0 = f"TIMESTAMP '{FIRST_LOAD}'"
T1 = f"TIMESTAMP '{SECOND_LOAD}'"
T2 = f"TIMESTAMP '{retail.THIRD_LOAD}'"
LAST_DAY = f"DATE '{retail.AS_OF}'"


def key_text(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), chr(0))" for e in exprs)
    return f"concat_ws(chr(31), {parts})"


def hash_key(*exprs: str) -> str:
    return f"CAST('0x' || substr(sha1({key_text(*exprs)}), 1, 15) AS BIGINT)"


def date_key(expr: str) -> str:
    return hash_key(f"strftime({expr}, '%Y-%m-%d')")


def snapshot(entity: str, second: bool, late_rows: bool = False) -> str:
    text, changed, late = retail.SNAPSHOTS[entity]
    rows = f"NOT ({late})" if late_rows and not second else "true"
    return text.replace("{changed}", f"({changed})" if second else "false").replace("{rows}", rows)


def dimension(entity: str, late_rows: bool = False) -> str:
    """Both loads of a dimension in one SELECT."""
    d = Retail.role(entity)
    cols = [*d.keys, *d.attrs]
    listed = ", ".join(f"n.{c}" for c in cols)
    old = ", ".join(f"o.{c}" for c in cols)
    on = " AND ".join(f"o.{k} = n.{k}" for k in d.keys)
    k = d.keys[0]
    same = " AND ".join(f"o.{a} IS NOT DISTINCT FROM n.{a}" for a in d.attrs)
    first_key = hash_key(*[f"o.{c}" for c in cols], T0)
    second_key = hash_key(*[f"n.{c}" for c in cols], T1)
    return f"""(WITH o AS ({snapshot(entity, False, late_rows)}), n AS ({snapshot(entity, True)})
      SELECT {first_key} AS {d.hash_key}, {old}, {T0} AS {d.start},
             CASE WHEN n.{k} IS NULL OR ({same}) THEN NULL ELSE {T1} END AS {d.end},
             (n.{k} IS NULL OR ({same})) AS {d.current}
      FROM o LEFT JOIN n ON {on}
      UNION ALL
      SELECT {second_key}, {listed}, {T1}, CAST(NULL AS TIMESTAMP), true
      FROM n LEFT JOIN o ON {on} WHERE o.{k} IS NULL OR NOT ({same}))"""


def as_written(entity: str) -> str:
    """Literal rules: a changed row closes what matches, and comes in only if nothing matches."""
    d = Retail.role(entity)
    cols = [*d.keys, *d.attrs]
    same = " AND ".join(f"o.{a} IS NOT DISTINCT FROM n.{a}" for a in d.attrs)
    k = d.keys[0]
    match = " AND ".join(f"o.{c} = n.{c}" for c in d.match_on)
    return f"""(WITH o AS ({snapshot(entity, False, True)}), n AS ({snapshot(entity, True)}),
      c AS (SELECT o.*, n.{k} IS NOT NULL AND NOT ({same}) AS changed FROM o LEFT JOIN n ON o.{k} = n.{k})
      SELECT {hash_key(*cols, T0)} AS {d.hash_key}, {', '.join(cols)}, {T0} AS {d.start},
             CASE WHEN changed THEN {T1} END AS {d.end}, NOT changed AS {d.current} FROM c
      UNION ALL
      SELECT {hash_key(*cols, T1)}, {', '.join(cols)}, {T1}, CAST(NULL AS TIMESTAMP), true
      FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE {match}))"""


def reverted(entity: str) -> str:
    """First state, second state, first state again."""
    d = Retail.role(entity)
    cols = [*d.keys, *d.attrs]
    same = " AND ".join(f"o.{a} IS NOT DISTINCT FROM n.{a}" for a in d.attrs)
    k = d.keys[0]
    listed = ", ".join(cols)

    def part(rows: str, start: str, end: str) -> str:
        return f"""SELECT {hash_key(*cols, start)} AS {d.hash_key}, {listed}, {start} AS {d.start}, {end} AS {d.end},
          {end} IS NULL AS {d.current} FROM {rows} WHERE {k} IN (SELECT {k} FROM changed)"""

    return f"""(WITH o AS ({snapshot(entity, False)}), n AS ({snapshot(entity, True)}),
      changed AS (SELECT o.{k} FROM o JOIN n ON o.{k} = n.{k} WHERE NOT ({same}))
      {part('o', T0, T1)} UNION ALL {part('n', T1, T2)} UNION ALL {part('o', T2, 'CAST(NULL AS TIMESTAMP)')} UNION ALL
      SELECT {hash_key(*cols, T0)}, {listed}, {T0}, CAST(NULL AS TIMESTAMP), true FROM o WHERE {k} NOT IN (SELECT {k} FROM changed))"""


ORDERS = f"({retail.ORDERS})"
DELIVERIES = f"({retail.DELIVERIES})"
ITEMS = f"(SELECT {hash_key(*retail.ITEM_KEY)} AS order_item_id, * FROM ({retail.ITEMS}))"

DATE_PARTS = """CAST(year({d}) AS INT) AS year, CAST(quarter({d}) AS INT) AS quarter, CAST(month({d}) AS INT) AS month,
  CAST(week({d}) AS INT) AS week, CAST(dayofyear({d}) AS INT) AS day_of_year, CAST(dayofweek({d}) AS INT) AS day_of_week,
  CAST(day({d}) AS INT) AS day_of_the_month, strftime({d}, '%a') AS day_name"""


def date_parts(expr: str) -> str:
    return DATE_PARTS.replace("{d}", expr)


DATES = f"""(SELECT {date_key('calendar_date')} AS date_dim_hk, calendar_date, {date_parts('calendar_date')}
  FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM {{orders}}), CAST({LAST_DAY} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
        AS calendar_date))"""


def valid(alias: str, start: str, end: str) -> str:
    """Versions of the first load are the first of their keys: they also hold for older orders."""
    return f"({alias}.{start} = {T0} OR {alias}.{start} <= o.order_date) AND ({alias}.{end} IS NULL OR o.order_date < {alias}.{end})"


FACT = f"""(SELECT i.order_item_id, i.order_id_fk AS order_id, c.customer_hk AS customer_dim_key,
    a.customer_address_hk AS customer_address_dim_key, r.restaurant_hk AS restaurant_dim_key,
    l.restaurant_location_hk AS restaurant_location_dim_key, m.menu_dim_hk AS menu_dim_key,
    g.delivery_agent_hk AS delivery_agent_dim_key, d.date_dim_hk AS order_date_dim_key,
    CAST(i.quantity AS BIGINT) AS quantity, i.price, i.subtotal, v.delivery_status, v.estimated_time
  FROM {ITEMS} i
  LEFT JOIN {ORDERS} o ON i.order_id_fk = o.order_id
  LEFT JOIN {DELIVERIES} v ON v.order_id_fk = o.order_id
  LEFT JOIN {dimension('customer')} c ON c.customer_id = CAST(o.customer_id_fk AS VARCHAR)
       AND {valid('c', 'eff_start_date', 'eff_end_date')}
  LEFT JOIN {dimension('customer_address')} a ON a.address_id = v.customer_address_id_fk
       AND {valid('a', 'eff_start_date', 'eff_end_date')}
  LEFT JOIN {dimension('restaurant')} r ON r.restaurant_id = i.restaurant_id_fk
       AND {valid('r', 'eff_start_date', 'eff_end_date')}
  LEFT JOIN {dimension('location')} l ON l.location_id = r.location_id_fk AND {valid('l', 'eff_start_dt', 'eff_end_dt')}
  LEFT JOIN {dimension('menu')} m ON m.menu_id = i.menu_id_fk AND {valid('m', 'eff_start_date', 'eff_end_date')}
  LEFT JOIN {dimension('delivery_agent')} g ON g.delivery_agent_id = v.delivery_agent_id_fk
       AND {valid('g', 'eff_start_date', 'eff_end_date')}
  LEFT JOIN {DATES} d ON d.calendar_date = CAST(o.order_date AS DATE))"""

# The joins a revenue mart needs, straight from the bound tables.
REVENUE_ROWS = f"""(SELECT i.order_item_id, i.order_id_fk AS order_id, i.subtotal, v.delivery_status,
    s.s_name AS restaurant_name, {date_parts('o.order_date')}
  FROM {ITEMS} i JOIN {ORDERS} o ON i.order_id_fk = o.order_id
  JOIN {DELIVERIES} v ON v.order_id_fk = o.order_id JOIN {{supplier}} s ON s.s_suppkey = i.restaurant_id_fk)"""


def ratio(total: str, count: str) -> str:
    """Rounded half up in decimals, as doubles round halves either way."""
    return f"CAST(round(CAST(CAST({total} AS DOUBLE) / {count} AS DECIMAL(30,9)), 2) AS DOUBLE)"


KPI_MEASURES = f"""CAST(sum(subtotal) AS DOUBLE) AS total_revenue, count(DISTINCT order_id) AS total_orders,
  {ratio('sum(subtotal)', 'count(DISTINCT order_id)')} AS avg_revenue_per_order,
  {ratio('sum(subtotal)', 'count(order_item_id)')} AS avg_revenue_per_item,
  CAST(max(subtotal) AS DOUBLE) AS max_order_value"""


def kpis(by: str, where: str = "true") -> str:
    groups = ", ".join(g.split(" AS ")[0] for g in by.split(", "))
    return f"SELECT {by}, {KPI_MEASURES} FROM {REVENUE_ROWS} WHERE {where} GROUP BY {groups}"


DELIVERED = "delivery_status = 'Delivered'"
YEARLY = kpis("year", DELIVERED)
MONTHLY = kpis("year, month", DELIVERED)
BY_RESTAURANT = kpis("year, month, delivery_status, restaurant_name")
