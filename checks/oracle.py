"""Reference SQL for every registered query, in DuckDB's dialect.

Queries are built from named views. A view is one SELECT that mentions other views; ``compose``
turns a view and whatever it needs into one WITH statement. ``@`` in a name or body stands for
the entity set (``web``, ``dirty``, ``volume``). Money is whole cents (BIGINT, ``…_c``) up to the
last projection.
"""

from __future__ import annotations

import re

from merchlake.sources import supplied
from merchlake.sources.supplied import COPY_EVERY, FAULTS, KEYS, REPEATS, UNKEYED_EVERY

# Fixed values, written out here so that a slip in the library does not pass: calendar names, members
# for missing attributes, pages of the funnel's steps, and its stages with the columns they sum.
MONTH_NAMES = (
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()
)
DAY_NAMES = "lundi mardi mercredi jeudi vendredi samedi dimanche".split()
NOT_GIVEN = {
    "utm_source": "(non renseigné)",
    "utm_campaign": "(non renseignée)",
    "utm_content": "(non renseigné)",
    "http_referer": "(aucun)",
}
STEP_PAGES = {
    "product_list": "/products",
    "product_detail": "/the-original-mr-fuzzy /the-forever-love-bear /the-birthday-sugar-panda "
    "/the-hudson-river-mini-bear",
    "cart": "/cart",
    "shipping": "/shipping",
    "billing": "/billing /billing-2",
}
STAGES = [
    ("Sessions", "sessions"),
    ("Liste produits", "product_list_sessions"),
    ("Fiche produit", "product_detail_sessions"),
    ("Panier", "cart_sessions"),
    ("Livraison", "shipping_sessions"),
    ("Facturation", "billing_sessions"),
    ("Commande", "order_sessions"),
]

SETS = ["web", "dirty", "volume"]
VIEWS: dict[str, str] = {}

COLUMNS = {
    "website_sessions": "website_session_id created_at user_id is_repeat_session utm_source "
    "utm_campaign utm_content device_type http_referer",
    "website_pageviews": "website_pageview_id created_at website_session_id pageview_url",
    "products": "product_id created_at product_name",
    "orders": "order_id created_at website_session_id user_id primary_product_id items_purchased "
    "price_usd cogs_usd",
    "order_items": "order_item_id created_at order_id product_id is_primary_item price_usd cogs_usd",
    "order_item_refunds": "order_item_refund_id created_at order_item_id order_id refund_amount_usd",
}
COLUMNS = {name: columns.split() for name, columns in COLUMNS.items()}


def view(name: str, sql: str, sets: list[str] | None = None) -> None:
    if "@" in name:
        for entity_set in sets or SETS:
            VIEWS[name.replace("@", entity_set)] = sql.replace("@", entity_set)
    else:
        VIEWS[name] = sql


def compose(sql: str) -> str:
    """``sql`` preceded by the views it needs, in dependency order."""
    order: list[str] = []

    def visit(body: str, stack: tuple[str, ...]) -> None:
        for word in dict.fromkeys(re.findall(r"\bv_\w+", body)):
            if word in order or word in stack:
                continue
            visit(VIEWS[word], (*stack, word))
            order.append(word)

    visit(sql, ())
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + f"\n{sql}"


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def choose(number: str, values: list[str | None]) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE {number} {cases} END"


def dollars(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) / 100.0 AS {alias or column.removesuffix('_c') + '_usd'}"


def half_up(part: str, whole: str, digits: int) -> str:
    """part / whole rounded half up, in whole numbers; 0 for an empty whole; part >= 0."""
    unit = 10**digits
    return (
        f"CASE WHEN {whole} = 0 THEN 0.0 ELSE "
        f"CAST(({part} * {2 * unit} + {whole}) // (2 * {whole}) AS DOUBLE) / {unit}.0 END"
    )


def per_unit(amount_c: str, count: str) -> str:
    """Cents per unit, as dollars with two digits."""
    return (
        f"CASE WHEN {count} = 0 THEN 0.0 ELSE "
        f"CAST((2 * {amount_c} + {count}) // (2 * {count}) AS DOUBLE) / 100.0 END"
    )


def quotient(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) END"


def zero(*columns: str, source: str = "") -> str:
    prefix = f"{source}." if source else ""
    return ", ".join(f"coalesce({prefix}{c}, 0) AS {c}" for c in columns)


# --- entities ------------------------------------------------------------------------------

view(
    "v_ev",
    f"""SELECT event_id, ts, user_id, event_type, {cents('value')} AS cents,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        datediff('day', DATE '{supplied.EPOCH}', CAST(ts AS DATE)) AS day,
        user_id * 100000 + datediff('day', DATE '{supplied.EPOCH}', CAST(ts AS DATE))
            AS website_session_id
    FROM events""",
)
view(
    "v_buy",
    """SELECT *, 1 + k % 2 AS item_count, cents * (1 + k % 2) AS order_cents,
        cents * (1 + k % 2) * 60 // 100 AS order_cost
    FROM v_ev WHERE event_type = 'purchase'""",
)
view(
    "v_lines",
    """SELECT *, event_id * 10 + line AS order_item_id,
        CASE WHEN line = 1 THEN order_cost - (item_count - 1) * (cents * 60 // 100)
             ELSE cents * 60 // 100 END AS item_cost
    FROM (SELECT *, unnest(range(1, item_count + 1)) AS line FROM v_buy)""",
)
view(
    "v_raw_website_sessions_web",
    f"""SELECT s.website_session_id, s.created_at, s.user_id,
        CASE WHEN s.day = f.day THEN 0 ELSE 1 END AS is_repeat_session,
        {choose('k0 % 4', [' GSearch ', 'bsearch', 'socialbook', None])} AS utm_source,
        {choose('k0 % 3', ['NonBrand', 'brand', None])} AS utm_campaign,
        {choose('k0 % 4', ['ad_0', 'ad_1', 'ad_2', None])} AS utm_content,
        CASE WHEN k0 % 10 < 7 THEN 'desktop' ELSE 'mobile' END AS device_type,
        CASE WHEN k0 % 5 <> 0 THEN 'https://www.search.example' END AS http_referer
    FROM (SELECT website_session_id, user_id, day, min(ts) AS created_at,
                 (array_agg(k ORDER BY ts, event_id))[1] AS k0
          FROM v_ev GROUP BY ALL) s
    JOIN (SELECT user_id, min(day) AS day FROM v_ev GROUP BY ALL) f USING (user_id)""",
)
view(
    "v_raw_website_pageviews_web",
    f"""SELECT event_id AS website_pageview_id, ts AS created_at, website_session_id,
        CASE event_type WHEN 'view' THEN '/products'
            WHEN 'click' THEN {choose('k % 4', supplied.PRODUCT_PAGES)}
            WHEN 'signup' THEN '/cart' WHEN 'error' THEN '/shipping'
            ELSE {choose('k % 2', ['/billing', '/billing-2'])} END AS pageview_url
    FROM v_ev""",
)
view(
    "v_raw_products_web",
    f"""SELECT CAST(p_partkey AS INTEGER) AS product_id,
        TIMESTAMP '{supplied.EPOCH} 00:00:00' AS created_at, p_name AS product_name
    FROM part""",
)
view(
    "v_raw_orders_web",
    """SELECT event_id AS order_id, ts AS created_at, website_session_id, user_id,
        CAST((event_id * 7 + 1) % 200 AS INTEGER) AS primary_product_id,
        item_count AS items_purchased, order_cents / 100.0 AS price_usd,
        order_cost / 100.0 AS cogs_usd
    FROM v_buy""",
)
view(
    "v_raw_order_items_web",
    """SELECT order_item_id, ts AS created_at, event_id AS order_id,
        CAST((event_id * 7 + line) % 200 AS INTEGER) AS product_id,
        CASE WHEN line = 1 THEN 1 ELSE 0 END AS is_primary_item,
        cents / 100.0 AS price_usd, item_cost / 100.0 AS cogs_usd
    FROM v_lines""",
)
view(
    "v_raw_order_item_refunds_web",
    """SELECT order_item_id * 10 + j AS order_item_refund_id,
        ts + CASE WHEN j = 1 THEN INTERVAL 3 DAY ELSE INTERVAL 40 DAY END AS created_at,
        order_item_id, event_id AS order_id, (cents // 2) / 100.0 AS refund_amount_usd
    FROM (SELECT *, unnest(range(1, CASE WHEN k % 34 = 0 THEN 3 ELSE 2 END)) AS j
          FROM v_lines WHERE k % 17 = 0)""",
)
view(
    "v_raw_website_sessions_volume",
    """SELECT o_orderkey AS website_session_id, o_orderdate AS created_at, o_custkey AS user_id,
        o_orderkey % 2 AS is_repeat_session,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS utm_source,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS utm_campaign,
        CASE WHEN o_orderpriority <> '5-LOW' AND o_orderkey % 3 = 0 THEN 'ad_x' END AS utm_content,
        CASE WHEN o_orderkey % 4 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'https://www.search.example' END AS http_referer
    FROM orders""",
)
view(
    "v_li",
    f"""SELECT *, l_orderkey * 10 + l_linenumber AS line_id, {cents('l_extendedprice')} AS cents
    FROM lineitem""",
)
view(
    "v_raw_website_pageviews_volume",
    f"""SELECT line_id AS website_pageview_id, l_shipdate AS created_at,
        l_orderkey AS website_session_id,
        {choose('l_linenumber % 6', ['/products', supplied.PRODUCT_PAGES[0], '/cart', '/shipping',
                                     '/billing', '/home'])} AS pageview_url
    FROM v_li""",
)
view("v_raw_products_volume", "SELECT * FROM v_raw_products_web")
view(
    "v_raw_orders_volume",
    f"""SELECT o_orderkey AS order_id, o_orderdate AS created_at,
        o_orderkey AS website_session_id, o_custkey AS user_id,
        CAST(o_orderkey % 200 AS INTEGER) AS primary_product_id,
        CAST(1 + o_orderkey % 3 AS INTEGER) AS items_purchased,
        {cents('o_totalprice')} / 100.0 AS price_usd,
        ({cents('o_totalprice')} * 60 // 100) / 100.0 AS cogs_usd
    FROM orders""",
)
view(
    "v_raw_order_items_volume",
    """SELECT line_id AS order_item_id, l_shipdate AS created_at, l_orderkey AS order_id,
        CAST(l_partkey AS INTEGER) AS product_id,
        CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_primary_item,
        cents / 100.0 AS price_usd, (cents * 60 // 100) / 100.0 AS cogs_usd
    FROM v_li""",
)
view(
    "v_raw_order_item_refunds_volume",
    """SELECT line_id AS order_item_refund_id, l_shipdate + INTERVAL 30 DAY AS created_at,
        line_id AS order_item_id, l_orderkey AS order_id, (cents // 2) / 100.0 AS refund_amount_usd
    FROM v_li WHERE l_returnflag = 'R'""",
)


def _dirty(name: str) -> str:
    key, clean = KEYS[name], f"v_raw_{name}_web"
    every, changed_column, changed = REPEATS[name]

    def selection(replaced: dict[str, str]) -> str:
        return ", ".join(f"{replaced.get(c, c)} AS {c}" for c in COLUMNS[name])

    faults = {}
    for column, steps in FAULTS[name].items():
        value = column
        for step, bad in steps:
            value = f"CASE WHEN {key} % {step} = 0 THEN {bad} ELSE {value} END"
        faults[column] = value
    return f"""SELECT {selection(faults)} FROM {clean}
    UNION ALL SELECT {selection({changed_column: changed})} FROM {clean} WHERE {key} % {every} = 0
    UNION ALL SELECT {selection({})} FROM {clean} WHERE {key} % {COPY_EVERY} = 0
    UNION ALL SELECT {selection({key: 'NULL'})} FROM {clean} WHERE {key} % {UNKEYED_EVERY} = 0"""


for _name in COLUMNS:
    view(f"v_raw_{_name}_dirty", _dirty(_name))

# --- rules ---------------------------------------------------------------------------------

_AMOUNT = "coalesce({0} >= 0 AND NOT isnan({0}), false)"
_FILLED = r"coalesce(regexp_replace({0}, '\s', '', 'g') <> '', true)"


def _member(column: str, reference: str, reference_column: str) -> str:
    # A reference holding NULLs must not turn a miss into NULL.
    return (
        f"coalesce({column} IN (SELECT {reference_column} FROM {reference} "
        f"WHERE {reference_column} IS NOT NULL), false)"
    )


ROW_RULES = {
    "website_sessions": [
        "website_session_id IS NOT NULL",
        "user_id IS NOT NULL",
        "coalesce(device_type IN ('desktop', 'mobile'), false)",
    ],
    "website_pageviews": [
        "website_session_id IS NOT NULL",
        _FILLED.format("pageview_url"),
        "created_at IS NOT NULL",
    ],
    "products": [_FILLED.format("product_name"), "created_at IS NOT NULL"],
    "orders": [
        "website_session_id IS NOT NULL",
        "user_id IS NOT NULL",
        "coalesce(items_purchased > 0, false)",
        _AMOUNT.format("price_usd"),
        _AMOUNT.format("cogs_usd"),
    ],
    "order_items": [
        _AMOUNT.format("price_usd"),
        _AMOUNT.format("cogs_usd"),
        _member("order_id", "v_ok_orders_@", "order_id"),
        _member("product_id", "v_ok_products_@", "product_id"),
    ],
    "order_item_refunds": [
        _AMOUNT.format("refund_amount_usd"),
        _member("order_item_id", "v_ok_order_items_@", "order_item_id"),
        _member("order_id", "v_ok_orders_@", "order_id"),
    ],
}


def ranked(name: str, entity_set: str) -> str:
    key = KEYS[name]
    order = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS[name] if c != key)
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rank "
        f"FROM v_raw_{name}_{entity_set}"
    )


for _name, _rules in ROW_RULES.items():
    view(
        f"v_judged_{_name}_@",
        f"SELECT {', '.join(COLUMNS[_name])}, _rank = 1 AND {' AND '.join(_rules)} AS is_valid "
        f"FROM ({ranked(_name, '@')})",
    )
    view(
        f"v_ok_{_name}_@",
        f"SELECT {', '.join(COLUMNS[_name])} FROM v_judged_{_name}_@ WHERE is_valid",
    )

# --- transforms ----------------------------------------------------------------------------


def stripped(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '^\s+', ''), '\s+$', '')"


_MARGIN = "price_usd - cogs_usd AS gross_profit"
NORMALISED = {
    "website_sessions": ", ".join(
        f"lower({stripped(c)}) AS {c}"
        if c in ("utm_source", "utm_campaign", "utm_content", "device_type")
        else c
        for c in COLUMNS["website_sessions"]
    ),
    "website_pageviews": "*",
    "products": f"product_id, created_at, {stripped('product_name')} AS product_name",
    "orders": f"*, {_MARGIN}",
    "order_items": f"*, {_MARGIN}",
    "order_item_refunds": "*",
}

# Staged tables, with money in cents beside the floating-point columns.
_CENTS = {
    "orders": f", {cents('price_usd')} AS price_c, {cents('cogs_usd')} AS cogs_c",
    "order_items": f", {cents('price_usd')} AS price_c, {cents('cogs_usd')} AS cogs_c",
    "order_item_refunds": f", {cents('refund_amount_usd')} AS refund_c",
}
for _name, _select in NORMALISED.items():
    _extra = _CENTS.get(_name, "")
    # No rule rejects a row of the clean set, so its staging needs no rules.
    view(f"v_st_{_name}_web", f"SELECT {_select}{_extra} FROM v_raw_{_name}_web")
    for _set in ("dirty", "volume"):
        view(f"v_st_{_name}_{_set}", f"SELECT {_select}{_extra} FROM v_ok_{_name}_{_set}")

# --- dimensions ----------------------------------------------------------------------------

view(
    "v_range_@",
    "SELECT CAST(min(a) AS DATE) AS start_date, CAST(max(b) AS DATE) AS end_date FROM ("
    + " UNION ALL ".join(
        f"SELECT min(created_at) AS a, max(created_at) AS b FROM v_st_{name}_@" for name in COLUMNS
    )
    + ")",
)
view(
    "v_dim_date_@",
    f"""SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_key, date, day(date) AS day,
        month(date) AS month, {choose('month(date) - 1', MONTH_NAMES)} AS month_name,
        quarter(date) AS quarter, year(date) AS year, isodow(date) AS day_of_week,
        {choose('isodow(date) - 1', DAY_NAMES)} AS day_name, isodow(date) >= 6 AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date
          FROM v_range_@)""",
)
view(
    "v_dim_customer_@",
    """SELECT coalesce(s.user_id, o.user_id) AS user_id, first_session_at, last_session_at,
        first_order_at, coalesce(again, false) AS has_repeat_session,
        o.user_id IS NOT NULL AS is_buyer
    FROM (SELECT user_id, min(created_at) AS first_session_at, max(created_at) AS last_session_at,
                 bool_or(is_repeat_session = 1) AS again
          FROM v_st_website_sessions_@ GROUP BY user_id) s
    FULL JOIN (SELECT user_id, min(created_at) AS first_order_at FROM v_st_orders_@
               GROUP BY user_id) o ON s.user_id = o.user_id""",
)
_NAMED = ", ".join(f"coalesce({a}, '{m}') AS {a}" for a, m in NOT_GIVEN.items())
_ATTRIBUTES = ", ".join(NOT_GIVEN)
view(
    "v_dim_marketing_@",
    f"""SELECT DISTINCT {_NAMED},
        {' AND '.join(f'{a} IS NULL' for a in NOT_GIVEN)} AS is_direct
    FROM v_st_website_sessions_@""",
)
view(
    "v_dim_device_@",
    """SELECT DISTINCT device_type,
        CASE WHEN device_type = 'desktop' THEN 'ordinateur' ELSE device_type END AS device_label,
        device_type = 'mobile' AS is_mobile
    FROM v_st_website_sessions_@""",
)

# --- facts ---------------------------------------------------------------------------------

view(
    "v_path_@",
    """SELECT website_session_id, count(*) AS pageview_count,
        (array_agg(pageview_url ORDER BY created_at, website_pageview_id))[1] AS landing_page_url,
        (array_agg(pageview_url ORDER BY created_at DESC, website_pageview_id DESC))[1]
            AS exit_page_url,
        (epoch_us(max(created_at)) - epoch_us(min(created_at)) + 500000) // 1000000
            AS duration_seconds
    FROM v_st_website_pageviews_@ GROUP BY website_session_id""",
)
view(
    "v_steps_@",
    "SELECT website_session_id, "
    + ", ".join(
        f"bool_or(pageview_url IN ({', '.join(map(repr, pages.split()))})) AS viewed_{step}"
        for step, pages in STEP_PAGES.items()
    )
    + " FROM v_st_website_pageviews_@ GROUP BY website_session_id",
)
view(
    "v_session_orders_@",
    """SELECT website_session_id, count(*) AS order_count,
        CAST(sum(items_purchased) AS BIGINT) AS items_purchased,
        CAST(sum(price_c) AS BIGINT) AS revenue_c,
        CAST(sum(price_c - cogs_c) AS BIGINT) AS gross_profit_c
    FROM v_st_orders_@ GROUP BY website_session_id""",
)
view(
    "v_item_refunds_@",
    """SELECT order_item_id, CAST(sum(refund_c) AS BIGINT) AS refund_amount_c,
        max(created_at) AS last_refund_at
    FROM v_st_order_item_refunds_@ GROUP BY order_item_id""",
)
view(
    "v_fact_sales_@",
    """SELECT i.order_item_id, i.order_id, o.website_session_id, o.user_id, i.product_id,
        CAST(strftime(i.created_at, '%Y%m%d') AS BIGINT) AS date_key,
        CAST(strftime(r.last_refund_at, '%Y%m%d') AS BIGINT) AS refund_date_key,
        i.is_primary_item = 1 AS is_primary_item, r.order_item_id IS NOT NULL AS is_refunded,
        i.price_c, i.cogs_c, i.price_c - i.cogs_c AS gross_profit_c,
        coalesce(r.refund_amount_c, 0) AS refund_amount_c
    FROM v_st_order_items_@ i JOIN v_st_orders_@ o ON i.order_id = o.order_id
    JOIN v_st_products_@ p ON i.product_id = p.product_id
    LEFT JOIN v_item_refunds_@ r ON i.order_item_id = r.order_item_id""",
)
view(
    "v_fact_sessions_@",
    f"""SELECT s.website_session_id, s.user_id, s.device_type, {_NAMED},
        CAST(strftime(s.created_at, '%Y%m%d') AS BIGINT) AS date_key,
        s.created_at AS session_started_at, landing_page_url, exit_page_url, pageview_count,
        duration_seconds, is_repeat_session = 1 AS is_repeat_session,
        pageview_count = 1 AS is_bounce, o.website_session_id IS NOT NULL AS is_converted,
        {zero('order_count', 'items_purchased', 'revenue_c', 'gross_profit_c')}
    FROM v_st_website_sessions_@ s
    JOIN v_path_@ p ON s.website_session_id = p.website_session_id
    LEFT JOIN v_session_orders_@ o ON s.website_session_id = o.website_session_id""",
)

# --- marts ---------------------------------------------------------------------------------

_TRAFFIC = """count(*) AS sessions, count(DISTINCT user_id) AS unique_visitors,
    count(*) FILTER (is_repeat_session) AS repeat_sessions,
    CAST(sum(pageview_count) AS BIGINT) AS pageviews, count(*) FILTER (is_bounce) AS bounces,
    count(*) FILTER (is_converted) AS converted_sessions"""


def total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {column}"


_TURNOVER = f"""count(DISTINCT order_id) AS orders, count(*) AS items_purchased,
    {total('price_c')}, {total('gross_profit_c')}"""
_ACTIVITY = zero(
    "sessions", "unique_visitors", "repeat_sessions", "pageviews", "bounces",
    "converted_sessions", "orders", "items_purchased", "gross_profit_c", "refund_amount_c",
)
_ACTIVITY += ", coalesce(price_c, 0) AS gross_revenue_c"

view(
    "v_daily_@",
    f"""SELECT d.date_key, d.date, {_ACTIVITY} FROM v_dim_date_@ d
    LEFT JOIN (SELECT date_key, {_TRAFFIC} FROM v_fact_sessions_@ GROUP BY ALL) s
        ON d.date_key = s.date_key
    LEFT JOIN (SELECT date_key, {_TURNOVER} FROM v_fact_sales_@ GROUP BY ALL) v
        ON d.date_key = v.date_key
    LEFT JOIN (SELECT refund_date_key, {total('refund_amount_c')} FROM v_fact_sales_@
               GROUP BY ALL) r ON d.date_key = r.refund_date_key""",
)
view(
    "v_marketing_@",
    f"""SELECT {_ATTRIBUTES}, is_direct, {_ACTIVITY} FROM v_dim_marketing_@
    LEFT JOIN (SELECT {_ATTRIBUTES}, {_TRAFFIC} FROM v_fact_sessions_@ GROUP BY ALL)
        USING ({_ATTRIBUTES})
    LEFT JOIN (SELECT {_ATTRIBUTES}, {_TURNOVER}, {total('refund_amount_c')}
               FROM (SELECT v.order_id, v.price_c, v.gross_profit_c, v.refund_amount_c, s.*
                     EXCLUDE (gross_profit_c)
                     FROM v_fact_sales_@ v JOIN v_fact_sessions_@ s USING (website_session_id))
               GROUP BY ALL) USING ({_ATTRIBUTES})""",
)
view(
    "v_product_@",
    f"""SELECT p.product_id, p.product_name, p.created_at AS product_created_at,
        {zero('orders', 'units_sold', 'primary_items', 'secondary_items', 'refunded_items',
              'cogs_c', 'gross_profit_c', 'refund_amount_c')},
        coalesce(price_c, 0) AS gross_revenue_c, first_refund, last_refund
    FROM v_st_products_@ p
    LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS orders, count(*) AS units_sold,
            count(*) FILTER (is_primary_item) AS primary_items,
            count(*) FILTER (NOT is_primary_item) AS secondary_items,
            count(*) FILTER (is_refunded) AS refunded_items,
            {total('price_c')}, {total('cogs_c')}, {total('gross_profit_c')},
            {total('refund_amount_c')},
            min(refund_date_key) AS first_refund, max(refund_date_key) AS last_refund
        FROM v_fact_sales_@ GROUP BY product_id) s ON p.product_id = s.product_id""",
)
view(
    "v_customer_@",
    f"""SELECT c.*, last_key,
        {zero('session_count', 'repeat_session_count', 'order_count', 'items_purchased',
              'gross_profit_c', 'refund_amount_c')},
        coalesce(price_c, 0) AS gross_revenue_c
    FROM v_dim_customer_@ c
    LEFT JOIN (SELECT user_id, count(*) AS session_count,
                      count(*) FILTER (is_repeat_session) AS repeat_session_count
               FROM v_fact_sessions_@ GROUP BY user_id) s ON c.user_id = s.user_id
    LEFT JOIN (SELECT user_id, count(DISTINCT order_id) AS order_count,
                      count(*) AS items_purchased, max(date_key) AS last_key, {total('price_c')},
                      {total('gross_profit_c')}, {total('refund_amount_c')}
               FROM v_fact_sales_@ GROUP BY user_id) v ON c.user_id = v.user_id""",
)
_STEPS = list(STEP_PAGES)
_VOLUMES = ["sessions", *[f"{s}_sessions" for s in _STEPS], "order_sessions"]
view(
    "v_funnel_@",
    f"""SELECT d.date_key, d.date, {zero(*_VOLUMES)} FROM v_dim_date_@ d
    LEFT JOIN (SELECT date_key, count(*) AS sessions,
            {', '.join(f'count(*) FILTER (viewed_{s}) AS {s}_sessions' for s in _STEPS)},
            count(*) FILTER (is_converted) AS order_sessions
        FROM v_fact_sessions_@ JOIN v_steps_@ USING (website_session_id)
        GROUP BY date_key) f ON d.date_key = f.date_key""",
)


def iso_day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def day_of_key(key: str, alias: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"{text}[1:4] || '-' || {text}[5:6] || '-' || {text}[7:8] AS {alias}"


_ACTIVITY_OUT = f"""sessions, unique_visitors, repeat_sessions, pageviews, bounces,
    converted_sessions, orders, items_purchased, {dollars('gross_revenue_c')},
    {dollars('gross_profit_c')}, {dollars('refund_amount_c')},
    {dollars('(gross_revenue_c - refund_amount_c)', 'net_revenue_usd')},
    {dollars('(gross_profit_c - refund_amount_c)', 'net_profit_usd')},
    {half_up('converted_sessions', 'sessions', 4)} AS conversion_rate,
    {half_up('bounces', 'sessions', 4)} AS bounce_rate,
    {per_unit('gross_revenue_c', 'orders')} AS average_order_value_usd"""
_RATES = ["product_view_rate", "product_click_rate", "cart_rate", "shipping_rate", "billing_rate",
          "checkout_rate"]

MARTS = {
    "daily_performance": f"SELECT date_key, {iso_day('date')}, {_ACTIVITY_OUT} FROM v_daily_@",
    "marketing_performance": f"""SELECT {_ATTRIBUTES}, is_direct, {_ACTIVITY_OUT},
        {per_unit('gross_revenue_c', 'sessions')} AS revenue_per_session_usd FROM v_marketing_@""",
    "product_performance": f"""SELECT CAST(product_id AS BIGINT) AS product_id, product_name,
        product_created_at, orders, units_sold, primary_items, secondary_items, refunded_items,
        {dollars('gross_revenue_c')}, {dollars('cogs_c')}, {dollars('gross_profit_c')},
        {dollars('refund_amount_c')},
        {dollars('(gross_revenue_c - refund_amount_c)', 'net_revenue_usd')},
        {dollars('(gross_profit_c - refund_amount_c)', 'net_profit_usd')},
        {per_unit('gross_revenue_c', 'units_sold')} AS average_selling_price_usd,
        {half_up('gross_profit_c', 'gross_revenue_c', 4)} AS gross_margin_rate,
        {half_up('refunded_items', 'units_sold', 4)} AS refund_rate,
        {half_up('secondary_items', 'units_sold', 4)} AS secondary_item_rate
        FROM v_product_@""",
    "customer_summary": f"""SELECT user_id, first_session_at, last_session_at, first_order_at,
        {day_of_key('last_key', 'last_order_date')},
        CASE order_count WHEN 0 THEN 'prospect' WHEN 1 THEN 'acheteur'
            ELSE 'acheteur récurrent' END AS customer_status,
        session_count, repeat_session_count, order_count, items_purchased,
        {dollars('gross_revenue_c')}, {dollars('refund_amount_c')},
        {dollars('(gross_revenue_c - refund_amount_c)', 'lifetime_revenue_usd')},
        {dollars('(gross_profit_c - refund_amount_c)', 'lifetime_profit_usd')},
        {per_unit('gross_revenue_c', 'order_count')} AS average_order_value_usd,
        datediff('day', CAST(first_session_at AS DATE), CAST(first_order_at AS DATE))
            AS days_to_first_order,
        order_count > 1 AS is_repeat_buyer FROM v_customer_@""",
    "funnel_performance": f"SELECT date_key, {iso_day('date')}, {', '.join(_VOLUMES)}, "
    + ", ".join(
        f"{half_up(part, whole, 4)} AS {rate}"
        for rate, part, whole in zip(_RATES, _VOLUMES[1:], _VOLUMES[:-1], strict=True)
    )
    + f", {half_up('order_sessions', 'sessions', 4)} AS conversion_rate FROM v_funnel_@",
    "refunds_performance": f"""SELECT CAST(product_id AS BIGINT) AS product_id, product_name, orders,
        units_sold AS items_sold, refunded_items AS items_refunded,
        {day_of_key('first_refund', 'first_refund_date')},
        {day_of_key('last_refund', 'last_refund_date')},
        {dollars('gross_revenue_c')}, {dollars('refund_amount_c')},
        {dollars('(gross_revenue_c - refund_amount_c)', 'net_revenue_usd')},
        {per_unit('refund_amount_c', 'refunded_items')} AS average_refund_amount_usd,
        {half_up('refunded_items', 'units_sold', 4)} AS refund_rate,
        {half_up('refund_amount_c', 'gross_revenue_c', 4)} AS refund_value_rate
        FROM v_product_@""",
}

# --- registered queries --------------------------------------------------------------------

SHORT = {
    "website_sessions": "sessions",
    "website_pageviews": "pageviews",
    "products": "products",
    "orders": "orders",
    "order_items": "order_items",
    "order_item_refunds": "refunds",
}
INTEGERS = {"is_repeat_session", "product_id", "primary_product_id", "items_purchased",
            "is_primary_item"}


def wide(name: str) -> str:
    """Columns of an entity, whole numbers as BIGINT."""
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in INTEGERS else c for c in COLUMNS[name])


_ORDERS = wide("orders")


def _catalog_sql() -> dict[str, str]:
    from merchlake import catalog

    moment, last_id = catalog.KEYSET_POSITION.last_created_at, catalog.KEYSET_POSITION.last_id
    after = "(created_at > TIMESTAMP '{0}' OR (created_at = TIMESTAMP '{0}' AND order_id > {1}))"
    sql = {
        "orders_sorted": f"SELECT {_ORDERS} FROM v_raw_orders_web",
        "orders_page": f"""SELECT {_ORDERS}, (SELECT count(*) FROM v_raw_orders_web) AS total
            FROM (SELECT * FROM v_raw_orders_web ORDER BY created_at, order_id
                  LIMIT {catalog.PAGE_LIMIT} OFFSET {catalog.PAGE_OFFSET})""",
        "orders_keyset_increment": f"SELECT {_ORDERS} FROM v_raw_orders_web WHERE "
        + after.format(moment, last_id),
        "order_lookup": f"SELECT {_ORDERS} FROM v_raw_orders_web "
        f"WHERE order_id = {catalog.LOOKUP_ORDER}",
        "orders_iso_dates": """SELECT order_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN ''
                    ELSE strftime(created_at, '.%f') END AS created_at
            FROM v_raw_orders_web""",
        "orders_checkpoint": """SELECT created_at AS last_created_at, order_id AS last_id
            FROM v_raw_orders_web ORDER BY created_at DESC, order_id DESC LIMIT 1""",
    }
    for name, short in SHORT.items():
        extra = {"orders": ", gross_profit", "order_items": ", gross_profit"}.get(name, "")
        sql[f"transform_{short}"] = (
            f"SELECT {wide(name)}{extra} FROM "
            f"(SELECT {NORMALISED[name]} FROM v_raw_{name}_dirty)"
        )
        sql[f"validate_{short}"] = f"SELECT {wide(name)}, is_valid FROM v_judged_{name}_dirty"
    sql["rule_is_unique"] = (
        f"SELECT order_id, created_at, price_usd, _rank = 1 AS is_first "
        f"FROM ({ranked('orders', 'dirty')})"
    )
    sql["rule_not_empty_string"] = (
        f"SELECT website_pageview_id, pageview_url, {_FILLED.format('pageview_url')} AS passed "
        f"FROM v_raw_website_pageviews_dirty"
    )
    for suffix, entity_set in {"": "dirty", "_clean": "web", "_volume": "volume"}.items():
        sql[f"validation_counts{suffix}"] = " UNION ALL ".join(
            f"SELECT '{name}' AS source_name, count(*) AS rows_extracted, "
            f"count(*) FILTER (is_valid) AS rows_loaded, "
            f"count(*) FILTER (NOT is_valid) AS rows_rejected FROM v_judged_{name}_{entity_set}"
            for name in COLUMNS
        )
    sql["quarantine_rows"] = (
        f"SELECT {_ORDERS}, '{catalog.RUN_ID}' AS _pipeline_run_id, "
        f"'{catalog.REJECTED_AT.isoformat()}' AS _rejected_at "
        f"FROM v_judged_orders_dirty WHERE NOT is_valid"
    )
    sql["order_items_semi"] = (
        f"SELECT {wide('order_items')} FROM v_raw_order_items_dirty i WHERE EXISTS "
        f"(SELECT 1 FROM v_raw_orders_dirty o WHERE o.order_id = i.order_id)"
    )
    sql["orders_anti_orphans"] = (
        f"SELECT {_ORDERS} FROM v_raw_orders_volume o WHERE NOT EXISTS "
        f"(SELECT 1 FROM v_raw_order_items_volume i WHERE o.order_id = i.order_id)"
    )
    sql["orders_upsert"] = f"""WITH taken AS (
            SELECT * REPLACE (price_usd + 1.0 AS price_usd) FROM v_raw_orders_web
            WHERE created_at >= TIMESTAMP '{catalog.UPSERT_SOURCE_FROM}')
        SELECT {_ORDERS} FROM taken UNION ALL
        SELECT {_ORDERS} FROM v_raw_orders_web
        WHERE created_at < TIMESTAMP '{catalog.UPSERT_TARGET_UNTIL}'
            AND order_id NOT IN (SELECT order_id FROM taken)"""
    numbered = "row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR))[1:3], user_id)"
    sql["surrogate_keys"] = (
        f"SELECT user_id, {numbered} AS customer_key FROM (SELECT DISTINCT o_custkey AS user_id FROM orders)"
    )
    sql["dim_upsert_preserves_keys"] = f"""WITH known AS (
            SELECT user_id, {numbered} AS customer_key FROM (
                SELECT DISTINCT o_custkey AS user_id FROM orders
                WHERE o_orderdate < TIMESTAMP '{catalog.KNOWN_CUSTOMERS_UNTIL}')),
        keyed AS (SELECT * FROM known UNION ALL
            SELECT user_id, (SELECT count(*) FROM known) + {numbered} FROM (
                SELECT DISTINCT o_custkey AS user_id FROM orders
                WHERE o_custkey NOT IN (SELECT user_id FROM known)))
        SELECT k.customer_key, k.user_id, min(o_orderdate) AS first_session_at,
            max(o_orderdate) AS last_session_at, min(o_orderdate) AS first_order_at,
            bool_or(o_orderkey % 2 = 1) AS has_repeat_session, true AS is_buyer
        FROM keyed k JOIN orders ON o_custkey = k.user_id GROUP BY k.customer_key, k.user_id"""

    def judged_orders(condition: str) -> str:
        order = ", ".join(f"{c} NULLS FIRST" for c in COLUMNS["orders"] if c != "order_id")
        return (
            f"SELECT {', '.join(COLUMNS['orders'])} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY order_id ORDER BY {order}) AS _rank FROM v_raw_orders_dirty "
            f"WHERE {condition}) WHERE _rank = 1 AND {' AND '.join(ROW_RULES['orders'])}"
        )

    until = f"created_at < TIMESTAMP '{catalog.FIRST_RUN_UNTIL}'"
    position = (
        "SELECT created_at AS last_at, order_id AS last_id FROM {0} "
        "ORDER BY created_at DESC, order_id DESC NULLS LAST LIMIT 1"
    )
    at_, id_ = "(SELECT last_at FROM p)", "(SELECT last_id FROM p)"
    inside = f"(created_at > {at_} OR (created_at = {at_} AND order_id > {id_}))"
    sql["incremental_orders_two_runs"] = f"""WITH first AS ({judged_orders(until)}),
        p AS ({position.format('first')}),
        second AS ({judged_orders(inside)})
        SELECT {_ORDERS} FROM second UNION ALL
        SELECT {_ORDERS} FROM first WHERE order_id IS NULL
            OR order_id NOT IN (SELECT order_id FROM second WHERE order_id IS NOT NULL)"""
    sql["order_store_runs"] = sql["orders_upsert"]
    sql["order_stream_state"] = sql["source_order_pages"] = f"SELECT {_ORDERS} FROM v_raw_orders_web"
    for entity, query in {
        "website_sessions": "source_sessions_csv",
        "website_pageviews": "source_pageviews_csv",
        "products": "source_products_json",
    }.items():
        sql[query] = f"SELECT {wide(entity)} FROM v_raw_{entity}_web"
    sql["pageview_stream_state"] = f"SELECT {wide('website_pageviews')} FROM v_st_website_pageviews_web"
    sql["sink_replace_append"] = f"{sql['source_products_json']} UNION ALL {sql['source_products_json']}"
    sql["late_orders"] = f"""WITH staged AS ({judged_orders('true')}),
        p AS ({position.format('staged')})
        SELECT {_ORDERS} FROM v_raw_orders_dirty o
        WHERE (created_at < {at_} OR (created_at = {at_} AND order_id <= {id_}))
            AND NOT EXISTS (SELECT 1 FROM staged s WHERE s.order_id = o.order_id)"""

    def positions(condition: str) -> str:
        return (
            "SELECT o_orderpriority AS source_name, max({moment: o_orderdate, id: o_orderkey}) AS top "
            f"FROM orders WHERE {condition} GROUP BY ALL"
        )

    sql["watermark_upsert"] = f"""WITH fresh AS ({positions("true")}),
        early AS ({positions(f"o_orderdate < TIMESTAMP '{catalog.KNOWN_CUSTOMERS_UNTIL}'")})
        SELECT 'ecommerce_analytics' AS pipeline_name, source_name,
            top.moment AS last_created_at, top.id AS last_id
        FROM (SELECT * FROM fresh UNION ALL SELECT * FROM early
              WHERE source_name NOT IN (SELECT source_name FROM fresh))"""

    sql["staging_date_range"] = (
        f"SELECT {iso_day('start_date')}, {iso_day('end_date')} FROM v_range_web"
    )
    sql["dim_date"] = "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM v_dim_date_web"
    sql["dim_product"] = f"SELECT {wide('products')} FROM v_st_products_web"
    sql["dim_customer"] = "SELECT * FROM v_dim_customer_web"
    sql["dim_customer_without_session"] = """SELECT coalesce(s.user_id, o.user_id) AS user_id,
            first_session_at, last_session_at, first_order_at, coalesce(again, false)
            AS has_repeat_session, o.user_id IS NOT NULL AS is_buyer
        FROM (SELECT user_id, min(created_at) AS first_session_at,
                     max(created_at) AS last_session_at, max(is_repeat_session) = 1 AS again
              FROM v_raw_website_sessions_web GROUP BY ALL) s
        FULL JOIN (SELECT o_custkey AS user_id, min(o_orderdate) AS first_order_at
                   FROM orders GROUP BY ALL) o ON s.user_id = o.user_id"""
    sql["dim_marketing"] = "SELECT * FROM v_dim_marketing_web"
    sql["dim_marketing_dirty"] = "SELECT * FROM v_dim_marketing_dirty"
    sql["dim_device"] = "SELECT * FROM v_dim_device_web"
    sql["pageviews_by_session"] = "SELECT * FROM v_path_web"
    sql["page_steps_by_session"] = "SELECT * FROM v_steps_web"
    sql["orders_by_session"] = (
        f"SELECT website_session_id, order_count, items_purchased, {dollars('revenue_c')}, "
        f"{dollars('gross_profit_c')} FROM v_session_orders_web"
    )
    sql["refunds_by_item"] = (
        f"SELECT order_item_id, {dollars('refund_amount_c')}, last_refund_at FROM v_item_refunds_web"
    )
    for suffix, entity_set in {"": "web", "_volume": "volume"}.items():
        star_sql = {name: body.replace("@", entity_set) for name, body in MARTS.items()}
        star_sql["fact_sales"] = f"""SELECT order_item_id, order_id, website_session_id, user_id,
            CAST(product_id AS BIGINT) AS product_id, date_key, refund_date_key, is_primary_item,
            is_refunded, {dollars('price_c')}, {dollars('cogs_c')}, {dollars('gross_profit_c')},
            {dollars('refund_amount_c')},
            {dollars('(price_c - refund_amount_c)', 'net_revenue_usd')},
            {dollars('(gross_profit_c - refund_amount_c)', 'net_profit_usd')}
            FROM v_fact_sales_{entity_set}"""
        star_sql["fact_sessions"] = f"""SELECT * EXCLUDE (revenue_c, gross_profit_c),
            {dollars('revenue_c')}, {dollars('gross_profit_c')} FROM v_fact_sessions_{entity_set}"""
        star_sql["reconciliation"] = _reconciliation(entity_set)
        sql.update({f"{name}{suffix}": body for name, body in star_sql.items()})
    sql["warehouse_volumes"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}_web"
        for name, source in {
            "dim_date": "v_dim_date",
            "dim_product": "v_st_products",
            "dim_customer": "v_dim_customer",
            "dim_marketing": "v_dim_marketing",
            "dim_device": "v_dim_device",
            "fact_sales": "v_fact_sales",
            "fact_sessions": "v_fact_sessions",
            "daily_performance": "v_daily",
            "marketing_performance": "v_marketing",
            "product_performance": "v_product",
            "customer_summary": "v_customer",
            "funnel_performance": "v_funnel",
            "refunds_performance": "v_product",
        }.items()
    )
    # Months of several years, more segments and channels: the same over the larger set's marts.
    for name, body in _analyses().items():
        sql[name], sql[f"{name}_volume"] = body, body.replace("_web", "_volume")
    sql.update(_quality())
    sql.update(_loads())
    sql.update(_two_runs(sql))
    return sql


def _reconciliation(entity_set: str) -> str:
    def measure(table: str, column: str | None) -> str:
        value = "count(*)" if column is None else f"coalesce(sum({column}), 0)"
        scale = " / 100.0" if column and column.endswith("_c") else ""
        return f"(SELECT CAST({value} AS DOUBLE){scale} FROM {table}_{entity_set})"

    pairs = [
        ("volume_sessions", "v_st_website_sessions", None, "v_fact_sessions", None),
        ("volume_pages_vues", "v_st_website_pageviews", None, "v_fact_sessions", "pageview_count"),
        ("volume_commandes", "v_st_orders", None, "v_fact_sessions", "order_count"),
        ("volume_articles", "v_st_order_items", None, "v_fact_sales", None),
        ("ventes_articles", "v_st_order_items", "price_c", "v_fact_sales", "price_c"),
        ("ventes_sessions", "v_st_orders", "price_c", "v_fact_sessions", "revenue_c"),
        ("remboursements", "v_st_order_item_refunds", "refund_c", "v_fact_sales",
         "refund_amount_c"),
    ]
    profit = "(SELECT CAST(coalesce(sum({0}), 0) AS DOUBLE) / 100.0 FROM {1}_" + entity_set + ")"
    rows = [(name, measure(a, b), measure(c, d)) for name, a, b, c, d in pairs]
    for name, staged, fact in (
        ("marge_articles", "v_st_order_items", "v_fact_sales"),
        ("marge_sessions", "v_st_orders", "v_fact_sessions"),
    ):
        rows.append(
            (name, profit.format("price_c - cogs_c", staged), profit.format("gross_profit_c", fact))
        )
    values = " UNION ALL ".join(
        f"SELECT '{name}' AS name, {expected} AS expected, {actual} AS actual"
        for name, expected, actual in rows
    )
    return f"SELECT *, expected = actual AS passed FROM ({values})"


def _analyses() -> dict[str, str]:
    money = ["gross_revenue_c", "refund_amount_c"]
    net = [
        dollars("sum(gross_revenue_c - refund_amount_c)", "net_revenue_usd"),
        dollars("sum(gross_profit_c - refund_amount_c)", "net_profit_usd"),
    ]
    counts = [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("sessions", "orders")]
    monthly = f"""SELECT strftime(date, '%Y-%m') AS month, {', '.join(counts)},
        {', '.join(dollars(f'sum({c})', c.removesuffix('_c') + '_usd') for c in money)},
        {', '.join(net)}, {quotient('sum(orders)', 'sum(sessions)')} AS conversion_rate,
        {quotient('(CAST(sum(gross_revenue_c) AS DOUBLE) / 100.0)', 'sum(orders)')}
            AS average_order_value_usd
        FROM v_daily_web GROUP BY ALL"""
    lifetime = "(CAST(sum(gross_revenue_c - refund_amount_c) AS DOUBLE) / 100.0)"
    segments = f"""SELECT CASE order_count WHEN 0 THEN 'prospect' WHEN 1 THEN 'acheteur'
            ELSE 'acheteur récurrent' END AS customer_status,
        count(user_id) AS customers, CAST(sum(order_count) AS BIGINT) AS orders,
        {lifetime} AS lifetime_revenue_usd,
        {dollars('sum(gross_profit_c - refund_amount_c)', 'lifetime_profit_usd')},
        {quotient(lifetime, 'count(user_id)')} AS revenue_per_customer_usd
        FROM v_customer_web GROUP BY customer_status"""
    channels = f"""SELECT utm_source, utm_campaign, is_direct, {', '.join(counts)},
        {', '.join(net)}, {quotient('sum(orders)', 'sum(sessions)')} AS conversion_rate,
        {quotient(lifetime, 'sum(sessions)')} AS revenue_per_session_usd
        FROM v_marketing_web GROUP BY utm_source, utm_campaign, is_direct"""
    sums = "SELECT " + ", ".join(f"CAST(sum({v}) AS BIGINT) AS {v}" for v in _VOLUMES)
    stages = []
    for number, (stage, column) in enumerate(STAGES, start=1):
        previous = STAGES[max(number - 2, 0)][1]
        before = (
            "1.0"
            if number == 1
            else f"CASE WHEN {previous} = 0 THEN 1.0 ELSE CAST({column} AS DOUBLE) / {previous} END"
        )
        stages.append(
            f"SELECT {number} AS stage_number, '{stage}' AS stage, {column} AS sessions, "
            f"{before} AS rate_from_previous, {quotient(column, 'sessions')} AS rate_from_start "
            f"FROM ({sums} FROM v_funnel_web)"
        )
    funnel = " UNION ALL ".join(
        s.replace(" AS stage_number", "::BIGINT AS stage_number") for s in stages
    )
    products = f"""SELECT product_id, product_name, orders, units_sold, net_revenue_usd,
        net_profit_usd, gross_margin_rate, refund_rate
        FROM ({MARTS['product_performance'].replace('@', 'web')})"""
    top_month = f"SELECT * FROM ({monthly}) ORDER BY net_revenue_usd DESC, month LIMIT 1"
    top_channel = f"""SELECT * FROM ({channels}) ORDER BY net_revenue_usd DESC, sessions DESC,
        utm_source, utm_campaign, is_direct LIMIT 1"""
    top_product = f"SELECT * FROM ({products}) ORDER BY net_revenue_usd DESC, product_id LIMIT 1"
    return {
        "analysis_sales_monthly": monthly,
        "analysis_customer_segments": segments,
        "analysis_marketing_channels": channels,
        "analysis_funnel_overall": funnel,
        "analysis_products": products,
        "channel_labels": f"""SELECT coalesce(utm_source, 'direct') || ' / '
            || coalesce(utm_campaign, 'sans campagne')
            || CASE WHEN is_direct THEN ' / direct' ELSE '' END AS label, net_revenue_usd
            FROM ({channels})""",
        "top_month": top_month,
        "top_channel": top_channel,
        "top_product": top_product,
        "headline_metrics": f"""
            SELECT 'best_month' AS metric, month AS label, net_revenue_usd AS amount
            FROM ({top_month}) UNION ALL
            SELECT 'repeat_buyers', CAST(max(customers) AS VARCHAR), max(revenue_per_customer_usd)
            FROM ({segments}) WHERE customer_status = 'acheteur récurrent' UNION ALL
            SELECT 'top_channel', utm_source || ' / ' || utm_campaign, net_revenue_usd
            FROM ({top_channel}) UNION ALL
            SELECT 'funnel_conversion', stage, rate_from_start FROM ({funnel})
            WHERE stage = 'Commande' UNION ALL
            SELECT 'top_product', product_name, net_profit_usd FROM ({top_product})""",
    }


def _quality() -> dict[str, str]:
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count "
        f"FROM v_raw_website_pageviews_dirty"
        for c in COLUMNS["website_pageviews"]
    )
    references = [
        ("order_items_orders", "order_items", "order_id", "orders", "order_id"),
        ("order_items_products", "order_items", "product_id", "products", "product_id"),
        ("refunds_items", "order_item_refunds", "order_item_id", "order_items", "order_item_id"),
        ("orders_sessions", "orders", "website_session_id", "website_sessions",
         "website_session_id"),
    ]
    orphans = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS orphan_count FROM v_raw_{table}_dirty t "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_raw_{other}_dirty r "
        f"WHERE r.{other_column} = t.{column})"
        for name, table, column, other, other_column in references
    )
    run_id = "user_id || '-' || strftime(ts, '%Y-%m-%d')"
    runs = f"""SELECT {run_id} AS run_id, 'ecommerce_analytics' AS pipeline_name,
        min(ts) AS started_at, max(ts) AS finished_at,
        CASE WHEN bool_or(event_type = 'error') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        count(*) AS rows_extracted, count(*) FILTER (event_type <> 'error') AS rows_loaded,
        count(*) FILTER (event_type = 'error') AS rows_rejected,
        CASE WHEN bool_or(event_type = 'error') THEN 'a step failed' END AS error_message
        FROM events GROUP BY 1"""
    return {
        "dq_unique": """SELECT order_item_id, count(*) AS row_count FROM v_raw_order_items_volume
            GROUP BY ALL HAVING count(*) > 1""",
        "dq_not_null": nulls,
        "dq_foreign_key": orphans,
        "run_states": runs,
        "latest_run": f"SELECT * FROM ({runs}) ORDER BY started_at DESC, run_id DESC LIMIT 1",
        "run_steps": f"""SELECT {run_id} AS run_id, event_id AS step_run_id,
            event_type AS step_name, ts AS started_at, ts + INTERVAL 1 SECOND AS finished_at,
            CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
            value AS duration_seconds,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_processed,
            CASE WHEN event_type = 'error' THEN 'step failed' END AS error_message
            FROM events""",
    }


# Fixed value: the first of two runs knows what was created before.
_UNTIL = "TIMESTAMP '1997-03-10 00:00:00'"


def _two_runs(sql: dict[str, str]) -> dict[str, str]:
    """Two runs end where one would; both runs' rows come from the whole tables."""
    stars = [
        "fact_sales", "fact_sessions", "daily_performance", "marketing_performance", "product_performance",
        "customer_summary", "funnel_performance", "refunds_performance",
    ]
    found = {f"{name}_two_builds": sql[f"{name}_volume"] for name in stars}
    known = f"""SELECT 'fact_sales' AS table_name, f.order_item_id AS id, f.date_key // 100 AS month,
            i.created_at < {_UNTIL} AND o.created_at < {_UNTIL} AS known
        FROM v_fact_sales_volume f JOIN v_st_order_items_volume i USING (order_item_id)
        JOIN v_st_orders_volume o ON o.order_id = i.order_id
        UNION ALL SELECT 'fact_sessions', f.website_session_id, f.date_key // 100,
            s.created_at < {_UNTIL} AND EXISTS (SELECT 1 FROM v_st_website_pageviews_volume p
                WHERE p.website_session_id = f.website_session_id AND p.created_at < {_UNTIL})
        FROM v_fact_sessions_volume f JOIN v_st_website_sessions_volume s USING (website_session_id)"""
    found["fact_keys_two_builds"] = f"""SELECT table_name, count(*) AS n_rows, count(*) AS n_keys, 1::BIGINT AS least,
        count(*) AS greatest, count(*) FILTER (known) AS n_kept FROM ({known}) GROUP BY table_name"""
    # A month is written again if a row is new in it or some input of a row has changed since.
    changed = f"""SELECT 'fact_sales' AS table_name, order_item_id AS id FROM v_st_order_items_volume
            WHERE order_id IN (SELECT order_id FROM v_st_order_items_volume WHERE created_at >= {_UNTIL}
                UNION SELECT order_id FROM v_st_orders_volume WHERE created_at >= {_UNTIL}
                UNION SELECT i.order_id FROM v_st_order_items_volume i JOIN v_st_order_item_refunds_volume r
                    USING (order_item_id) WHERE r.created_at >= {_UNTIL})
        UNION ALL SELECT 'fact_sessions', website_session_id FROM v_st_website_sessions_volume
            WHERE created_at >= {_UNTIL} OR website_session_id IN (
                SELECT website_session_id FROM v_st_website_pageviews_volume WHERE created_at >= {_UNTIL}
                UNION SELECT website_session_id FROM v_st_orders_volume WHERE created_at >= {_UNTIL})"""
    dated = """SELECT 'fact_sales' AS table_name, order_item_id AS id,
            CAST(strftime(created_at, '%Y%m') AS BIGINT) AS month FROM v_st_order_items_volume
        UNION ALL SELECT 'fact_sessions', website_session_id, CAST(strftime(created_at, '%Y%m') AS BIGINT)
            FROM v_st_website_sessions_volume"""
    found["fact_months_two_builds"] = f"""WITH known AS ({known}), touched AS (
            SELECT DISTINCT table_name, month FROM ({changed}) JOIN ({dated}) USING (table_name, id))
        SELECT k.table_name, k.month::BIGINT AS month, count(*) AS n_rows,
            (k.table_name, k.month) IN (SELECT (table_name, month) FROM touched) AS second_run
        FROM known k GROUP BY k.table_name, k.month"""
    return found


def _loads() -> dict[str, str]:
    """Chunked loads, mergeable counts and digests, constraints."""
    counts = " UNION ALL ".join(
        f"SELECT '{measure}' AS measure, '{grain}' AS grain, CAST({expression} AS VARCHAR) AS member, "
        f"count(DISTINCT {counted}) AS n FROM {table} GROUP BY ALL"
        for measure, grain, expression, counted, table in (
            ("visitors", "date_key", "date_key", "user_id", "v_fact_sessions_web"),
            ("visitors", "month", "date_key // 100", "user_id", "v_fact_sessions_web"),
            ("visitors", "channel", f"concat_ws('/', {_ATTRIBUTES})", "user_id", "v_fact_sessions_web"),
            ("orders", "date_key", "date_key", "order_id", "v_fact_sales_web"),
            ("orders", "month", "date_key // 100", "order_id", "v_fact_sales_web"),
        )
    )
    broken = " UNION ALL ".join(
        f"SELECT '{name}' AS broken, count(*) AS n_rows FROM v_raw_order_items_dirty WHERE {condition}"
        for name, condition in (
            ("NULL in order_item_id", "order_item_id IS NULL"),
            ("NULL in product_id", "product_id IS NULL"),
            ("NULL in cogs_usd", "cogs_usd IS NULL"),
            ("unknown order_id", "order_id IS NOT NULL AND order_id NOT IN "
             "(SELECT order_id FROM v_raw_orders_dirty WHERE order_id IS NOT NULL)"),
            ("unknown product_id", "product_id IS NOT NULL AND product_id NOT IN "
             "(SELECT product_id FROM v_raw_products_dirty WHERE product_id IS NOT NULL)"),
        )
    )
    return {
        "distinct_counts_by_bitmap": counts,
        "constraints_at_write": broken,
        "session_visits_in_parts": "SELECT * FROM v_path_web JOIN v_steps_web USING (website_session_id)",
        "pageview_chunks": """WITH placed AS (
                SELECT website_pageview_id, website_session_id, pageview_url, 2 * website_pageview_id AS place
                FROM v_raw_website_pageviews_web
                UNION ALL SELECT website_pageview_id, website_session_id, '/again', 2 * website_pageview_id + 301
                FROM v_raw_website_pageviews_web WHERE website_pageview_id % 3 = 0),
            numbered AS (SELECT *, place // 4000 AS number,
                row_number() OVER (PARTITION BY place // 4000 ORDER BY place) AS row FROM placed),
            first AS (SELECT *, (row - 1) // 500 AS chunk, row_number() OVER (
                PARTITION BY number, (row - 1) // 500, website_pageview_id ORDER BY row) AS k FROM numbered)
            SELECT website_pageview_id, website_session_id, pageview_url, chunk, row FROM first WHERE k = 1""",
    }


def all_sql() -> dict[str, str]:
    return {name: _merged(sql) for name, sql in _catalog_sql().items()}


def _merged(sql: str) -> str:
    """Views first; a query's own WITH continues the list."""
    composed = compose(sql)
    return re.sub(r"\)\nWITH ", "),\n", composed, count=1)
