"""DuckDB oracle SQL for every registered query.

Each string is self-contained: a WITH prefix re-derives the retail source tables, silver and the star
from the pre-registered test tables with the same fixed rules as ``goldleaf.sources.retail_views`` and
the gold build, written independently in SQL. Every computed column is aliased and cast to the type the
Spark side returns.
"""

from __future__ import annotations

# --- derived source tables (same fixed rules as goldleaf.sources.retail_views) ---------------------
_SOURCES = {
    "branch_s": "SELECT CAST(n_nationkey AS VARCHAR) AS bran_id, n_name AS bran_nm FROM nation",
    "member_s": "SELECT CAST(c_custkey AS VARCHAR) AS member_id, c_name AS member_nm FROM customer "
                "WHERE c_mktsegment <> 'FURNITURE'",
    "ptype_s": "SELECT DISTINCT concat(p_brand, '/', p_type) AS pizza_type_id, p_brand AS pizza_nm, "
               "p_type AS pizza_categ FROM part",
    "pizza_s": "SELECT CAST(p_partkey AS VARCHAR) AS pizza_id, concat(p_brand, '/', p_type) AS pizza_type_id, "
               "CAST(p_size AS VARCHAR) AS size, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part",
    "word_s": "SELECT concat(p_brand, '/', p_type) AS pizza_type_id, split_part(p_name, ' ', 1) AS w "
              "FROM part WHERE p_type <> 'STANDARD' UNION "
              "SELECT concat(p_brand, '/', p_type) AS pizza_type_id, split_part(p_name, ' ', 2) AS w "
              "FROM part WHERE p_type <> 'STANDARD'",
    "bridge_s": "SELECT pizza_type_id, w AS pizza_topping_id FROM word_s",
    "topping_s": "SELECT DISTINCT w AS pizza_topping_id, upper(w) AS pizza_topping_nm FROM word_s WHERE w <> 'rod'",
    "orders_s": "SELECT o_orderkey AS order_id, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS date, "
                "lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') "
                "|| ':00' AS time, "
                "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS member_id, "
                "CASE WHEN o_orderkey % 30 = 29 THEN NULL ELSE CAST(o_orderkey % 30 AS VARCHAR) END AS bran_id "
                "FROM orders",
    "od_s": "SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
            "substr(CAST(l_shipdate AS VARCHAR), 1, 10)) AS order_detail_id, l_orderkey AS order_id, "
            "CAST(l_partkey AS VARCHAR) AS pizza_id, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem",
}

# --- silver and gold, as the SQL version of the warehouse would build them --------------------------
_SILVER_SELECT = (
    "SELECT l.order_id, l.order_detail_id, l.pizza_id, i.pizza_type_id, c.member_id, c.member_nm, c.date, c.time, "
    "l.quantity, i.size, i.price, i.pizza_nm, i.pizza_categ, c.bran_id, c.bran_nm, t.pizza_topping_id, t.pizza_topping_nm "
    "FROM (SELECT x.*, m.member_nm, b.bran_nm FROM orders_s x LEFT JOIN member_s m USING (member_id) "
    "LEFT JOIN branch_s b USING (bran_id)) c JOIN od_s l ON l.order_id = c.order_id "
    "JOIN (SELECT x.*, k.pizza_nm, k.pizza_categ FROM pizza_s x JOIN ptype_s k USING (pizza_type_id)) i "
    "ON i.pizza_id = l.pizza_id "
    "LEFT JOIN (SELECT x.*, n.pizza_topping_nm FROM bridge_s x LEFT JOIN topping_s n USING (pizza_topping_id)) t "
    "ON t.pizza_type_id = i.pizza_type_id"
)
_FACT_COLS = (
    "order_detail_id, order_id, TRY_CAST(date AS DATE) AS date, COALESCE(member_id, '0') AS member_id, pizza_id, "
    "pizza_type_id, pizza_topping_id, time, size, quantity, price AS unit_price, COALESCE(bran_id, '0') AS bran_id, "
    "CAST(price * quantity AS DECIMAL(18,2)) AS total_price"
)
_GOLD = {
    "silver": _SILVER_SELECT,
    "fact": f"SELECT {_FACT_COLS} FROM silver",
    "dim_date": (
        "SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
        "CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS weekday_num, "
        "strftime(date, '%a') AS weekday, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend "
        "FROM (SELECT DISTINCT TRY_CAST(date AS DATE) AS date FROM silver) d"
    ),
    "dim_pizza": "SELECT DISTINCT pizza_id, pizza_type_id, size, price FROM silver",
    "dim_member": "SELECT DISTINCT member_id, member_nm FROM silver UNION SELECT '0', '비회원(Guest)'",
    "dim_ptype": "SELECT DISTINCT pizza_type_id, pizza_nm, pizza_categ FROM silver",
    "dim_branch": "SELECT DISTINCT bran_id, bran_nm FROM silver UNION SELECT '0', '알 수 없는 지점'",
    "dim_topping": "SELECT DISTINCT pizza_topping_id, pizza_topping_nm FROM silver",
    "bridge_dim": "SELECT DISTINCT pizza_type_id, pizza_topping_id FROM silver",
    # one row per order line (line-level columns are the same on every topping row of a line)
    "fact_line": "SELECT DISTINCT order_detail_id, order_id, date, member_id, pizza_id, pizza_type_id, time, size, "
                 "quantity, unit_price, bran_id, total_price FROM fact",
}


def with_views(*names: str) -> str:
    """WITH prefix defining every source view plus the named silver/gold views (in dependency order)."""
    parts = [f"{k} AS ({v})" for k, v in _SOURCES.items()]
    order = list(_GOLD)
    wanted = set(names)
    if wanted - {"silver"}:
        wanted |= {"silver"}
    if wanted & {"fact_line"}:
        wanted |= {"fact"}
    parts += [f"{k} AS ({_GOLD[k]})" for k in order if k in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


def _rev(expr: str = "total_price") -> str:
    return f"CAST(SUM({expr}) AS DECIMAL(38,2))"


def bi_sql() -> dict[str, str]:
    out = {}
    for suffix, fact in (("", "fact"), ("_line_grain", "fact_line")):
        pre = with_views(fact, "dim_date", "dim_ptype")
        out[f"bi_monthly_revenue{suffix}"] = pre + (
            f"SELECT CAST(dd.year AS VARCHAR) || CAST(dd.month AS VARCHAR) AS month_label, dd.year, dd.month, "
            f"{_rev('f.total_price')} AS revenue FROM {fact} f JOIN dim_date dd ON f.date = dd.date "
            f"GROUP BY dd.year, dd.month ORDER BY dd.year, dd.month")
        out[f"bi_category_revenue{suffix}"] = pre + (
            f"SELECT dpt.pizza_categ AS category, {_rev('f.total_price')} AS revenue FROM {fact} f "
            f"JOIN dim_ptype dpt ON f.pizza_type_id = dpt.pizza_type_id GROUP BY dpt.pizza_categ")
        out[f"bi_hourly_revenue{suffix}"] = pre + (
            f"SELECT CAST(hour(strptime(f.time, '%H:%M:%S')) AS INTEGER) AS hour, f.date, dd.weekday, "
            f"{_rev('f.total_price')} AS revenue FROM {fact} f JOIN dim_date dd ON f.date = dd.date GROUP BY 1, 2, 3")
        out[f"bi_type_revenue{suffix}"] = pre + (
            f"SELECT f.pizza_type_id, {_rev('f.total_price')} AS revenue FROM {fact} f GROUP BY f.pizza_type_id")
    # all five marts as one table; only the hourly counts fill ``orders``
    columns = {"monthly": "year, month", "category": "category", "orders_by_hour": "hour", "hourly": "hour, date, weekday",
               "type": "pizza_type_id"}
    kinds = {"year": "INTEGER", "month": "INTEGER", "category": "VARCHAR", "hour": "INTEGER", "date": "DATE",
             "weekday": "VARCHAR", "pizza_type_id": "VARCHAR"}
    hour = "CAST(hour(strptime(f.time, '%H:%M:%S')) AS INTEGER)"
    value = {"year": "CAST(year(f.date) AS INTEGER)", "month": "CAST(month(f.date) AS INTEGER)", "category": "pt.pizza_categ",
             "hour": hour, "date": "f.date", "weekday": "strftime(f.date, '%a')", "pizza_type_id": "f.pizza_type_id"}
    for suffix, fact in (("", "fact"), ("_line_grain", "fact_line")):
        parts = []
        for mart, cols in columns.items():
            own = cols.split(", ")
            shown = ", ".join(f"{value[c]} AS {c}" if c in own else f"CAST(NULL AS {k}) AS {c}" for c, k in kinds.items())
            figures = (f"CAST(NULL AS DECIMAL(38,2)) AS revenue, CAST(COUNT(f.order_id) AS BIGINT) AS orders" if mart == "orders_by_hour"
                       else f"{_rev('f.total_price')} AS revenue, CAST(NULL AS BIGINT) AS orders")
            where = "" if mart in ("category", "type") else " WHERE f.date IS NOT NULL"
            parts.append(f"SELECT '{mart}' AS mart, {shown}, {figures} FROM {fact} f JOIN dim_ptype pt "
                         f"ON f.pizza_type_id = pt.pizza_type_id{where} GROUP BY {', '.join(value[c] for c in own)}")
        out[f"bi_all_marts{suffix}"] = with_views(fact, "dim_ptype") + _union(parts)
    pre = with_views("fact", "dim_date")
    out["bi_orders_by_hour"] = pre + (
        "SELECT CAST(hour(strptime(f.time, '%H:%M:%S')) AS INTEGER) AS hour, CAST(COUNT(f.order_id) AS BIGINT) AS orders "
        "FROM fact f JOIN dim_date dd ON f.date = dd.date GROUP BY 1")
    out["bi_orders_by_hour_line_grain"] = pre + (
        "SELECT CAST(hour(strptime(f.time, '%H:%M:%S')) AS INTEGER) AS hour, "
        "CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS orders FROM fact f JOIN dim_date dd ON f.date = dd.date GROUP BY 1")
    out["bi_orders_by_hour_merged"] = out["bi_orders_by_hour_line_grain"]
    return out


def star_sql() -> dict[str, str]:
    return {
        "silver_orders": with_views("silver") + "SELECT * FROM silver",
        "fact_order": with_views("fact") + "SELECT * FROM fact",
        "fact_order_distinct": with_views("fact") + "SELECT DISTINCT * FROM fact",
        "dim_date": with_views("dim_date") + "SELECT * FROM dim_date",
        "dim_item": with_views("dim_pizza") + "SELECT * FROM dim_pizza",
        "dim_member": with_views("dim_member") + "SELECT * FROM dim_member",
        "dim_item_type": with_views("dim_ptype") + "SELECT * FROM dim_ptype",
        "dim_branch": with_views("dim_branch") + "SELECT * FROM dim_branch",
        "dim_topping": with_views("dim_topping") + "SELECT * FROM dim_topping",
        "bridge_type_topping": with_views("bridge_dim") + "SELECT * FROM bridge_dim",
    }


# --- data-quality checks: rows of (check, subject, observed, expected, severity, passed) -------------

def _row(check: str, subject: str, observed: str, expected: str | None, severity: str, passed: str, frm: str) -> str:
    exp = "CAST(NULL AS BIGINT)" if expected is None else f"CAST({expected} AS BIGINT)"
    return (f"SELECT '{check}' AS \"check\", '{subject}' AS subject, CAST({observed} AS BIGINT) AS observed, "
            f"{exp} AS expected, {severity} AS severity, ({passed}) AS passed FROM {frm}")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"


def _bronze(view: str, table: str, keys: list[str], change_col: str | None) -> list[str]:
    parts = [_row("row_count", table, "count(*)", None, "'skip'", "count(*) > 0", view)]
    for k in keys:
        c = _cnt(f"{k} IS NULL")
        parts.append(_row("null_key", f"{table}.{k}", c, "0", "'reject'", f"{c} = 0", view))
    if change_col:
        c = _cnt(f"{change_col} < TIMESTAMP '1900-01-01' OR {change_col} > {AS_OF}")
        parts.append(_row("timestamp_range", f"{table}.{change_col}", c, "0", "'reject'", f"{c} = 0", view))
    if keys:
        g = f"(SELECT count(*) AS n FROM {view} GROUP BY {', '.join(keys)}) g"
        parts.append(_row("duplicate_keys", f"{table}({','.join(keys)})", _cnt("n > 1"), "0", "'reject'",
                          f"{_cnt('n > 1')} = 0", g))
    return parts


_SOURCE_VIEW = {"branch": "branch_s", "member": "member_s", "orders": "orders_s", "orderdetail": "od_s",
                "pizza": "pizza_s", "pizzatypes": "ptype_s", "pizzatypetopping": "bridge_s", "topping": "topping_s"}
_SOURCE_KEYS = {"branch": ["bran_id"], "member": ["member_id"], "orders": ["order_id"],
                "orderdetail": ["order_detail_id"], "pizza": ["pizza_id"], "pizzatypes": ["pizza_type_id"],
                "pizzatypetopping": ["pizza_type_id", "pizza_topping_id"], "topping": ["pizza_topping_id"]}


def _dup_pk_parts() -> list[str]:
    parts = []
    for name, view in _SOURCE_VIEW.items():
        keys = _SOURCE_KEYS[name]
        g = f"(SELECT count(*) AS n FROM {view} GROUP BY {', '.join(keys)}) g"
        parts.append(_row("duplicate_pk", f"{name}({','.join(keys)})", _cnt("n > 1"), "0", "'critical'",
                          f"{_cnt('n > 1')} = 0", g))
    return parts


def _null_fk_parts() -> list[str]:
    parts = []
    for view, name, cols in (("od_s", "orderdetail", ["order_id", "pizza_id"]),
                             ("orders_s", "orders", ["member_id", "bran_id"]),
                             ("pizza_s", "pizza", ["pizza_type_id"])):
        for c in cols:
            n = _cnt(f"{c} IS NULL")
            parts.append(_row("null_fk", f"{name}.{c}", n, "0", "'info'", f"{n} = 0", view))
    return parts


_CARD = ("(SELECT (SELECT count(*) FROM od_s) AS source_lines, "
         "(SELECT count(DISTINCT order_detail_id) FROM silver) AS silver_lines) c")
_REFS = {
    "missing_member": "count(*) FILTER (WHERE member_id IS NOT NULL AND member_nm IS NULL)",
    "missing_branch": "count(*) FILTER (WHERE bran_id IS NOT NULL AND bran_nm IS NULL)",
    "missing_topping_master": "count(*) FILTER (WHERE pizza_topping_id IS NOT NULL AND pizza_topping_nm IS NULL)",
    "types_without_topping": "count(DISTINCT pizza_type_id) FILTER (WHERE pizza_topping_id IS NULL)",
}


def _silver_parts() -> list[str]:
    d = "(source_lines - silver_lines)"
    parts = _dup_pk_parts() + _null_fk_parts()
    parts.append(_row("cardinality", "orderdetail->silver", d, "0",
                      f"CASE WHEN {d} < 0 THEN 'critical' WHEN {d} > 0 THEN 'warning' ELSE 'info' END", f"{d} = 0", _CARD))
    parts += [_row("missing_reference", k, v, "0", "'warning'", f"{v} = 0", "silver") for k, v in _REFS.items()]
    return parts


_GOLD_TABLES = {  # name -> (view, keys)
    "dim_pizza": ("dim_pizza", ["pizza_id"]), "dim_member": ("dim_member", ["member_id"]),
    "dim_pizza_type": ("dim_ptype", ["pizza_type_id"]), "dim_date": ("dim_date", ["date"]),
    "dim_branch": ("dim_branch", ["bran_id"]), "dim_pizza_topping": ("dim_topping", ["pizza_topping_id"]),
    "bridge_pizza_type_topping": ("bridge_dim", ["pizza_type_id", "pizza_topping_id"]),
    "fact_order": ("fact", ["order_detail_id", "pizza_topping_id"]),
}
_FACT_REQUIRED = ["date", "member_id", "pizza_id", "bran_id", "pizza_type_id", "pizza_topping_id"]
_FACT_REFS = {"pizza_id": ("dim_pizza", "dim_pizza"), "pizza_type_id": ("dim_pizza_type", "dim_ptype"),
              "date": ("dim_date", "dim_date"), "pizza_topping_id": ("dim_pizza_topping", "dim_topping"),
              "member_id": ("dim_member", "dim_member"), "bran_id": ("dim_branch", "dim_branch")}
_ALL_GOLD = ("fact", "dim_date", "dim_pizza", "dim_member", "dim_ptype", "dim_branch", "dim_topping", "bridge_dim")


def _parity() -> list[str]:
    frm = "(SELECT (SELECT count(*) FROM fact) AS f, (SELECT count(*) FROM silver) AS s) c"
    return [_row("row_parity", "fact_order", "f", "s", "'fail'", "f = s", frm)]


def _uniqueness() -> list[str]:
    parts = []
    for name, (view, keys) in _GOLD_TABLES.items():
        frm = f"(SELECT count(*) AS groups, COALESCE(sum(n), 0) AS rows FROM (SELECT count(*) AS n FROM {view} GROUP BY {', '.join(keys)}) g) u"
        parts.append(_row("key_uniqueness", f"{name}({','.join(keys)})", "groups", "rows", "'fail'", "groups = rows", frm))
    return parts


def _not_null() -> list[str]:
    return [_row("not_null", f"fact_order.{c}", _cnt(f"{c} IS NULL"), "0", "'fail'", f"{_cnt(f'{c} IS NULL')} = 0", "fact")
            for c in _FACT_REQUIRED]


def _line_total() -> list[str]:
    c = _cnt("total_price <> unit_price * quantity")
    return [_row("line_total", "fact_order", c, "0", "'fail'", f"{c} = 0", "fact")]


def _positive_quantity() -> list[str]:
    c = _cnt("quantity <= 0")
    return [_row("positive_quantity", "fact_order", c, "0", "'warning'", f"{c} = 0", "fact")]


def _ri() -> list[str]:
    parts = []
    for col, (dim_name, view) in _FACT_REFS.items():
        n = f"(SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {view} d WHERE d.{col} = f.{col}))"
        parts.append(_row("referential_integrity", f"fact_order.{col} -> {dim_name}", n, "0", "'fail'", f"{n} = 0",
                          "(SELECT 1) one"))
    return parts


def _digest_sum(cols: list[str]) -> str:
    """The sum of the rows' digests: 15 hex digits of the md5 of the values with their lengths, NULL as a dash."""
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"CAST(COALESCE(SUM(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)), 0) AS DECIMAL(38,0))"


_PARITY_COLUMNS = ["order_detail_id", "order_id", "pizza_id", "pizza_type_id", "pizza_topping_id", "time", "size", "quantity"]


def _content_parity() -> str:
    one = lambda v, a, b: f"(SELECT count(*) AS {a}, {_digest_sum(_PARITY_COLUMNS)} AS {b} FROM {v})"
    return _row("content", "silver -> fact_order", "f", "s", "'fail'", "f = s AND fc = sc",
                f"{one('fact', 'f', 'fc')} x, {one('silver', 's', 'sc')} y")


def _trend_sql() -> str:
    """The silver report of the orders before 1997 against that of all orders."""
    now = with_views("silver") + _union(_silver_parts())
    before = now.replace("AS bran_id FROM orders)", "AS bran_id FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')")
    off = lambda t: f"abs({t}.observed - coalesce({t}.expected, 0))"
    return (f"SELECT coalesce(n.\"check\", b.\"check\") AS \"check\", coalesce(n.subject, b.subject) AS subject, "
            f"coalesce(n.severity, b.severity) AS severity, b.observed AS observed_before, n.observed AS observed_now, "
            f"n.observed - b.observed AS change, CASE WHEN b.\"check\" IS NULL THEN 'new' WHEN n.\"check\" IS NULL THEN 'gone' "
            f"WHEN NOT b.passed AND n.passed THEN 'mended' WHEN b.passed AND NOT n.passed THEN 'broken' "
            f"WHEN {off('n')} < {off('b')} THEN 'better' WHEN {off('n')} > {off('b')} THEN 'worse' ELSE 'same' END AS trend "
            f"FROM ({before}) b FULL JOIN ({now}) n ON b.\"check\" = n.\"check\" AND b.subject = n.subject")


def quality_sql() -> dict[str, str]:
    src = with_views()
    gold = with_views(*_ALL_GOLD)
    silver = with_views("silver")
    return {
        "timestamp_range_check": _union([_bronze("events", "events", [], "ts")[1]]),
        "check_null_keys": src + _row("null_key", "orders.member_id", _cnt("member_id IS NULL"), "0", "'reject'",
                                      f"{_cnt('member_id IS NULL')} = 0", "orders_s"),
        "duplicate_keys": "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
        "duplicate_keys_composite": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                                    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "bronze_quality_report": src + _union(
            _bronze("orders_s", "orders", ["order_id"], None) + _bronze("od_s", "orderdetail", ["order_detail_id"], None)
            + _bronze("events", "events", ["event_id"], "ts")),
        "silver_duplicate_pks": src + _union(_dup_pk_parts()),
        "null_fk_profile": src + _union(_null_fk_parts()),
        "cardinality_check": silver + f"SELECT source_lines, silver_lines, source_lines - silver_lines AS dropped FROM {_CARD}",
        "missing_references": silver + "SELECT " + ", ".join(
            f"{v} AS {k}" for k, v in _REFS.items() if k != "types_without_topping") + " FROM silver",
        "types_without_bridge": silver + f"SELECT {_REFS['types_without_topping']} AS types_without_topping FROM silver",
        "silver_quality_report": silver + _union(_silver_parts()),
        "check_row_parity": gold + _union([*_parity(), _content_parity()]),
        "check_trend": _trend_sql(),
        "check_uniqueness": gold + _union(_uniqueness()),
        "check_fact_nulls": gold + _union(_not_null()),
        "check_referential_integrity": gold + _union(_ri()),
        "check_line_total": gold + _union(_line_total()),
        "check_positive_quantity": gold + _union(_positive_quantity()),
        "gold_quality_report": gold + _union(_parity() + _uniqueness() + _not_null() + _line_total()
                                             + _positive_quantity() + _ri()),
    }


# --- bronze side ----------------------------------------------------------------------------------------

_MARK = "TIMESTAMP '2024-01-15 00:00:00'"
_NULL_TS = "TIMESTAMP '1900-01-01 00:00:01'"
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_CHANGED = ("o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END "
            "AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority")
_TOUCHED = _CHANGED.replace(" o_orderdate, o_orderpriority", " CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' "
                            "THEN o_orderdate + INTERVAL 730 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority")


def _words(cond: str) -> str:
    return (f"SELECT concat(p_brand, '/', p_type) AS pizza_type_id, split_part(p_name, ' ', 1) AS pizza_topping_id "
            f"FROM part WHERE {cond} UNION "
            f"SELECT concat(p_brand, '/', p_type) AS pizza_type_id, split_part(p_name, ' ', 2) AS pizza_topping_id "
            f"FROM part WHERE {cond}")


_SOURCE_COLUMNS = {
    "branch": ["bran_id", "bran_nm"], "member": ["member_id", "member_nm"],
    "orders": ["order_id", "date", "time", "member_id", "bran_id"],
    "orderdetail": ["order_detail_id", "order_id", "pizza_id", "quantity"],
    "pizza": ["pizza_id", "pizza_type_id", "size", "price"], "pizzatypes": ["pizza_type_id", "pizza_nm", "pizza_categ"],
    "pizzatypetopping": ["pizza_type_id", "pizza_topping_id"], "topping": ["pizza_topping_id", "pizza_topping_nm"],
}


def bronze_sql() -> dict[str, str]:
    inc = f"SELECT * FROM events WHERE COALESCE(ts, {_NULL_TS}) > {_MARK}"
    views = ["branch_s", "member_s", "orders_s", "od_s", "pizza_s", "ptype_s", "bridge_s", "topping_s"]
    names = ["branch", "member", "orders", "orderdetail", "pizza", "pizzatypes", "pizzatypetopping", "topping"]
    return {
        "incremental_read": inc,
        "hwm_advance": (f"SELECT 'events' AS table_name, GREATEST(COALESCE(MAX(COALESCE(ts, {_NULL_TS})), {_MARK}), "
                        f"{_MARK}) AS watermark_value FROM ({inc}) i"),
        "initial_load": "SELECT * FROM orders",
        "snapshot_copy": with_views() + _union([
            f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS rows, {_digest_sum(_SOURCE_COLUMNS[n])} AS content FROM {v}"
            for n, v in zip(names, views)]),
        "schema_evolution_upsert": (
            "WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), "
            f"s AS (SELECT {_CHANGED} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') "
            "SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
            "NULL AS o_orderpriority FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL "
            "SELECT s.o_orderkey, CAST(s.o_custkey AS BIGINT), s.o_orderstatus, t.o_totalprice, s.o_orderdate, "
            "s.o_orderpriority FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey"),
        "quarantine_ingest": (f"SELECT {_ORDER_COLS} FROM orders WHERE o_orderkey % 89 <> 1 AND o_orderkey % 83 <> 2 "
                              "AND o_orderkey % 97 <> 0"),
        "quarantined_rows": (
            "WITH f AS (SELECT *, o_orderstatus AS status FROM orders UNION ALL "
            "SELECT *, 'D' AS status FROM orders WHERE o_orderkey % 97 = 0) SELECT DISTINCT "
            "CASE WHEN o_orderkey % 89 <> 1 THEN o_orderkey END AS o_orderkey, o_custkey, status AS o_orderstatus, o_totalprice, "
            "CASE WHEN o_orderkey % 83 = 2 THEN TIMESTAMP '2999-01-01' ELSE o_orderdate END AS o_orderdate, o_orderpriority, "
            "concat_ws(',', CASE WHEN o_orderkey % 89 = 1 THEN 'null_key' END, CASE WHEN o_orderkey % 83 = 2 THEN "
            "'timestamp_range' END, CASE WHEN o_orderkey % 97 = 0 AND o_orderkey % 89 <> 1 THEN 'duplicate_key' END) AS reasons "
            "FROM f WHERE o_orderkey % 89 = 1 OR o_orderkey % 83 = 2 OR o_orderkey % 97 = 0"),
        "warehouse_publish": with_views("fact", "dim_branch") + (
            f"SELECT b.bran_id, b.bran_nm, {_rev('f.total_price')} AS revenue FROM fact f JOIN dim_branch b "
            "ON f.bran_id = b.bran_id GROUP BY b.bran_id, b.bran_nm"),
        "catalog_silver_orders": with_views("silver") + "SELECT * FROM silver",
        "catalog_monthly_revenue": bi_sql()["bi_monthly_revenue"],
        "keyed_upsert": (
            "WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), "
            f"s AS (SELECT {_CHANGED} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') "
            f"SELECT {_ORDER_COLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey) "
            f"UNION ALL SELECT {_ORDER_COLS} FROM s"),
        "keyed_upsert_composite": (
            f"WITH tw AS ({_words('p_partkey % 3 <> 0')}), sw AS ({_words('p_partkey % 3 <> 1')}) "
            "SELECT pizza_type_id, pizza_topping_id, 'v1' AS flag FROM tw WHERE NOT EXISTS (SELECT 1 FROM sw "
            "WHERE sw.pizza_type_id = tw.pizza_type_id AND sw.pizza_topping_id = tw.pizza_topping_id) "
            "UNION ALL SELECT pizza_type_id, pizza_topping_id, 'v2' AS flag FROM sw"),
        # newer-or-equal change wins: the second drop replaces every order it carries
        "streaming_ingest": f"SELECT {_CHANGED} FROM orders",
        "incremental_ingest": (
            "WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), "
            f"m AS (SELECT MAX(COALESCE(o_orderdate, {_NULL_TS})) AS mark FROM t), "
            f"c AS (SELECT {_TOUCHED} FROM orders), "
            "s AS (SELECT * FROM c WHERE o_orderdate > (SELECT mark FROM m)) "
            f"SELECT {_ORDER_COLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey) "
            f"UNION ALL SELECT {_ORDER_COLS} FROM s"),
    }


# --- projections, joins, scalar functions ----------------------------------------------------------------

def relational_sql() -> dict[str, str]:
    src = with_views()
    silver = with_views("silver")
    fact = with_views("fact")
    hour = "CAST(hour(strptime(time, '%H:%M:%S')) AS INTEGER)"
    return {
        "project_columns": silver + "SELECT order_detail_id, order_id, date, time, pizza_id, quantity FROM silver",
        "distinct_rows": silver + "SELECT DISTINCT order_id, date, member_id, bran_id FROM silver",
        "line_total": fact + "SELECT order_detail_id, pizza_topping_id, unit_price, quantity, total_price FROM fact",
        "line_total_from_float": fact.replace("CAST(p_retailprice AS DECIMAL", "CAST(CAST(p_retailprice AS FLOAT) AS DECIMAL")
        + "SELECT order_detail_id, pizza_topping_id, unit_price, quantity, total_price FROM fact",
        "default_keys": fact + "SELECT order_detail_id, pizza_topping_id, member_id, bran_id FROM fact",
        "join_inner_chain": src + (
            "SELECT od.order_detail_id, o.order_id, p.pizza_id, pt.pizza_type_id, o.date, od.quantity, p.price, "
            "pt.pizza_categ FROM od_s od JOIN orders_s o ON od.order_id = o.order_id "
            "JOIN pizza_s p ON od.pizza_id = p.pizza_id JOIN ptype_s pt ON p.pizza_type_id = pt.pizza_type_id"),
        "join_left_lookup": src + (
            "SELECT o.order_id, o.member_id, m.member_nm, o.bran_id, b.bran_nm FROM orders_s o "
            "LEFT JOIN member_s m ON o.member_id = m.member_id LEFT JOIN branch_s b ON o.bran_id = b.bran_id"),
        "join_bridge_fanout": src + (
            "SELECT od.order_detail_id, p.pizza_type_id, br.pizza_topping_id, tp.pizza_topping_nm FROM od_s od "
            "JOIN pizza_s p ON od.pizza_id = p.pizza_id LEFT JOIN bridge_s br ON p.pizza_type_id = br.pizza_type_id "
            "LEFT JOIN topping_s tp ON br.pizza_topping_id = tp.pizza_topping_id"),
        "orphan_keys_anti_join": src + (
            "SELECT member_id, count(*) AS n FROM orders_s o WHERE NOT EXISTS "
            "(SELECT 1 FROM member_s m WHERE m.member_id = o.member_id) GROUP BY member_id"),
        "join_on_date_expr": with_views("dim_date") + (
            "SELECT dd.date, count(*) AS n FROM orders_s o JOIN dim_date dd ON TRY_CAST(o.date AS DATE) = dd.date "
            "GROUP BY dd.date"),
        "union_distinct_default_row": silver + (
            "SELECT DISTINCT member_id, member_nm FROM silver WHERE member_id IS NOT NULL UNION SELECT '0', '비회원(Guest)'"),
        "scalar_date_functions": src + (
            "SELECT order_id, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, "
            "CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS weekday_num, "
            "strftime(d, '%a') AS weekday, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, "
            f"{hour} AS hour, CAST(year(d) AS VARCHAR) || CAST(month(d) AS VARCHAR) AS month_label "
            "FROM (SELECT order_id, time, TRY_CAST(date AS DATE) AS d FROM orders_s) o"),
    }


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(star_sql())
    out.update(bi_sql())
    out.update(quality_sql())
    out.update(bronze_sql())
    out["keyed_upsert_partitioned"] = out["keyed_upsert"]
    out.update(relational_sql())
    return out
