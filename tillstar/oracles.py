"""Independent SQL for the registered queries, over the given tables only."""

from __future__ import annotations

from tillstar.functions.text import BRANCH_TOKENS

_B = BRANCH_TOKENS

_BAD = "l_linenumber = 7 AND l_returnflag = 'R'"
_RAW = f"""
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CAST(l_shipdate AS DATE) AS transaction_date,
         CASE WHEN l_suppkey % 50 = 49 THEN NULL
              ELSE s_name || ' ' || CASE l_partkey % 4 WHEN 0 THEN '{_B[0]}' WHEN 1 THEN '{_B[1]}'
                                                       WHEN 2 THEN '{_B[2]}' ELSE '{_B[3]}' END
         END AS merchant_name,
         CASE WHEN l_suppkey % 25 = 7 THEN r_name ELSE r_name || '-' || n_name END AS merchant_category,
         CAST(CASE WHEN {_BAD} THEN -CAST(l_extendedprice AS DECIMAL(15,2))
                   ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS amount,
         '****' || lpad(CAST(c_custkey % 997 AS VARCHAR), 4, '0') AS card_number,
         CASE WHEN c_custkey % 2 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
         c_mktsegment AS card_company,
         l_shipdate AS created_at
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "transaction_date", "merchant_name", "merchant_category", "amount", "card_number", "card_type",
        "card_company", "created_at",
    )
)


def _first_copy(table: str, order: str = _ORDER) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) AS rn FROM {table})
  WHERE rn = 1"""


def _normalized(col: str = "merchant_name") -> str:
    for token in _B:
        col = f"trim(replace({col}, '{token}', ''))"
    return col


def _key(*cols: str) -> str:
    parts = " || ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')" for c in cols
    )
    return f"CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT)"


def _int(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def _calendar(day: str) -> str:
    return f"""{_int(f"strftime({day}, '%Y%m%d')")} AS date_key, {day} AS full_date,
         {_int(f"year({day})")} AS year, {_int(f"quarter({day})")} AS quarter, {_int(f"month({day})")} AS month,
         monthname({day}) AS month_name, {_int(f"day({day})")} AS day_of_month,
         {_int(f"isodow({day}) - 1")} AS day_of_week, dayname({day}) AS day_name,
         isodow({day}) >= 6 AS is_weekend"""


def _half_up(numerator: str, denominator: str, scale: int = 2) -> str:
    """numerator / denominator for whole numbers of any sign, rounded half away from zero, as a double."""
    n, d, f = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**scale
    return f"""(CASE WHEN {n} < 0 THEN -1 ELSE 1 END)
         * CAST((2 * abs({n}) * {f} + {d}) // (2 * {d}) AS DOUBLE) / {f}"""


def _cents(expr: str) -> str:
    return f"CAST({expr} * 100 AS DECIMAL(38,0))"


def _avg(amount: str = "amount", scale: int = 2) -> str:
    return _half_up(_cents(f"sum({amount})"), f"(100 * count({amount}))", scale)


def _percent(part: str, whole: str) -> str:
    """Both in the same unit, two decimals at most."""
    return _half_up(f"100 * {_cents(part)}", f"nullif({_cents(whole)}, 0)")


def _sum(amount: str = "amount") -> str:
    return f"CAST(sum({amount}) AS DECIMAL(25,2))"


_SUPPLIERS = """
  SELECT *, CASE WHEN s_suppkey % 25 = 7 THEN r_name ELSE r_name || '-' || n_name END AS category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_CTES = {
    "raw_txn": _RAW,
    "valid": """
  SELECT * FROM raw_txn WHERE amount > 0 AND transaction_date IS NOT NULL AND merchant_name IS NOT NULL""",
    "kept": _first_copy("valid"),
    "silver": f"""
  SELECT transaction_id, transaction_date, {_int("year(transaction_date)")} AS year,
         {_int("month(transaction_date)")} AS month, merchant_name, {_normalized()} AS normalized_merchant,
         merchant_category, amount, CASE WHEN amount > 0 THEN 'EXPENSE' ELSE 'INCOME' END AS transaction_type,
         card_number, card_type, card_company, created_at
  FROM kept""",
    "days": """
  SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM (
    SELECT date_trunc('year', min(transaction_date)) AS first_day,
           date_trunc('year', max(transaction_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS last_day FROM raw_txn)""",
    "dim_date": f"SELECT {_calendar('d')}, false AS is_holiday FROM days",
    "short_calendar": "SELECT * FROM dim_date WHERE full_date <= DATE '2001-06-30'",
    "dim_category": f"""
  SELECT {_key('merchant_category')} AS category_key, merchant_category AS category_name,
         split_part(merchant_category, '-', 1) AS level_1,
         nullif(split_part(merchant_category, '-', 2), '') AS level_2
  FROM (SELECT DISTINCT merchant_category FROM silver WHERE merchant_category IS NOT NULL)""",
    "dim_merchant": f"""
  SELECT {_key('normalized_merchant', 'merchant_category', "DATE '1995-01-01'")} AS merchant_key,
         normalized_merchant AS merchant_name, merchant_category, DATE '1995-01-01' AS effective_date,
         DATE '9999-12-31' AS expiration_date, true AS is_current
  FROM (SELECT DISTINCT normalized_merchant, merchant_category FROM silver)""",
    "dim_card": """
  SELECT row_number() OVER (ORDER BY card_number, card_type, card_company) AS card_key, *
  FROM (SELECT DISTINCT card_number, card_type, card_company FROM silver)""",
    "fact": """
  SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_key, date_key, s.year, s.month, category_key,
         merchant_key, card_key, transaction_id, amount, 1 AS quantity
  FROM silver s
  LEFT JOIN dim_date d ON s.transaction_date = d.full_date
  LEFT JOIN dim_category c ON s.merchant_category = c.category_name
  LEFT JOIN dim_merchant m ON s.normalized_merchant = m.merchant_name AND m.is_current
  LEFT JOIN dim_card k ON s.card_number = k.card_number AND s.card_type = k.card_type
                      AND s.card_company = k.card_company""",
    "by_day": "SELECT f.amount, f.category_key, d.* FROM fact f JOIN dim_date d USING (date_key)",
    "by_category": "SELECT f.amount, c.* FROM fact f JOIN dim_category c USING (category_key)",
    "by_merchant": """
  SELECT f.amount, m.merchant_name, c.* FROM fact f JOIN dim_merchant m USING (merchant_key)
  JOIN dim_category c USING (category_key) WHERE m.is_current""",
    "suppliers": _SUPPLIERS,
    "merchants_a": "SELECT s_name AS merchant_name, category AS merchant_category FROM suppliers WHERE s_suppkey % 10 <> 9",
    "merchants_b": """
  SELECT s_name AS merchant_name,
         CASE WHEN s_suppkey % 10 = 0 THEN 'RECLASS-' || n_name ELSE category END AS merchant_category
  FROM suppliers WHERE s_suppkey % 10 <> 8""",
    # Expected outcome per kind of merchant, not a merge: moved ones get two rows, all others one.
    "scd2": f"""
  SELECT {_key('merchant_name', 'merchant_category', 'effective_date')} AS merchant_key, * FROM (
    SELECT s_name AS merchant_name, category AS merchant_category, DATE '2000-01-01' AS effective_date,
           CASE WHEN s_suppkey % 10 = 0 THEN DATE '2001-01-01' ELSE DATE '9999-12-31' END AS expiration_date,
           s_suppkey % 10 <> 0 AS is_current
    FROM suppliers WHERE s_suppkey % 10 <> 9
    UNION ALL
    SELECT s_name, 'RECLASS-' || n_name, DATE '2001-01-01', DATE '9999-12-31', true
    FROM suppliers WHERE s_suppkey % 10 = 0
    UNION ALL
    SELECT s_name, category, DATE '2001-01-01', DATE '9999-12-31', true FROM suppliers WHERE s_suppkey % 10 = 9)""",
    "months": f"SELECT year, month, {_sum()} AS total_amount FROM by_day GROUP BY year, month",
}

_NEEDS = {
    "valid": ["raw_txn"],
    "kept": ["valid"],
    "silver": ["kept"],
    "days": ["raw_txn"],
    "dim_date": ["days"],
    "short_calendar": ["dim_date"],
    "dim_category": ["silver"],
    "dim_merchant": ["silver"],
    "dim_card": ["silver"],
    "fact": ["silver", "dim_date", "dim_category", "dim_merchant", "dim_card"],
    "by_day": ["fact"],
    "by_category": ["fact"],
    "by_merchant": ["fact"],
    "merchants_a": ["suppliers"],
    "merchants_b": ["suppliers"],
    "scd2": ["suppliers"],
    "months": ["by_day"],
}


def _with(select: str, *needs: str, double: tuple[str, ...] = (), text: tuple[str, ...] = ()) -> str:
    """Prefix the views a query needs; show `double` columns as doubles and `text` ones as strings."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        wanted.add(name)

    for name in needs:
        add(name)
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in _CTES.items() if name in wanted)
    shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in double] + [f"CAST({c} AS VARCHAR) AS {c}" for c in text]
    if shown:
        select = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({select})"
    return f"WITH {ctes} {select}" if ctes else select


_AMOUNT = ("amount",)
_TOTAL = ("total_amount",)
_DAY = ("transaction_date",)
_VALIDITY = ("effective_date", "expiration_date")
_STAMP = "strftime(created_at, '%Y-%m-%d %H:%M:%S')"
_PLAIN = "* EXCLUDE (created_at)"


def _checks(layer: str, *rows: tuple[str, str, str]) -> str:
    """One output row per (check, column, scalar expression for the failed rows)."""
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{check}' AS check_name, '{column}' AS column_name, "
        f"CAST(failed AS BIGINT) AS failed_rows, failed = 0 AS passed FROM (SELECT {expr} AS failed)"
        for check, column, expr in rows
    )


def _nulls(table: str, col: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {col} IS NULL)"


def _copies(table: str, col: str) -> str:
    return f"(SELECT count(*) - count(DISTINCT {col}) - max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) FROM {table})"


def _outside(table: str, col: str, low: int, high: int) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {col} < {low} OR {col} > {high})"


def _wrong(table: str, col: str, values: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {col} IS NULL OR {col} NOT IN ({values}))"


_BRONZE_CHECKS = [
    *[("required_column", c, "0") for c in ("transaction_id", "transaction_date", "merchant_name", "amount", "card_number")],
    *[("not_null", c, _nulls("raw_txn", c)) for c in ("transaction_id", "transaction_date", "merchant_name", "amount")],
    ("unique", "transaction_id", _copies("raw_txn", "transaction_id")),
    ("in_range", "amount", _outside("raw_txn", "amount", 1, 10000000)),
]
_SILVER_CHECKS = [
    *[("required_column", c, "0") for c in ("transaction_id", "normalized_merchant", "transaction_type", "processed_at")],
    ("allowed_values", "transaction_type", _wrong("silver", "transaction_type", "'INCOME', 'EXPENSE'")),
    *[("not_null", c, _nulls("silver", c)) for c in ("transaction_id", "normalized_merchant", "amount")],
    ("unique", "transaction_id", _copies("silver", "transaction_id")),
    ("in_range", "amount", _outside("silver", "amount", 1, 10000000)),
]
_FACT_CHECKS = [
    *[("required_column", c, "0") for c in ("transaction_key", "date_key", "merchant_key", "category_key", "amount")],
    *[("foreign_key", c, _nulls("fact", c)) for c in ("date_key", "merchant_key", "category_key")],
    ("unique", "transaction_key", _copies("fact", "transaction_key")),
    ("in_range", "date_key", _outside("fact", "date_key", 19950101, 20010630)),
]
_DIM_COLUMNS = {
    "dim_date": ("date_key", "full_date", "year", "month"),
    "dim_category": ("category_key", "category_name", "level_1"),
    "dim_merchant": ("merchant_key", "merchant_name"),
    "dim_card": ("card_key", "card_number"),
}


def _dim_checks(name: str) -> list[tuple[str, str, str]]:
    cols = _DIM_COLUMNS[name]
    return [*[("required_column", c, "0") for c in cols], ("unique", cols[0], _copies(name, cols[0]))]


_ALL_CHECKS = " UNION ALL ".join(
    [
        _checks("bronze", *_BRONZE_CHECKS),
        _checks("silver", *_SILVER_CHECKS),
        *[_checks(name, *_dim_checks(name)) for name in _DIM_COLUMNS],
        _checks("fact_transactions", *_FACT_CHECKS),
    ]
)

_MART_ROWS = f"""(SELECT * FROM ({_first_copy(
    "(SELECT transaction_id, transaction_date, merchant_name, merchant_category, amount FROM raw_txn WHERE amount > 0)",
    "transaction_date NULLS FIRST, merchant_name NULLS FIRST, merchant_category NULLS FIRST, amount NULLS FIRST",
)}))"""


def _upserted(rows: str, cut: str = "2001-01-01", overlap: str = "2000-10-01") -> str:
    """Rows from the overlap on come from the delta, which adds 1.00; `rows` lists the columns."""
    return f"""
  SELECT {rows}, CASE WHEN transaction_date >= DATE '{overlap}' THEN amount + 1 ELSE amount END AS amount FROM silver"""


def _valid_first(feed: str, later_first: str = "") -> str:
    """Valid rows of a feed in silver's columns, the first copy of each transaction."""
    order = f"{later_first}{_ORDER}"
    rows = _first_copy(f"({feed} WHERE amount > 0 AND transaction_date IS NOT NULL AND merchant_name IS NOT NULL)", order)
    return f"SELECT *, {_normalized()} AS normalized_merchant FROM ({rows})"


def _stream_merge() -> str:
    """Three files one after the other: of a transaction, the copy of the latest file that has it."""
    feed = """SELECT * FROM (
          SELECT *, 1 AS file FROM raw_txn WHERE transaction_date < DATE '2001-01-01'
          UNION ALL SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(15,2)) AS amount), 2 FROM raw_txn WHERE transaction_date >= DATE '2000-10-01'
          UNION ALL SELECT *, 3 FROM raw_txn WHERE transaction_date < DATE '1996-01-01')"""
    return _with(
        f"""SELECT transaction_id, {_int('year(transaction_date)')} AS year, {_int('month(transaction_date)')} AS month,
                   {_int("strftime(transaction_date, '%Y%m%d')")} AS date_key, {_key('merchant_category')} AS category_key,
                   {_key('normalized_merchant', 'merchant_category', "DATE '1995-01-01'")} AS merchant_key, amount
            FROM ({_valid_first(feed, 'file DESC, ')})""",
        "raw_txn", double=_AMOUNT,
    )


def _asof_run() -> str:
    """Each fact points to its merchant's version of the day: the first load's, or that of a merchant new or moved in the second."""
    recat = "CASE WHEN merchant_category LIKE 'ASIA%' THEN 'RECLASS-' || merchant_category ELSE merchant_category END"
    early = "SELECT * FROM raw_txn WHERE transaction_date < DATE '2001-01-01'"
    late = f"SELECT * REPLACE ({recat} AS merchant_category) FROM raw_txn WHERE transaction_date >= DATE '2000-10-01'"
    members = "SELECT DISTINCT normalized_merchant AS name, merchant_category AS category FROM"
    return _with(
        f"""WITH e AS ({_valid_first(f'SELECT * FROM ({early})')}), l AS ({_valid_first(f'SELECT * FROM ({late})')}),
            a AS ({members} e), b AS ({members} l),
            v AS (
              SELECT a.name, a.category, DATE '1995-01-01' AS start,
                     CASE WHEN b.category <> a.category THEN DATE '2001-01-01' ELSE DATE '9999-12-31' END AS until
              FROM a LEFT JOIN b ON a.name = b.name
              UNION ALL
              SELECT b.name, b.category, DATE '2001-01-01', DATE '9999-12-31' FROM b LEFT JOIN a ON a.name = b.name
              WHERE a.name IS NULL OR a.category <> b.category),
            s AS (SELECT * FROM l UNION ALL SELECT * FROM e WHERE transaction_id NOT IN (SELECT transaction_id FROM l))
            SELECT transaction_id, {_int('year(transaction_date)')} AS year, {_int('month(transaction_date)')} AS month,
                   {_int("strftime(transaction_date, '%Y%m%d')")} AS date_key, {_key('merchant_category')} AS category_key,
                   CASE WHEN v.name IS NOT NULL THEN {_key('v.name', 'v.category', 'v.start')} END AS merchant_key, amount
            FROM s LEFT JOIN v ON s.normalized_merchant = v.name AND transaction_date >= start AND transaction_date < until""",
        "raw_txn", double=_AMOUNT,
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources, sinks, layout
    raw_rows = f"SELECT * REPLACE ({_STAMP} AS created_at) FROM raw_txn"
    sql["src_1_scan_raw"] = _with(raw_rows, "raw_txn", double=_AMOUNT, text=_DAY)
    sql["src_1_derive_feed"] = sql["src_11_copy_floor"] = sql["src_1_scan_raw"]
    sql["src_2_lineage"] = _with(
        "SELECT transaction_id, amount, true AS has_time, true AS has_source FROM raw_txn", "raw_txn", double=_AMOUNT
    )
    year_month = f"{_int('year(transaction_date)')} AS year, {_int('month(transaction_date)')} AS month"
    sql["src_3_year_month"] = _with(
        f"SELECT transaction_id, transaction_date, {year_month} FROM raw_txn", "raw_txn", text=_DAY
    )
    sql["src_4_partitioned_write"] = _with(
        f"SELECT {_PLAIN}, {year_month} FROM raw_txn", "raw_txn", double=_AMOUNT, text=_DAY
    )
    sql["src_5_rerun_modes"] = _with(
        f"""SELECT 'overwrite' AS mode, count(*) AS row_count, {_sum()} AS amount FROM raw_txn
            UNION ALL SELECT 'append', 2 * count(*), {_sum("2 * amount")} FROM raw_txn""",
        "raw_txn", double=_AMOUNT,
    )
    sql["src_6_read_by_path"] = _with(
        f"SELECT year, month, count(*) AS row_count, {_sum()} AS amount FROM silver GROUP BY year, month",
        "silver", double=_AMOUNT,
    )
    sql["src_7_sql_views"] = _with(
        f"""SELECT d.year, d.month_name, c.level_1 AS category, {_sum()} AS total_amount
            FROM fact f JOIN dim_date d USING (date_key) JOIN dim_category c USING (category_key)
            GROUP BY d.year, d.month, d.month_name, c.level_1""",
        "fact", double=_TOTAL,
    )
    old = "transaction_date < DATE '2001-01-01'"
    sql["src_8_schema_evolution"] = _with(
        f"""SELECT transaction_id, transaction_date, amount, CASE WHEN {old} THEN NULL ELSE card_type END AS card_type,
                   CASE WHEN {old} THEN 'UNKNOWN' ELSE card_company END AS card_company FROM raw_txn""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["src_8_union_by_name"] = _with(
        f"""SELECT transaction_id, transaction_date, amount,
                   CASE WHEN {old} THEN NULL ELSE card_company END AS card_company FROM raw_txn""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    unreadable = "transaction_id LIKE '%-3'"
    sql["src_9_conform_card"] = _with(
        f"""SELECT * REPLACE ({_STAMP} AS created_at, CASE WHEN {unreadable} THEN NULL ELSE amount END AS amount),
                   concat_ws(',', CASE WHEN merchant_name IS NULL THEN 'merchant_name' END,
                                  CASE WHEN {unreadable} THEN 'amount' END) AS lost_fields FROM raw_txn""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["src_9_conform_bank"] = _with(
        """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
                  o_orderpriority AS description, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
                  CAST(c_acctbal AS DECIMAL(15,2)) AS balance, CAST(c_custkey AS VARCHAR) AS account_number,
                  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at
           FROM orders JOIN customer ON o_custkey = c_custkey""",
        double=("amount", "balance"), text=_DAY,
    )
    sql["src_9_conform_stock"] = _with(
        """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
                  CAST(l_shipdate AS DATE) AS transaction_date, p_brand AS stock_code, p_name AS stock_name,
                  l_returnflag AS transaction_type, CAST(l_quantity AS INTEGER) AS quantity,
                  CAST(p_retailprice AS DECIMAL(15,2)) AS price, CAST(l_extendedprice AS DECIMAL(15,2)) AS total_amount,
                  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at
           FROM lineitem JOIN part ON l_partkey = p_partkey""",
        double=("price", "total_amount"), text=_DAY,
    )
    sql["src_10_export_codecs"] = _with(
        """SELECT transaction_id, year, month, amount, codec FROM silver
           CROSS JOIN (SELECT unnest(['snappy', 'uncompressed']) AS codec)""",
        "silver", double=_AMOUNT,
    )
    sql["src_12_report_json"] = _with(_checks("bronze", *_BRONZE_CHECKS), "raw_txn")
    catalog = """SELECT s_name AS name, r_name AS category, n_name AS subcategory,
                        s_suppkey % 50 * 100 + 1000 AS min_amount, (s_suppkey % 50 * 100 + 1000) * 10 AS max_amount
                 FROM suppliers"""

    def draw(digest: str, slot: int) -> str:
        return f"CAST('0x' || substr({digest}, {8 * slot + 1}, 8) AS BIGINT)"

    sql["src_14_generate"] = _with(
        f"""SELECT substr(a, 1, 8) || '-' || substr(a, 9, 4) || '-' || substr(a, 13, 4) || '-' || substr(a, 17, 4)
                   || '-' || substr(a, 21, 12) AS transaction_id,
                   CAST(DATE '2023-01-01' + CAST({draw('a', 1)} % 731 AS INTEGER) AS DATE) AS transaction_date,
                   name AS merchant_name, category || '-' || subcategory AS merchant_category,
                   min_amount + {draw('a', 2)} % (max_amount - min_amount + 1) AS amount,
                   '****' || CAST({draw('b', 0)} % 9000 + 1000 AS VARCHAR) AS card_number,
                   CASE {draw('b', 1)} % 2 WHEN 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
                   ['Aspen', 'Birch', 'Cedar', 'Dahlia', 'Elm', 'Fern', 'Grove'][{draw('b', 2)} % 7 + 1] || ' Card'
                     AS card_company
            FROM (SELECT md5('42|' || CAST(o_orderkey AS VARCHAR)) AS a,
                         md5('42|' || CAST(o_orderkey AS VARCHAR) || '|card') AS b FROM orders)
            JOIN (SELECT *, row_number() OVER (ORDER BY name, category, subcategory, min_amount, max_amount) - 1 AS no,
                         count(*) OVER () AS merchants FROM ({catalog})) ON {draw('a', 0)} % merchants = no""",
        "suppliers", double=_AMOUNT, text=_DAY,
    )
    sql["src_15_catalog_filter"] = _with(f"SELECT * FROM ({catalog}) WHERE category = 'ASIA'", "suppliers")
    sql["src_16_compact"] = sql["src_16_zorder"] = sql["src_1_scan_raw"]
    sql["src_17_snapshot"] = _with(
        f"""SELECT 'earlier' AS snapshot, count(*) AS row_count, {_sum()} AS amount FROM silver WHERE {old}
            UNION ALL SELECT 'latest', count(*), {_sum()} FROM silver""",
        "silver", double=_AMOUNT,
    )
    sql["src_18_rebuild_slice"] = _with(
        """SELECT transaction_id, CASE WHEN year = 1998 AND month = 3 THEN amount + 1 ELSE amount END AS amount,
                  year, month FROM silver""",
        "silver", double=_AMOUNT,
    )

    sql["str_1_stream_ingest"] = _with(
        f"SELECT transaction_id, transaction_date, amount, {year_month}, true AS has_source FROM raw_txn",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )

    # projections, filters, scalars
    sql["prj_1_valid"] = _with(f"SELECT {_PLAIN} FROM valid", "valid", double=_AMOUNT, text=_DAY)
    sql["prj_1_valid_without_merchant"] = _with(
        "SELECT transaction_id, merchant_name, amount FROM raw_txn WHERE amount > 0 AND transaction_date IS NOT NULL",
        "raw_txn", double=_AMOUNT,
    )
    sql["prj_1_valid_amount_only"] = _with(
        "SELECT transaction_id, transaction_date, amount FROM raw_txn WHERE amount > 0",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["prj_2_rejects"] = _with(
        f"""SELECT {_PLAIN}, CASE WHEN amount <= 0 THEN 'amount not positive' ELSE 'merchant_name is null' END
              AS reject_reason FROM raw_txn WHERE amount <= 0 OR merchant_name IS NULL""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["prj_3_normalize_merchant"] = _with(
        f"SELECT transaction_id, merchant_name, {_normalized()} AS normalized_merchant FROM raw_txn", "raw_txn"
    )
    kind = "CASE WHEN amount > 0 THEN 'EXPENSE' ELSE 'INCOME' END"
    sql["prj_4_transaction_type"] = _with(
        f"SELECT transaction_id, amount, {kind} AS transaction_type FROM raw_txn", "raw_txn", double=_AMOUNT
    )
    sql["prj_5_select_silver"] = _with(
        f"""SELECT transaction_id, transaction_date, {year_month}, merchant_name, {_normalized()} AS normalized_merchant,
                   merchant_category, amount, {kind} AS transaction_type, card_number, card_type, card_company
            FROM raw_txn""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["prj_6_split_category"] = _with(
        """SELECT transaction_id, merchant_category, split_part(merchant_category, '-', 1) AS level_1,
                  CASE WHEN contains(merchant_category, '-') THEN split_part(merchant_category, '-', 2) END AS level_2
           FROM raw_txn""",
        "raw_txn",
    )
    sql["prj_7_constant_columns"] = _with(
        "SELECT transaction_id, amount, 1 AS quantity, true AS has_loaded_at FROM silver", "silver", double=_AMOUNT
    )
    sql["prj_8_members"] = _with("SELECT DISTINCT merchant_category, card_company, card_type FROM silver", "silver")
    sql["prj_9_calendar_columns"] = _with(
        f"SELECT transaction_id, {_calendar('transaction_date')} FROM raw_txn", "raw_txn", text=("full_date",)
    )
    holiday = "(month = 1 AND day_of_month = 1) OR (month = 12 AND day_of_month = 25)"
    sql["prj_10_holidays"] = _with(
        f"SELECT * REPLACE (({holiday}) AS is_holiday) FROM dim_date", "dim_date", text=("full_date",)
    )
    sql["prj_11_rounding_units"] = _with(
        f"""SELECT transaction_id, CAST(round(amount, 0) AS DOUBLE) AS rounded,
                   {_half_up(_cents('amount'), '100000')} AS thousands,
                   {_half_up(_cents('amount'), '100000000')} AS millions,
                   strftime(transaction_date, '%Y-%m') AS year_month FROM silver""",
        "silver",
    )
    sql["prj_12_day_type"] = _with(
        """SELECT transaction_id, transaction_date,
                  CASE WHEN dayname(transaction_date) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END
                    AS day_type FROM raw_txn""",
        "raw_txn", text=_DAY,
    )

    sql["prj_13_sample"] = _with(
        f"SELECT transaction_id, amount FROM silver WHERE {_key('transaction_id')} % 10000 < 100", "silver", double=_AMOUNT
    )

    # deduplication
    sql["ded_1_any"] = _with("SELECT DISTINCT transaction_id FROM valid", "valid")
    kept = f"SELECT * REPLACE ({_STAMP} AS created_at) FROM kept"
    sql["ded_2_hash"] = sql["ded_3_window"] = _with(kept, "kept", double=_AMOUNT, text=_DAY)
    sql["ded_3_dedup_first"] = _with(
        f"""SELECT * REPLACE ({_STAMP} AS created_at) FROM ({_first_copy("raw_txn")})
            WHERE amount > 0 AND transaction_date IS NOT NULL AND merchant_name IS NOT NULL""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["ded_4_stats"] = _with(
        """SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_kept,
                  CAST(sum(n) - count(*) AS BIGINT) AS rows_removed, max(n) AS max_copies
           FROM (SELECT count(*) AS n FROM raw_txn GROUP BY transaction_id)""",
        "raw_txn",
    )

    # joins
    sql["jon_1_date"] = _with(
        """SELECT transaction_id, transaction_date, date_key FROM silver
           LEFT JOIN short_calendar ON transaction_date = full_date""",
        "silver", "short_calendar", text=_DAY,
    )
    sql["jon_2_category"] = _with(
        """SELECT transaction_id, merchant_category, category_key FROM silver
           LEFT JOIN dim_category ON merchant_category = category_name""",
        "dim_category",
    )
    sql["jon_3_merchant_current"] = _with(
        """SELECT transaction_id, normalized_merchant, merchant_key FROM silver
           LEFT JOIN scd2 ON normalized_merchant = scd2.merchant_name AND is_current""",
        "silver", "scd2",
    )
    sql["jon_4_merchant_composite"] = _with(
        """SELECT transaction_id, normalized_merchant, s.merchant_category, merchant_key FROM silver s
           LEFT JOIN dim_merchant m ON normalized_merchant = m.merchant_name
                                   AND s.merchant_category = m.merchant_category""",
        "dim_merchant",
    )
    sql["jon_5_card"] = _with(
        """SELECT transaction_id, card_number, card_type, card_company, card_key FROM silver
           LEFT JOIN dim_card USING (card_number, card_type, card_company)""",
        "dim_card",
    )
    sql["jon_6_inner"] = _with(
        """SELECT transaction_id, transaction_date, merchant_category, date_key, category_key FROM silver
           JOIN short_calendar ON transaction_date = full_date JOIN dim_category ON merchant_category = category_name""",
        "dim_category", "short_calendar", text=_DAY,
    )
    sql["jon_7_star"] = _with(
        """SELECT transaction_id, merchant_name, level_1, level_2, amount FROM fact
           JOIN dim_category USING (category_key) JOIN dim_merchant USING (merchant_key) WHERE is_current""",
        "fact", double=_AMOUNT,
    )
    sql["jon_8_changes"] = _with(
        """SELECT s_name AS merchant_name, 'RECLASS-' || n_name AS merchant_category, category AS old_merchant_category
           FROM suppliers WHERE s_suppkey % 10 = 0""",
        "suppliers",
    )
    sql["jon_9_asof"] = sql["jon_9_asof_merged"] = _with(
        """SELECT transaction_id, transaction_date, normalized_merchant, merchant_key,
                  scd2.merchant_category AS category_then FROM silver
           LEFT JOIN scd2 ON normalized_merchant = scd2.merchant_name
                         AND transaction_date >= effective_date AND transaction_date < expiration_date""",
        "silver", "scd2", text=_DAY,
    )
    sql["jon_10_orphans"] = _with(
        """SELECT date_key, transaction_id FROM fact
           WHERE date_key IS NULL OR date_key NOT IN (SELECT date_key FROM short_calendar)""",
        "fact", "short_calendar",
    )

    # merges
    def category_rows(names: str) -> str:
        return f"""SELECT {_key('name')} AS category_key, name AS category_name, split_part(name, '-', 1) AS level_1,
                          CASE WHEN contains(name, '-') THEN split_part(name, '-', 2) END AS level_2
                   FROM ({names})"""

    sql["mrg_1_scd1_category"] = _with(
        category_rows(
            f"""SELECT merchant_category AS name FROM silver WHERE {old}
                UNION SELECT merchant_category FROM silver WHERE card_type <> 'Debit'
                UNION SELECT 'RECLASS-' || merchant_category FROM silver WHERE card_type = 'Debit'"""
        ),
        "silver",
    )
    natural = "card_number, card_type, card_company"
    sql["mrg_1_scd1_card"] = _with(
        f"""SELECT row_number() OVER (ORDER BY late, {natural}) AS card_key, {natural} FROM (
              SELECT {natural}, min(transaction_date) >= DATE '1996-01-01' AS late FROM silver GROUP BY {natural})""",
        "silver",
    )
    sql["mrg_2_upsert"] = sql["mrg_6_upsert_slices"] = _with(
        _upserted("transaction_id, transaction_date, year, month"), "silver", double=_AMOUNT, text=_DAY
    )
    sql["mrg_2_large_source"] = sql["mrg_2_bucketed"] = sql["mrg_2_upsert"]
    sql["mrg_3_scd2"] = sql["mrg_3_scd2_repeated"] = _with("SELECT * FROM scd2", "scd2", text=_VALIDITY)
    sql["mrg_4_scd2_init"] = _with(
        f"""SELECT {_key('merchant_name', 'merchant_category', "DATE '2000-01-01'")} AS merchant_key, *,
                   DATE '2000-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date, true AS is_current
            FROM merchants_a""",
        "merchants_a", text=_VALIDITY,
    )
    sql["mrg_5_scd2_bootstrap"] = _with(
        """SELECT *, DATE '2000-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date, true AS is_current
           FROM merchants_a""",
        "merchants_a", text=_VALIDITY,
    )
    sql["mrg_6_incremental"] = _with(
        f"""SELECT transaction_id, CASE WHEN {old} THEN amount ELSE amount + 1 END AS amount,
                   strftime(created_at, '%Y-%m-%d %H:%M:%S') AS processed_at, year, month FROM silver""",
        "silver", double=_AMOUNT,
    )
    sql["mrg_7_staged_union"] = _with(
        """SELECT merchant_name, merchant_category FROM merchants_b UNION ALL
           SELECT b.merchant_name, NULL FROM merchants_b b LEFT JOIN merchants_a a USING (merchant_name)
           WHERE a.merchant_category IS DISTINCT FROM b.merchant_category""",
        "merchants_a", "merchants_b",
    )
    sql["mrg_8_materialize"] = _with(f"SELECT DISTINCT {natural} FROM silver", "silver")

    # keys
    sql["key_1_offset"] = _with(
        "SELECT count(*) AS row_count, count(*) AS key_count, true AS positive FROM silver", "silver"
    )
    sql["key_3_content"] = _with(
        f"""SELECT *, {_key('card_number', 'card_type', 'card_company')} AS card_key
            FROM (SELECT DISTINCT {natural} FROM silver)""",
        "silver",
    )
    sql["key_4_dense"] = "SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS order_key, o_orderkey, o_custkey FROM orders"
    sql["key_5_extend"] = _with(
        """SELECT row_number() OVER (ORDER BY s_suppkey % 10 = 9, s_name) AS merchant_no, s_name AS merchant_name,
                  category AS merchant_category FROM suppliers""",
        "suppliers",
    )
    sql["key_6_date_key"] = _with(
        f"SELECT transaction_id, {_int('strftime(transaction_date, ' + chr(39) + '%Y%m%d' + chr(39) + ')')} AS date_key FROM raw_txn",
        "raw_txn",
    )

    # builders
    sql["bld_1_bronze"] = _with(
        f"SELECT {_PLAIN}, {year_month}, true AS has_time, true AS has_source FROM raw_txn",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["bld_2_silver"] = sql["bld_2_silver_hash"] = _with(
        f"SELECT {_PLAIN} FROM silver", "silver", double=_AMOUNT, text=_DAY
    )
    sql["bld_3_dim_date"] = _with("SELECT * FROM dim_date", "dim_date", text=("full_date",))
    sql["bld_4_dim_category"] = _with("SELECT * FROM dim_category", "dim_category")
    sql["bld_4_dim_category_dense"] = _with(
        "SELECT * REPLACE (row_number() OVER (ORDER BY category_name) AS category_key) FROM dim_category", "dim_category"
    )
    sql["bld_5_dim_merchant"] = _with("SELECT * FROM dim_merchant", "dim_merchant", text=_VALIDITY)
    sql["bld_6_dim_card"] = _with("SELECT * FROM dim_card", "dim_card")
    sql["bld_7_fact"] = _with("SELECT * FROM fact", "fact", double=_AMOUNT)
    sql["bld_7_fact_asof"] = _with(
        """SELECT f.* EXCLUDE (transaction_key, merchant_key), scd2.merchant_key FROM fact f
           JOIN silver s USING (transaction_id)
           LEFT JOIN scd2 ON normalized_merchant = scd2.merchant_name
                         AND transaction_date >= effective_date AND transaction_date < expiration_date""",
        "fact", "scd2", double=_AMOUNT,
    )
    sql["bld_8_full_run"] = _with("SELECT * EXCLUDE (transaction_key) FROM fact", "fact", double=_AMOUNT)
    sql["bld_8_second_run"] = _with(
        f"""SELECT f.transaction_id, f.year, f.month, date_key, category_key,
                   CASE WHEN first_day < DATE '2001-01-01'
                        THEN {_key('normalized_merchant', 's.merchant_category', "DATE '1995-01-01'")}
                        ELSE {_key('normalized_merchant', 's.merchant_category', "DATE '2001-01-01'")} END AS merchant_key,
                   card_number, card_type, card_company, f.amount
            FROM fact f JOIN silver s USING (transaction_id)
            JOIN (SELECT normalized_merchant, min(transaction_date) AS first_day FROM silver GROUP BY 1)
              USING (normalized_merchant)""",
        "fact", double=_AMOUNT,
    )
    sql["bld_8_disjoint_years"] = _with(
        " UNION ALL ".join(
            f"SELECT {y} AS year, {m} AS month, count(*) AS row_count, {_sum()} AS amount, '{name}' AS layer FROM {table} GROUP BY 1, 2"
            for name, table, y, m in (
                ("bronze", "raw_txn", _int("year(transaction_date)"), _int("month(transaction_date)")),
                ("silver", "silver", "year", "month"),
                ("fact_transactions", "silver", "year", "month"),
            )
        ),
        "silver", double=_AMOUNT,
    )
    sql["bld_8_asof_run"] = _asof_run()
    sql["str_1_stream_merge"] = _stream_merge()
    # Of a transaction that both feeds hold, the copy of the later feed stays.
    by = "PARTITION BY transaction_id ORDER BY "
    sql["mrg_6_run_incremental"] = sql["bld_8_second_run"].replace(by, f"{by}transaction_date < DATE '2001-01-01', ")
    sql["src_17_snapshot_after_incremental"] = _with(
        """SELECT f.transaction_id, f.year, f.month, date_key, f.amount
           FROM fact f JOIN silver s USING (transaction_id) WHERE s.transaction_date < DATE '2001-01-01'""",
        "fact", double=_AMOUNT,
    )
    loose = "(SELECT * FROM raw_txn WHERE amount > 0 AND transaction_date IS NOT NULL)"
    sql["bld_9_one_pass"] = _with(
        f"""SELECT date_key, {_int('year(transaction_date)')} AS year, {_int('month(transaction_date)')} AS month,
                   {_key('merchant_category')} AS category_key,
                   CASE WHEN merchant_name IS NOT NULL THEN {_key('merchant_name', 'merchant_category')} END AS merchant_key,
                   transaction_id, amount, 1 AS quantity
            FROM ({_first_copy(loose)}) LEFT JOIN dim_date ON transaction_date = full_date""",
        "dim_date", double=_AMOUNT,
    )
    sql["bld_9_one_pass_row_keys"] = _with(
        f"""SELECT date_key, {year_month}, transaction_id, amount, 1 AS quantity,
                   merchant_name IS NOT NULL AS has_merchant_key
            FROM ({_first_copy(loose)}) LEFT JOIN dim_date ON transaction_date = full_date""",
        "dim_date", double=_AMOUNT,
    )
    sql["bld_10_hash_mart"] = _with(
        f"""SELECT transaction_id, {year_month}, category_key, merchant_key, amount FROM {_MART_ROWS}
            JOIN (SELECT merchant_category, row_number() OVER (ORDER BY merchant_category) AS category_key
                  FROM (SELECT DISTINCT merchant_category FROM {_MART_ROWS})) USING (merchant_category)
            JOIN (SELECT *, row_number() OVER (ORDER BY merchant_name, merchant_category) AS merchant_key
                  FROM (SELECT DISTINCT merchant_name, merchant_category FROM {_MART_ROWS} WHERE merchant_name IS NOT NULL))
              USING (merchant_name, merchant_category)""",
        "raw_txn", double=_AMOUNT,
    )
    flat = "(SELECT transaction_id, transaction_date, amount, merchant_name, merchant_category FROM raw_txn)"
    flat_order = "transaction_date NULLS FIRST, amount NULLS FIRST, merchant_name NULLS FIRST, merchant_category NULLS FIRST"
    sql["bld_11_window_mart"] = _with(
        f"""SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_key, *, {year_month}
            FROM ({_first_copy(flat, flat_order)}) WHERE amount > 0""",
        "raw_txn", double=_AMOUNT, text=_DAY,
    )
    sql["bld_12_all_dimensions"] = _with(
        " UNION ALL ".join(f"SELECT '{n}' AS layer, count(*) AS row_count FROM {n}" for n in _DIM_COLUMNS),
        "fact",
    )

    sql["bld_9_one_pass_star"] = _with(
        f"""SELECT transaction_id, date_key, merchant_category AS category_name, split_part(merchant_category, '-', 1) AS level_1,
                   nullif(split_part(merchant_category, '-', 2), '') AS level_2, merchant_name,
                   CASE WHEN merchant_name IS NOT NULL THEN merchant_category END AS merchant_category, amount
            FROM ({_first_copy(loose)}) LEFT JOIN dim_date ON transaction_date = full_date""",
        "dim_date", double=_AMOUNT,
    )
    sql["bld_10_mart_star"] = _with(
        f"""SELECT transaction_id, {year_month}, merchant_category AS category_name, merchant_name, merchant_category, amount
            FROM {_MART_ROWS} WHERE merchant_name IS NOT NULL""",
        "raw_txn", double=_AMOUNT,
    )

    # reports
    n = "count(*) AS txn_count"
    sql["rpt_1_monthly_summary"] = _with(
        f"""SELECT year, month, month_name, {n}, round({_sum()}, 0) AS total_amount, {_avg(scale=0)} AS avg_amount
            FROM by_day GROUP BY year, month, month_name""",
        "by_day", double=_TOTAL,
    )
    extremes = "min(amount) AS min_amount, max(amount) AS max_amount"
    sql["rpt_2_monthly_detail"] = _with(
        f"""SELECT year, month, month_name, {n}, {_sum()} AS total_amount, {_avg()} AS avg_amount, {extremes}
            FROM by_day GROUP BY year, month, month_name""",
        "by_day", double=("total_amount", "min_amount", "max_amount"),
    )
    sql["rpt_2_monthly_chart"] = _with(
        f"""SELECT strftime(full_date, '%Y-%m') AS year_month, {n},
                   {_half_up(_cents('sum(amount)'), '100000000')} AS total_millions FROM by_day GROUP BY 1""",
        "by_day",
    )
    sql["rpt_3_category_summary"] = _with(
        f"""SELECT level_1 AS category, {n}, round({_sum()}, 0) AS total_amount, {_avg(scale=0)} AS avg_amount
            FROM by_category GROUP BY level_1""",
        "by_category", double=_TOTAL,
    )
    subcategories = f"""SELECT level_1 AS category, level_2 AS subcategory, {n}, {_sum()} AS total_amount,
                               {_avg()} AS avg_amount FROM by_category GROUP BY level_1, level_2"""
    sql["rpt_4_subcategory_summary"] = _with(subcategories, "by_category", double=_TOTAL)
    sql["rpt_5_category_share"] = _with(
        f"""SELECT category, total_amount, {_percent('total_amount', 'whole')} AS share_percent FROM (
              SELECT level_1 AS category, {_sum()} AS total_amount, (SELECT sum(amount) FROM by_category) AS whole
              FROM by_category GROUP BY level_1)""",
        "by_category", double=_TOTAL,
    )
    levels = " UNION ALL ".join(
        f"""SELECT {level} AS level, {c} AS category, {s} AS subcategory, {n}, {_sum()} AS total_amount, {_avg()} AS avg_amount,
                   min(amount) AS min_amount, max(amount) AS max_amount FROM by_category {group}"""
        for level, c, s, group in (
            ("0", "NULL", "NULL", ""), ("1", "level_1", "NULL", "GROUP BY level_1"), ("2", "level_1", "level_2", "GROUP BY level_1, level_2")
        )
    )
    sql["rpt_5_rollup"] = _with(
        f"""SELECT l.*, {_percent('l.total_amount', 'a.total_amount')} AS share_percent FROM ({levels}) l
            JOIN (SELECT * FROM ({levels}) WHERE level < 2) a
              ON a.level = greatest(l.level - 1, 0) AND (l.level < 2 OR a.category = l.category)""",
        "by_category", double=("total_amount", "min_amount", "max_amount"),
    )
    sql["rpt_6_top_subcategories"] = _with(
        f"{subcategories} ORDER BY total_amount DESC, category, subcategory NULLS FIRST LIMIT 15", "by_category", double=_TOTAL
    )

    def top(limit: int, columns: str) -> str:
        return f"""SELECT {columns} FROM (
              SELECT merchant_name, level_1 AS category, count(*) AS visits, {_sum()} AS total_spent, {_avg()} AS avg_amount
              FROM by_merchant GROUP BY merchant_name, level_1
              ORDER BY total_spent DESC, merchant_name, category LIMIT {limit})"""

    spent = ("total_spent",)
    sql["rpt_7_top_merchants_15"] = _with(top(15, "* EXCLUDE (avg_amount)"), "by_merchant", double=spent)
    sql["rpt_7_top_merchants_20"] = _with(top(20, "*"), "by_merchant", double=spent)
    sql["rpt_7_top_merchants_10"] = _with(
        f"""SELECT merchant_name, category_name, {_sum()} AS total_spent, count(*) AS visits FROM by_merchant
            GROUP BY merchant_name, category_name ORDER BY total_spent DESC, merchant_name, category_name LIMIT 10""",
        "by_merchant", double=spent,
    )
    sql["rpt_8_weekend"] = _with(
        f"""SELECT is_weekend, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, {n},
                   {_sum()} AS total_amount, {_avg()} AS avg_amount FROM by_day GROUP BY is_weekend""",
        "by_day", double=_TOTAL,
    )
    sql["rpt_9_weekend_category"] = _with(
        f"""SELECT is_weekend, category_name, {_avg()} AS avg_amount, {n}
            FROM by_day JOIN dim_category USING (category_key) GROUP BY is_weekend, category_name""",
        "by_day",
    )
    sql["rpt_10_card"] = _with(
        f"""SELECT card_company, card_type, {n}, {_sum()} AS total_amount, {_avg()} AS avg_amount
            FROM fact JOIN dim_card USING (card_key) GROUP BY card_company, card_type""",
        "fact", double=_TOTAL,
    )
    sql["rpt_11_overall"] = _with(
        f"""SELECT count(*) AS total_transactions, {_sum()} AS total_spent, {_avg()} AS avg_transaction,
                   min(amount) AS min_transaction, max(amount) AS max_transaction,
                   round(stddev_samp(CAST(amount AS DOUBLE)), 2) AS std_transaction FROM fact""",
        "fact", double=("total_spent", "min_transaction", "max_transaction"),
    )
    daily = f"SELECT full_date, day_name, {n}, {_sum()} AS total_amount FROM by_day GROUP BY full_date, day_name"
    sql["rpt_12_daily_trend"] = _with(daily, "by_day", double=_TOTAL, text=("full_date",))
    sql["rpt_13_moving_average"] = _with(
        f"""SELECT full_date, day_name, txn_count, total_amount,
                   CASE WHEN place >= 7 THEN {_half_up(_cents('last_seven'), '700')} END AS moving_avg
            FROM (SELECT *, row_number() OVER (ORDER BY full_date) AS place,
                         sum(total_amount) OVER (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS last_seven
                  FROM ({daily}))""",
        "by_day", double=_TOTAL, text=("full_date",),
    )
    by_month_category = f"""SELECT d.year, d.month, d.month_name, c.level_1 AS category, {n}, {_sum()} AS total_amount
                            FROM by_day d JOIN dim_category c USING (category_key)"""
    group = "GROUP BY d.year, d.month, d.month_name, c.level_1"
    sql["rpt_14_monthly_category"] = _with(f"{by_month_category} {group}", "by_day", double=_TOTAL)
    sql["rpt_14_one_year"] = _with(f"{by_month_category} WHERE d.year = 1998 {group}", "by_day", double=_TOTAL)
    sql["rpt_15_month_report"] = _with(
        f"""SELECT d.month_name, c.level_1 AS category, c.level_2 AS subcategory, {n}, {_sum()} AS total_amount,
                   {_avg()} AS avg_amount, max(amount) AS max_amount
            FROM by_day d JOIN dim_category c USING (category_key) WHERE d.year = 1998 AND d.month = 3
            GROUP BY d.month_name, c.level_1, c.level_2""",
        "by_day", double=("total_amount", "max_amount"),
    )
    sql["rpt_16_year_on_year"] = _with(
        f"""SELECT m.year, m.month, m.total_amount, p.total_amount AS previous_amount,
                   {_percent('(m.total_amount - p.total_amount)', 'p.total_amount')} AS change_percent
            FROM months m LEFT JOIN months p ON p.year = m.year - 1 AND p.month = m.month""",
        "months", double=("total_amount", "previous_amount"),
    )
    for name, ahead, by in (("fct_1_trend", 3, ""), ("fct_1_trend_by_category", 2, "category, ")):
        per = "" if not by else "c.level_1 AS category, "
        spend = f"""SELECT {per}d.year, d.month, {_sum()} AS total_amount, d.year * 12 + d.month - 1 - 24000 AS x
                    FROM by_day d JOIN dim_category c USING (category_key) GROUP BY {'c.level_1, ' if by else ''}d.year, d.month"""
        same = "l.category = m.category" if by else "true"
        own = "m.category, " if by else ""
        line = f"""SELECT {by}regr_slope(CAST(total_amount AS DOUBLE), CAST(x AS DOUBLE)) AS slope,
                          regr_intercept(CAST(total_amount AS DOUBLE), CAST(x AS DOUBLE)) AS base, max(x) AS last
                   FROM ({spend}) {'GROUP BY category' if by else ''}"""
        sql[name] = _with(
            f"""SELECT {own}m.year, m.month, m.total_amount, round(base + slope * x, 2) AS trend, m.total_amount IS NULL AS is_forecast
                FROM (SELECT {by}year, month, CAST(total_amount AS DOUBLE) AS total_amount, x FROM ({spend})
                      UNION ALL
                      SELECT {by}{_int('(last + 24000 + i) // 12')}, {_int('(last + 24000 + i) % 12 + 1')}, NULL, last + i
                      FROM ({line}), (SELECT unnest(range(1, {ahead + 1})) AS i)) m
                JOIN ({line}) l ON {same}""",
            "by_day",
        )
    sql["cat_1_map"] = _with(
        """SELECT transaction_id, normalized_merchant, coalesce(n_name || ' ' || r_name, 'Uncategorized') AS assigned_category,
                  n_name IS NOT NULL AS is_mapped
           FROM silver LEFT JOIN (SELECT * FROM suppliers WHERE s_suppkey % 10 <> 9) ON normalized_merchant = s_name""",
        "silver", "suppliers",
    )
    sql["rpt_17_weekday"] = _with(
        f"""SELECT day_of_week, day_name, {n}, {_sum()} AS total_amount, {_avg()} AS avg_amount
            FROM by_day GROUP BY day_of_week, day_name""",
        "by_day", double=_TOTAL,
    )
    sql["rpt_18_time_of_day"] = _with(
        f"""SELECT CASE WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'noon' ELSE 'evening' END AS time_of_day,
                   {n}, {_sum("CAST(value AS DECIMAL(15,2))")} AS total_amount FROM events GROUP BY 1""",
        double=_TOTAL,
    )
    best = "row_number() OVER (PARTITION BY year ORDER BY total_amount"
    sql["rpt_19_peak_months"] = _with(
        f"""SELECT h.year, h.month AS peak_month, h.total_amount AS peak_amount, l.month AS trough_month,
                   l.total_amount AS trough_amount,
                   {_half_up(_cents('h.total_amount'), _cents('l.total_amount'))} AS peak_ratio
            FROM (SELECT *, {best} DESC, month) AS rn FROM months) h
            JOIN (SELECT *, {best}, month) AS rn FROM months) l ON h.year = l.year AND h.rn = 1 AND l.rn = 1""",
        "months", double=("peak_amount", "trough_amount"),
    )
    sql["rpt_20_merchant_share"] = _with(
        f"""SELECT merchant_name, total_amount, {_percent('total_amount', 'whole')} AS share_percent FROM (
              SELECT merchant_name, {_sum()} AS total_amount, (SELECT sum(amount) FROM fact) AS whole
              FROM by_merchant GROUP BY merchant_name)""",
        "by_merchant", double=_TOTAL,
    )
    sql["rpt_21_weekend_gap"] = _with(
        f"""SELECT {_half_up('100 * dn', '(dn + en)')} AS weekday_percent, {_half_up('100 * en', '(dn + en)')} AS weekend_percent,
                   {_half_up(_cents('ds'), '100 * dn')} AS weekday_avg, {_half_up(_cents('es'), '100 * en')} AS weekend_avg,
                   {_half_up(f"100 * ({_cents('es')} * dn - {_cents('ds')} * en)", f"({_cents('ds')} * en)")} AS avg_gap_percent
            FROM (SELECT CAST(count(*) FILTER (is_weekend) AS HUGEINT) AS en, sum(amount) FILTER (is_weekend) AS es,
                         CAST(count(*) FILTER (NOT is_weekend) AS HUGEINT) AS dn,
                         sum(amount) FILTER (NOT is_weekend) AS ds FROM by_day)""",
        "by_day",
    )

    # data quality
    sql["dq_1_required"] = _checks(
        "bronze", ("required_column", "transaction_id", "0"), ("required_column", "amount", "0"),
        ("required_column", "card_number", "1"),
    )
    cols = ("transaction_id", "transaction_date", "merchant_name", "amount")
    sql["dq_2_not_null"] = _with(_checks("bronze", *[("not_null", c, _nulls("raw_txn", c)) for c in cols]), "raw_txn")
    cols = ("transaction_id", "merchant_name")
    sql["dq_3_unique"] = _with(_checks("bronze", *[("unique", c, _copies("raw_txn", c)) for c in cols]), "raw_txn")
    sql["dq_4_range"] = _with(
        _checks("bronze", ("in_range", "amount", _outside("raw_txn", "amount", 1, 100000))), "raw_txn"
    )
    typed = f"(SELECT CASE WHEN merchant_name IS NOT NULL THEN {kind} END AS transaction_type, card_type FROM raw_txn)"
    sql["dq_5_allowed"] = _with(
        _checks(
            "silver",
            ("allowed_values", "transaction_type", _wrong(typed, "transaction_type", "'INCOME', 'EXPENSE'")),
            ("allowed_values", "card_type", _wrong(typed, "card_type", "'Debit'")),
        ),
        "raw_txn",
    )
    late = "(SELECT count(*) FROM silver WHERE transaction_date > DATE '2001-06-30')"
    sql["dq_6_foreign_keys"] = _with(
        _checks("gold_fact", ("foreign_key", "date_key", late), ("foreign_key", "merchant_key", "0"),
                ("foreign_key", "category_key", "0")),
        "silver",
    )
    asia = "(SELECT count(*) FROM silver WHERE merchant_category LIKE 'ASIA%')"
    sql["dq_6_referential"] = _with(
        _checks("fact_transactions", ("referential", "date_key", late), ("referential", "category_key", "0"),
                ("referential", "merchant_key", asia), ("referential", "card_key", "0")),
        "silver",
    )
    sql["dq_6_dangling_keys"] = _with(
        """SELECT 'merchant_key' AS column_name, merchant_key AS member, count(*) AS rows
           FROM fact JOIN dim_merchant USING (merchant_key) WHERE merchant_category LIKE 'ASIA%' GROUP BY merchant_key""",
        "fact",
    )
    sql["dq_7_date_key_range"] = _with(
        _checks("gold_fact", ("in_range", "date_key", _outside("fact", "date_key", 19950101, 20010630))), "fact"
    )
    sql["dq_8_dimension_keys"] = _with(
        " UNION ALL ".join(_checks(name, _dim_checks(name)[-1]) for name in _DIM_COLUMNS), "fact"
    )
    sql["dq_9_merchant_columns"] = _with(_checks("dim_merchant", *_dim_checks("dim_merchant")), "fact")
    wrong = ("amount", "created_at")
    sql["dq_10_column_types"] = _checks(
        "bronze",
        *[
            ("column_type", c, str(int(c in wrong)))
            for c in ("transaction_id", "transaction_date", "merchant_name", "merchant_category", "amount",
                      "card_number", "card_type", "card_company", "created_at")
        ],
    )
    sql["dq_11_reconcile"] = _with(
        """SELECT layer, row_count, expected_layer, expected_count, row_count - expected_count AS difference FROM (
             SELECT 'raw' AS layer, count(*) AS row_count, NULL AS expected_layer, NULL AS expected_count FROM raw_txn
             UNION ALL SELECT 'valid', count(*), 'raw', (SELECT count(*) FROM raw_txn) FROM valid
             UNION ALL SELECT 'silver', count(*), 'valid', (SELECT count(*) FROM valid) FROM silver
             UNION ALL SELECT 'fact', count(*), 'silver', (SELECT count(*) FROM silver) FROM fact)""",
        "fact",
    )
    percent = "round(count(*) FILTER (passed) * 100.0 / count(*), 2)"
    sql["dq_12_report"] = _with(
        f"""SELECT layer, bool_and(passed) AS success, count(*) AS checks, count(*) FILTER (passed) AS passed_checks,
                   {percent} AS success_percent,
                   coalesce(string_agg(check_name || ':' || column_name, ', ' ORDER BY check_name || ':' || column_name)
                     FILTER (NOT passed), '') AS failed_checks
            FROM ({_ALL_CHECKS}) GROUP BY layer""",
        "fact",
    )
    sql["dq_13_all_layers"] = _with(_ALL_CHECKS, "fact")
    sql["dq_13_during_write"] = _with(
        f"SELECT * FROM ({_ALL_CHECKS}) WHERE check_name <> 'unique' OR layer NOT IN ('bronze', 'silver', 'fact_transactions')", "fact"
    )
    more = [("referential", key, "0") for key in ("date_key", "category_key", "merchant_key", "card_key")]
    history = _checks("dim_merchant", ("scd2_integrity", "merchant_name", "0"))
    sql["dq_13_whole_star"] = _with(f"{_ALL_CHECKS} UNION ALL {_checks('fact_transactions', *more)} UNION ALL {history}", "fact")
    sql["dq_14_success_percent"] = _with(
        f"SELECT bool_and(passed) AS all_passed, count(*) AS checks, {percent} AS success_percent FROM ({_ALL_CHECKS})",
        "fact",
    )
    sql["dq_15_scd2_integrity"] = _with(
        """SELECT s_name AS merchant_name, CAST(2 AS BIGINT) AS open_versions, CAST(1 AS BIGINT) AS overlaps,
                  CAST(0 AS BIGINT) AS empty_intervals FROM suppliers WHERE s_suppkey % 10 = 0""",
        "suppliers",
    )
    sql["dq_15_scd2_clean"] = """SELECT s_name AS merchant_name, CAST(1 AS BIGINT) AS open_versions,
        CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS empty_intervals FROM supplier WHERE false"""
    return sql
