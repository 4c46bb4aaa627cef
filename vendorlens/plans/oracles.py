"""The registered queries as SQL over the same test tables, for an independent check.

Each statement starts from the raw tables as common table expressions, so it stands
alone. They are written for a single-node SQL engine and share no code with the
operators.
"""

from __future__ import annotations

from .queries import SMALL_PRODUCT, VENDOR
from .workspace import REDELIVERED

# --- raw tables -------------------------------------------------------------------

_RAW = {
    "part_": """
        SELECT p_partkey AS Brand, p_name || ' ' || p_partkey || ' ' AS Description,
               (p_size * 50)::VARCHAR || 'mL' AS Size, (p_size * 50)::VARCHAR AS Volume,
               CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 2 END AS Classification,
               p_retailprice::DECIMAL(18,2) AS ListPrice,
               CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_retailprice::DECIMAL(18,2) END::DECIMAL(18,2) AS PurchasePrice
        FROM part""",
    "vendor_": "SELECT s_suppkey AS Vendor, s_name || '   ' AS VendorName FROM supplier",
    "purchases": """
        SELECT (l_orderkey % 80) || '_' || Vendor || '_' || Brand AS InventoryId,
               l_orderkey % 80 AS Store, Brand, Description, Size, Vendor AS VendorNumber, VendorName,
               l_orderkey AS PONumber, o_orderdate::DATE AS PODate, l_shipdate::DATE AS ReceivingDate,
               l_shipdate::DATE + 7 AS InvoiceDate, l_shipdate::DATE + 37 AS PayDate, PurchasePrice,
               l_quantity::BIGINT AS Quantity, (l_quantity::BIGINT * ListPrice)::DECIMAL(18,2) AS Dollars,
               Classification
        FROM lineitem JOIN part_ ON l_partkey = Brand JOIN vendor_ ON l_suppkey = Vendor
        JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'""",
    "sales": """
        SELECT (l_orderkey % 80) || '_' || Vendor || '_' || Brand AS InventoryId,
               l_orderkey % 80 AS Store, Brand, Description, Size,
               (l_linenumber * 5)::BIGINT AS SalesQuantity,
               (l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(3,2)))::DECIMAL(18,2) AS SalesDollars,
               l_extendedprice::DECIMAL(18,2) AS SalesPrice, l_shipdate::DATE AS SalesDate, Volume, Classification,
               (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(3,2))::DECIMAL(18,2) AS ExciseTax,
               Vendor AS VendorNo, VendorName
        FROM lineitem JOIN part_ ON l_partkey = Brand JOIN vendor_ ON l_suppkey = Vendor
        WHERE l_linestatus = 'O'""",
    "purchase_prices": """
        SELECT Brand, Description, (ListPrice * 1.4::DECIMAL(3,1))::DECIMAL(18,2) AS Price, Size, Volume,
               Classification, PurchasePrice, Brand % (SELECT count(*) FROM supplier) AS VendorNumber, VendorName
        FROM part_ LEFT JOIN vendor_ ON Brand % (SELECT count(*) FROM supplier) = Vendor""",
    "vendor_invoice": """
        SELECT VendorNumber, VendorName, max(InvoiceDate) AS InvoiceDate, PONumber, PODate, max(PayDate) AS PayDate,
               sum(Quantity)::BIGINT AS Quantity, sum(Dollars)::DECIMAL(18,2) AS Dollars,
               (sum(Dollars)::DECIMAL(18,2) * 0.005::DECIMAL(4,3))::DECIMAL(18,2) AS Freight, NULL::VARCHAR AS Approval
        FROM purchases GROUP BY VendorNumber, VendorName, PONumber, PODate""",
    "begin_inventory": """
        SELECT r_regionkey || '_' || r_name || '_' || Brand AS InventoryId, r_regionkey AS Store, r_name AS City, Brand,
               Description, Size, (Brand * 7 + r_regionkey * 13) % 100 AS onHand, ListPrice AS Price,
               DATE '2024-01-01' AS startDate
        FROM part_ CROSS JOIN region""",
    "end_inventory": """
        SELECT r_regionkey || '_' || r_name || '_' || Brand AS InventoryId, r_regionkey AS Store, r_name AS City, Brand,
               Description, Size, (Brand * 11 + r_regionkey * 17) % 100 AS onHand, ListPrice AS Price,
               DATE '2024-12-31' AS endDate
        FROM part_ CROSS JOIN region""",
}

_RAW_NAMES = ["sales", "purchases", "purchase_prices", "vendor_invoice", "begin_inventory", "end_inventory"]

_TWICE = {
    f"{name}_twice": f"SELECT * FROM {name} UNION ALL SELECT * FROM {name} WHERE {REDELIVERED[name]}"
    for name in _RAW_NAMES
}

# --- summary, clean rows, mart ------------------------------------------------------

_SUMMARY = {
    "freight": "SELECT VendorNumber, sum(Freight)::DOUBLE AS FreightCost FROM vendor_invoice GROUP BY VendorNumber",
    "priced": """
        SELECT * FROM purchases JOIN (SELECT Brand, Price AS ActualPrice, Volume FROM purchase_prices) USING (Brand)
        WHERE PurchasePrice > 0""",
    "bought": """
        SELECT VendorNumber, VendorName, Brand, Description, PurchasePrice::DOUBLE AS PurchasePrice,
               ActualPrice::DOUBLE AS ActualPrice, Volume, sum(Quantity)::BIGINT AS TotalPurchaseQuantity,
               sum(Dollars)::DOUBLE AS TotalPurchaseDollars
        FROM priced GROUP BY ALL""",
    "sold": """
        SELECT VendorNo, Brand, sum(SalesQuantity)::BIGINT AS TotalSalesQuantity,
               sum(SalesDollars)::DOUBLE AS TotalSalesDollars, sum(SalesPrice)::DOUBLE AS TotalSalesPrice,
               sum(ExciseTax)::DOUBLE AS TotalExciseTax
        FROM sales GROUP BY ALL""",
    "summary": """
        SELECT * RENAME (Description AS BrandName)
        FROM bought LEFT JOIN (SELECT * RENAME (VendorNo AS VendorNumber) FROM sold) USING (VendorNumber, Brand)
        LEFT JOIN freight USING (VendorNumber)""",
    "clean": r"""
        SELECT VendorNumber, regexp_replace(VendorName, '^\s+|\s+$', '', 'g') AS VendorName, Brand,
               regexp_replace(BrandName, '^\s+|\s+$', '', 'g') AS BrandName, PurchasePrice, ActualPrice,
               coalesce(Volume::DOUBLE, 0) AS Volume, TotalPurchaseQuantity, TotalPurchaseDollars,
               coalesce(TotalSalesQuantity, 0) AS TotalSalesQuantity, coalesce(TotalSalesDollars, 0) AS TotalSalesDollars,
               coalesce(TotalSalesPrice, 0) AS TotalSalesPrice, coalesce(TotalExciseTax, 0) AS TotalExciseTax,
               coalesce(FreightCost, 0) AS FreightCost
        FROM summary""",
    "features": """
        SELECT *, TotalSalesDollars - TotalPurchaseDollars AS GrossProfit,
               CASE WHEN TotalSalesDollars <> 0
                    THEN (TotalSalesDollars - TotalPurchaseDollars) / TotalSalesDollars * 100 ELSE 0 END AS ProfitMargin,
               CASE WHEN TotalPurchaseQuantity <> 0
                    THEN TotalSalesQuantity::DOUBLE / TotalPurchaseQuantity ELSE 0 END AS StockTurnover,
               CASE WHEN TotalPurchaseDollars <> 0
                    THEN TotalSalesDollars / TotalPurchaseDollars ELSE 0 END AS SalestoPurchaseRatio
        FROM clean""",
}

_DOUBLES = [
    "PurchasePrice", "ActualPrice", "Volume", "TotalPurchaseDollars", "TotalSalesDollars", "TotalSalesPrice",
    "TotalExciseTax", "FreightCost", "GrossProfit", "ProfitMargin", "StockTurnover", "SalestoPurchaseRatio",
]
_INTEGERS = ["VendorNumber", "Brand", "TotalPurchaseQuantity", "TotalSalesQuantity"]
_NUMBERS = _INTEGERS + _DOUBLES


def _cents(expression: str) -> str:
    return f"round_even({expression} * 100, 0) / 100"


def _exact(expression: str) -> str:
    """Order-independent sum of amounts with two decimals."""
    return f"coalesce(sum({expression}::DECIMAL(18,2))::DOUBLE, 0)"


_MART = {
    "mart": "SELECT * REPLACE (" + ", ".join(f"{_cents(c)} AS {c}" for c in _DOUBLES) + ") FROM features",
    "good": "SELECT * FROM mart WHERE GrossProfit > 0 AND ProfitMargin > 0 AND TotalSalesQuantity > 0",
}


def _long(source: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value FROM {source}" for c in columns]
    return " UNION ALL ".join(parts)


_ANALYSIS = {
    "brands": f"""
        SELECT BrandName, {_exact('TotalSalesDollars')} AS TotalSalesDollars,
               sum(ProfitMargin::DECIMAL(18,2))::DOUBLE / count(ProfitMargin) AS ProfitMargin
        FROM good WHERE BrandName IS NOT NULL GROUP BY BrandName""",
    "bounds": """
        SELECT quantile_cont(TotalSalesDollars, 0.15) AS low_sales, quantile_cont(ProfitMargin, 0.85) AS high_margin
        FROM brands""",
    "targets": """
        SELECT brands.* FROM brands, bounds
        WHERE TotalSalesDollars <= low_sales AND ProfitMargin >= high_margin""",
    "vendors": f"""
        SELECT VendorName, {_exact('TotalPurchaseDollars')} AS p, {_exact('GrossProfit')} AS g,
               {_exact('TotalSalesDollars')} AS s
        FROM good WHERE VendorName IS NOT NULL GROUP BY VendorName""",
    "contribution": f"""
        SELECT VendorName, {_cents('p')} AS TotalPurchaseDollars, {_cents('g')} AS GrossProfit,
               {_cents('s')} AS TotalSalesDollars,
               {_cents('(p / (SELECT ' + _exact('TotalPurchaseDollars') + ' FROM good) * 100)')} AS PurchaseContribution,
               row_number() OVER (ORDER BY p DESC, VendorName) AS place
        FROM vendors""",
    "thirds": """
        SELECT quantile_cont(TotalPurchaseQuantity, 1/3.0::DOUBLE) AS a,
               quantile_cont(TotalPurchaseQuantity, 2/3.0::DOUBLE) AS b FROM good""",
    "sized": """
        SELECT CASE WHEN TotalPurchaseQuantity <= a THEN 'Small' WHEN TotalPurchaseQuantity <= b THEN 'Medium'
               ELSE 'Large' END AS OrderSize,
               TotalPurchaseDollars / nullif(TotalPurchaseQuantity, 0) AS UnitPurchasePrice
        FROM good, thirds""",
    "quarter": """
        SELECT quantile_cont(TotalSalesDollars, 0.25) AS q25, quantile_cont(TotalSalesDollars, 0.75) AS q75 FROM good""",
    "groups": """
        SELECT 'top' AS "column", ProfitMargin AS value FROM good, quarter WHERE TotalSalesDollars >= q75
        UNION ALL
        SELECT 'low', ProfitMargin FROM good, quarter WHERE TotalSalesDollars <= q25""",
    "margins": "SELECT 'ProfitMargin' AS \"column\", ProfitMargin AS value FROM good",
    "numbers": _long("mart", _NUMBERS),
    "good_numbers": _long("good", _NUMBERS),
    "unit_prices": 'SELECT OrderSize AS "column", UnitPurchasePrice AS value FROM sized WHERE UnitPurchasePrice IS NOT NULL',
    "moments": """
        SELECT "column", count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS mean,
               stddev_samp(value) AS std, var_samp(value) AS var FROM groups GROUP BY "column\"""",
    "welch": """
        SELECT (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS t,
               (a.var / a.n + b.var / b.n) ** 2
               / ((a.var / a.n) ** 2 / (a.n - 1) + (b.var / b.n) ** 2 / (b.n - 1)) AS df
        FROM moments a, moments b WHERE a."column" = 'top' AND b."column" = 'low'""",
}

_ALL = {**_RAW, **_TWICE, **_SUMMARY, **_MART, **_ANALYSIS}


def _with(body: str, **extra: str) -> str:
    """``body`` after the named expressions it needs, and those they need."""
    named = {**_ALL, **extra}
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in named:
            if name in words and name not in needed:
                needed.add(name)
                visit(named[name])

    visit(body)
    ctes = ",\n".join(f"{n} AS ({named[n].strip()})" for n in named if n in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


# --- pieces -------------------------------------------------------------------------


def _label(column: str) -> str:
    """The dollar label of an amount."""
    return (
        f"CASE WHEN {column} >= 1000000 THEN format('{{:.2f}}M', {column} / 1000000.0::DOUBLE) "
        f"WHEN {column} >= 1000 THEN format('{{:.2f}}K', {column} / 1000.0::DOUBLE) ELSE {column}::VARCHAR END"
    )


def _doubles(source: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in columns)}) FROM {source}"


_MONEY = {
    "sales": ("SalesDollars", "SalesPrice", "ExciseTax"),
    "purchases": ("PurchasePrice", "Dollars"),
    "purchase_prices": ("Price", "PurchasePrice"),
    "vendor_invoice": ("Dollars", "Freight"),
    "begin_inventory": ("Price",),
    "end_inventory": ("Price",),
}


def _nulls(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM {source}" for c in columns
    )


_SUMMARY_COLUMNS = [
    "VendorNumber", "VendorName", "Brand", "BrandName", "PurchasePrice", "ActualPrice", "Volume",
    "TotalPurchaseQuantity", "TotalPurchaseDollars", "TotalSalesQuantity", "TotalSalesDollars",
    "TotalSalesPrice", "TotalExciseTax", "FreightCost",
]
_MART_COLUMNS = _SUMMARY_COLUMNS + ["GrossProfit", "ProfitMargin", "StockTurnover", "SalestoPurchaseRatio"]


def _mode(column: str, kind: str) -> str:
    number, text = ("m", "NULL::VARCHAR") if kind == "number" else ("NULL::DOUBLE", "m")
    cast = "::DOUBLE" if kind == "number" else ""
    return (
        f"SELECT '{column}' AS \"column\", {number} AS number, {text} AS text FROM (SELECT {column}{cast} AS m FROM mart "
        f"WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


_EXTENT = """
    SELECT "column", CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
           CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi,
           count(*) AS n, stddev_samp(value) AS std
    FROM {source} GROUP BY "column\""""

_BINS = """
    SELECT "column", i AS bin, i * ((hi - lo) / 30) + lo AS a,
           CASE WHEN i = 29 THEN hi ELSE (i + 1) * ((hi - lo) / 30) + lo END AS b
    FROM extent, (SELECT unnest(range(30))::INTEGER AS i)"""


def _histogram(source: str) -> str:
    return _with(
        f"""
        SELECT bins."column", bin, round(a, 6) AS bin_start, round(b, 6) AS bin_end, count(value) AS count
        FROM bins LEFT JOIN {source} v ON v."column" = bins."column" AND value >= a
             AND (value < b OR (bin = 29 AND value = b))
        GROUP BY bins."column", bin, a, b""",
        extent=_EXTENT.format(source=source), bins=_BINS,
    )


_CURVE = """
    SELECT "column", i AS point, n, (hi - lo) / 30 AS step, std * n ** -0.2 AS h,
           CASE WHEN i = 199 THEN hi ELSE i * ((hi - lo) / 199) + lo END AS x
    FROM extent, (SELECT unnest(range(200))::INTEGER AS i) WHERE std > 0"""


def _density(source: str) -> str:
    return _with(
        """
        SELECT curve."column", point, round(x, 6) AS x,
               round(sum(copies * exp(-0.5 * ((x - value) / h) ** 2)) / (h * sqrt(2 * pi())) * step, 6) AS density
        FROM curve JOIN points v ON v."column" = curve."column"
        GROUP BY curve."column", point, x, step, h""",
        points=f'SELECT "column", value, count(*) AS copies FROM {source} GROUP BY "column", value',
        extent=_EXTENT.format(source=source), curve=_CURVE,
    )


def _boxplot(source: str) -> str:
    return _with(
        """
        SELECT "column", round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
               round(least(min(value) FILTER (value >= q25 - (q75 - q25) * 1.5), q25), 6) AS whisker_low,
               round(greatest(max(value) FILTER (value <= q75 + (q75 - q25) * 1.5), q75), 6) AS whisker_high,
               count(*) FILTER (value < q25 - (q75 - q25) * 1.5 OR value > q75 + (q75 - q25) * 1.5) AS outliers
        FROM points JOIN quart USING ("column") GROUP BY "column", q25, q50, q75""",
        points=f"SELECT * FROM {source}",
        quart="""
            SELECT "column", quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
                   quantile_cont(value, 0.75) AS q75 FROM points GROUP BY "column\"""",
    )


# Student t by numeric integration: density, then Simpson panels of width ``w``.
_T_PDF = (
    "exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2) - 0.5 * ln({v} * pi()) - ({v} + 1) / 2 * ln(1 + ({t}) ** 2 / {v}))"
)


def _panels(source: str, width: str, count: int) -> str:
    """Area under the density from 0 up to each panel's start, per row of ``source``."""
    f = {k: _T_PDF.format(v="v", t=t) for k, t in {"a": "i * w", "m": "(i + 0.5) * w", "b": "(i + 1) * w"}.items()}
    return f"""
        SELECT *, coalesce(sum(area) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT *, w / 6 * ({f['a']} + 4 * {f['m']} + {f['b']}) AS area
              FROM (SELECT id, v, {width} AS w, i FROM {source}, (SELECT unnest(range({count}))::DOUBLE AS i)))"""


_MARGIN_CI = _with(
    f"""
    SELECT "column", n, round(mean, 6) AS mean, round(mean - t * std / sqrt(n), 6) AS lower,
           round(mean + t * std / sqrt(n), 6) AS upper
    FROM moments JOIN critical ON "column" = id""",
    freedom='SELECT "column" AS id, (n - 1)::DOUBLE AS v FROM moments',
    panels=_panels("freedom", "0.0005", 40_000),
    crossing=f"""
        SELECT id, v, i * w AS t0, 0.475 - before AS rest, {_T_PDF.format(v='v', t='i * w')} AS f0
        FROM panels WHERE before <= 0.475 AND before + area > 0.475""",
    critical=f"SELECT id, t0 + rest / ({_T_PDF.format(v='v', t='t0 + rest / f0 / 2')}) AS t FROM crossing",
)

_WELCH_TEST = _with(
    """
    SELECT round(t, 6) AS t, round(df, 6) AS df, round(p, 6) AS p, p < 0.05 AS reject
    FROM welch, (SELECT greatest(1 - 2 * sum(area), 0) AS p FROM panels)""",
    freedom="SELECT 0 AS id, df AS v, least(abs(t), 50) AS reach FROM welch",
    panels=_panels("freedom", "reach / 20000", 20_000),
)


def _correlation() -> str:
    cells = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS r "
        f"FROM (SELECT corr({a}, {b}) AS r FROM good)"
        for a in _NUMBERS for b in _NUMBERS
    ]
    return _with(" UNION ALL ".join(cells))


def _top(key: str) -> str:
    return _with(f"""
        SELECT {key}, t AS TotalSalesDollars, {_label('t')} AS Sales
        FROM (SELECT {key}, {_exact('TotalSalesDollars')} AS t FROM good WHERE {key} IS NOT NULL GROUP BY {key})
        ORDER BY t DESC, {key} LIMIT 10""")


def _top_counts(key: str) -> str:
    return _with(f"""
        SELECT {key}, count(*) AS row_count FROM good WHERE {key} IS NOT NULL GROUP BY {key}
        ORDER BY row_count DESC, {key} LIMIT 10""")


_UNSOLD = "((TotalPurchaseQuantity - TotalSalesQuantity)::DECIMAL(18,0) * PurchasePrice::DECIMAL(18,2))"

_DRILL = {
    "vendor_drilldown_purchases": ("purchases", "VendorNumber"),
    "vendor_drilldown_sales": ("sales", "VendorNo"),
    "vendor_drilldown_prices": ("purchase_prices", "VendorNumber"),
    "vendor_drilldown_invoices": ("vendor_invoice", "VendorNumber"),
}


def oracles() -> dict[str, str]:
    sql = {
        "refresh_mart": "SELECT * FROM mart",
        "vendor_sales_summary": """
            SELECT * REPLACE (TotalSalesQuantity::BIGINT AS TotalSalesQuantity)
            FROM summary ORDER BY TotalPurchaseDollars DESC""",
        "refresh_added_rows": "SELECT * FROM mart",
        "database_tables": """
            SELECT 'clean_data' AS table_name, count(*) AS row_count FROM clean
            UNION ALL SELECT 'vendor_sales_summary', count(*) FROM mart""",
        "appended_mart": "SELECT * FROM mart",
        "sql_over_tables": """
            SELECT VendorNumber, count(*) AS row_count, sum(Quantity)::BIGINT AS quantity, sum(Dollars)::DOUBLE AS dollars
            FROM purchases WHERE Brand IN (SELECT Brand FROM purchase_prices WHERE Classification = 1) GROUP BY VendorNumber""",
        "inferred_csv": """
            SELECT count(*) AS row_count, sum(Quantity)::BIGINT AS quantity, max(PODate)::VARCHAR AS last,
                   round(sum(Dollars)::DOUBLE, 2) AS dollars,
                   'Brand int,Classification int,Description string,Dollars double,InventoryId string,InvoiceDate date,PODate date,'
                   || 'PONumber int,PayDate date,PurchasePrice double,Quantity int,ReceivingDate date,Size string,Store int,'
                   || 'VendorName string,VendorNumber int' AS kinds
            FROM purchases""",
        "rejected_volumes_planted": """
            SELECT count(*) FILTER (Volume IS NOT NULL AND TRY_CAST(Volume AS DOUBLE) IS NULL) AS rejected
            FROM (SELECT CASE WHEN Brand % 10 = 0 THEN Volume || 'mL' ELSE Volume END AS Volume FROM summary)""",
        "key_violations_mart_key": f"""
            SELECT VendorNumber, Brand, count(*) AS row_count
            FROM (SELECT DISTINCT VendorNumber, VendorName, Brand, Description, PurchasePrice, l.Price, l.Volume
                  FROM purchases JOIN (
                      SELECT Brand, Price, Volume FROM purchase_prices
                      UNION ALL SELECT Brand, (Price + 1)::DECIMAL(18,2), Volume FROM purchase_prices
                      WHERE {REDELIVERED['purchase_prices']}) l USING (Brand)
                  WHERE PurchasePrice > 0)
            GROUP BY VendorNumber, Brand HAVING count(*) > 1""",
        "clean_summary": "SELECT * FROM clean",
        "rejected_volumes": """SELECT count(*) FILTER (Volume IS NOT NULL AND TRY_CAST(Volume AS DOUBLE) IS NULL) AS rejected
            FROM summary""",
        "vendor_features": "SELECT * FROM mart",
        "notebook_features": """
            SELECT clean.* , coalesce(g, 0) AS GrossProfit,
                   coalesce(CASE WHEN s <> 0 THEN g / s * 100 END, 0) AS ProfitMargin,
                   coalesce(q::DOUBLE / nullif(TotalPurchaseQuantity, 0), 0) AS StockTurnover,
                   coalesce(s / nullif(TotalPurchaseDollars, 0), 0) AS SalestoPurchaseRatio
            FROM clean JOIN (
                SELECT VendorNumber AS vn, Brand AS br, TotalSalesDollars AS s, TotalSalesQuantity AS q,
                       TotalSalesDollars - TotalPurchaseDollars AS g FROM summary)
            ON VendorNumber = vn AND Brand = br""",
        "freight_summary": "SELECT * FROM freight",
        "purchase_price_join": """
            SELECT VendorNumber, Brand, PONumber, PurchasePrice::DOUBLE AS PurchasePrice, Quantity,
                   Dollars::DOUBLE AS Dollars, ActualPrice::DOUBLE AS ActualPrice, Volume
            FROM priced""",
        "purchase_summary": "SELECT * FROM bought ORDER BY TotalPurchaseDollars",
        "sales_summary": "SELECT * FROM sold",
        "purchases_by_brand_price": """
            SELECT Brand, PurchasePrice::DOUBLE AS PurchasePrice, sum(Quantity)::BIGINT AS Quantity,
                   sum(Dollars)::DOUBLE AS Dollars
            FROM purchases GROUP BY Brand, purchases.PurchasePrice""",
        "purchases_by_po": """
            SELECT PONumber, sum(Quantity)::BIGINT AS Quantity, sum(Dollars)::DOUBLE AS Dollars
            FROM purchases GROUP BY PONumber""",
        "sales_by_brand": """
            SELECT Brand, sum(SalesQuantity)::BIGINT AS SalesQuantity, sum(SalesDollars)::DOUBLE AS SalesDollars,
                   sum(SalesPrice)::DOUBLE AS SalesPrice, sum(ExciseTax)::DOUBLE AS ExciseTax
            FROM sales GROUP BY Brand""",
        "table_counts": " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _RAW_NAMES
        ),
        "table_preview": _doubles("vendor_invoice", *_MONEY["vendor_invoice"])
        + " ORDER BY VendorNumber, PONumber, PODate LIMIT 5",
        "po_distinct": "SELECT count(DISTINCT PONumber) AS po_numbers FROM vendor_invoice",
        "distinct_volume": "SELECT DISTINCT Volume FROM summary",
        "distinct_vendor_names": "SELECT DISTINCT VendorName FROM summary",
        "distinct_brand_names": "SELECT DISTINCT BrandName FROM summary",
        "volume_residue": "SELECT DISTINCT regexp_replace(Volume, '[0-9]', '', 'g') AS residue FROM summary",
        "null_profile": _nulls("summary", _SUMMARY_COLUMNS),
        "null_profile_clean": _nulls("clean", _SUMMARY_COLUMNS),
        "column_profile": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", "
            f"'{'string' if c.endswith('Name') else 'bigint' if c in _INTEGERS else 'double'}' AS type, "
            f"count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls FROM mart"
            for c in _MART_COLUMNS
        ),
        "surrogate_key": "SELECT count(*) AS row_count, count(*) AS ids FROM sales",
        "dense_key": "SELECT count(*) AS row_count, count(*) AS ids, 1::BIGINT AS lowest, count(*) AS highest FROM sales",
        "sales_duplicates": _doubles("dup", *_MONEY["sales"]),
        **{f"dedupe_{n}": _doubles(f"(SELECT DISTINCT * FROM {n}_twice)", *_MONEY[n]) for n in _RAW_NAMES},
        "remaining_duplicates": " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) - count(DISTINCT x) AS remaining_duplicates "
            f"FROM (SELECT DISTINCT {n}_twice AS x FROM {n}_twice )"
            for n in _RAW_NAMES
        ),
        "first_invoice_of_po": _doubles(
            "(SELECT * FROM vendor_invoice QUALIFY row_number() OVER (PARTITION BY PONumber ORDER BY VendorNumber, PODate) = 1)",
            *_MONEY["vendor_invoice"],
        ),
        "surplus_copies": " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) - count(DISTINCT x) AS surplus "
            f"FROM (SELECT {n}_twice AS x FROM {n}_twice)"
            for n in _RAW_NAMES
        ),
        "key_violations": """
            SELECT PONumber, count(*) AS row_count FROM vendor_invoice GROUP BY PONumber HAVING count(*) > 1""",
        "key_violations_prices": """
            SELECT VendorNumber, Brand, count(*) AS row_count FROM purchase_prices_twice
            GROUP BY VendorNumber, Brand HAVING count(*) > 1""",
        "key_violations_mart": """
            SELECT VendorName, Volume, count(*) AS row_count FROM mart GROUP BY VendorName, Volume HAVING count(*) > 1""",
        "csv_round_trip": _doubles("vendor_invoice", *_MONEY["vendor_invoice"]),
        "stream_ingest": "SELECT *, (SELECT count(*) FROM purchase_prices) AS added FROM ("
        + _doubles("purchase_prices", *_MONEY["purchase_prices"]) + ")",
        "profitable_rows": "SELECT * FROM good",
        "loss_rows": "SELECT * FROM mart WHERE GrossProfit < 0",
        "brand_performance": "SELECT * FROM brands",
        "target_brands": "SELECT * FROM targets ORDER BY TotalSalesDollars",
        "brand_scatter_points": f"""
            SELECT 'All Brands' AS series, brands.*, round(low_sales, 6) AS low_sales, round(high_margin, 6) AS high_margin
            FROM brands, bounds WHERE TotalSalesDollars < {SMALL_PRODUCT}
            UNION ALL
            SELECT 'Target Brands', targets.*, round(low_sales, 6), round(high_margin, 6) FROM targets, bounds""",
        "vendor_contribution": "SELECT * EXCLUDE (place) FROM contribution ORDER BY place",
        "formatted_contributors": f"""
            SELECT VendorName, {_label('TotalPurchaseDollars')} AS TotalPurchaseDollars,
                   {_label('GrossProfit')} AS GrossProfit, {_label('TotalSalesDollars')} AS TotalSalesDollars,
                   PurchaseContribution
            FROM contribution WHERE place <= 10""",
        "vendor_pareto": """
            SELECT * EXCLUDE (place),
                   sum(PurchaseContribution::DECIMAL(10,2)) OVER (ORDER BY place)::DOUBLE AS CumulativeContribution
            FROM contribution WHERE place <= 10""",
        "vendor_dependence": """
            SELECT VendorName, PurchaseContribution FROM contribution WHERE place <= 10
            UNION ALL
            SELECT 'Other Vendors', (100 - sum(PurchaseContribution::DECIMAL(10,2)))::DOUBLE
            FROM contribution WHERE place <= 10""",
        "order_size_unit_price": """
            SELECT OrderSize, round(avg(UnitPurchasePrice), 6) AS UnitPurchasePrice, count(*) AS row_count
            FROM sized GROUP BY OrderSize""",
        "low_turnover_vendors": """
            SELECT VendorName, sum(StockTurnover::DECIMAL(18,2))::DOUBLE / count(*) AS StockTurnover
            FROM good WHERE StockTurnover < 1 AND VendorName IS NOT NULL GROUP BY VendorName
            ORDER BY 2, 1 LIMIT 10""",
        "unsold_capital": f"""
            SELECT VendorName, u AS UnsoldInventoryValue, {_label('u')} AS UnsoldCapital
            FROM (SELECT VendorName, sum({_UNSOLD})::DOUBLE AS u FROM good WHERE VendorName IS NOT NULL GROUP BY VendorName)
            ORDER BY u DESC, VendorName LIMIT 10""",
        "total_unsold_capital": f"""
            SELECT u AS UnsoldInventoryValue, {_label('u')} AS UnsoldCapital
            FROM (SELECT sum({_UNSOLD})::DOUBLE AS u FROM good )""",
        "formatted_dollars": f"""
            SELECT VendorNumber, Brand, PurchasePrice, {_label('TotalPurchaseDollars')} AS TotalPurchaseDollars,
                   {_label('TotalSalesDollars')} AS TotalSalesDollars, {_label('GrossProfit')} AS GrossProfit
            FROM mart""",
        "describe_mart": """
            SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
                   min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
                   round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
                   max(value) AS max
            FROM numbers GROUP BY "column\"""",
        "mode_mart": " UNION ALL ".join(
            [_mode(c, "number") for c in _NUMBERS] + [_mode(c, "text") for c in ("VendorName", "BrandName")]
        ),
        "sales_quantiles": " UNION ALL ".join(
            f"SELECT {p}::DOUBLE AS p, round(quantile_cont(TotalSalesDollars, {p}), 6) AS quantile FROM good"
            for p in (0.15, 0.25, 0.5, 0.75, 0.85)
        ),
        "quartiles_bracketed": " UNION ALL ".join(
            f"SELECT \"column\", {p}::DOUBLE AS p, round(quantile_cont(value, {p}), 6) AS quantile "
            'FROM numbers GROUP BY "column"'
            for p in (0.25, 0.5, 0.75)
        ),
        "margin_ci_stats": 'SELECT "column", n, round(mean, 6) AS mean, round(std, 6) AS std FROM moments',
        "welch_stats": "SELECT round(t, 6) AS t, round(df, 6) AS df FROM welch",
    }
    for name, (table, key) in _DRILL.items():
        sql[name] = _doubles(table, *_MONEY[table]) + f" WHERE {key} = {VENDOR}"
    dup = """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sales_twice) AS rank_ FROM sales_twice ) WHERE rank_ > 1"""
    return {
        **{name: _with(body, dup=dup) for name, body in sql.items()},
        "top_vendors": _top("VendorName"),
        "top_brands": _top("BrandName"),
        "top_vendor_counts": _top_counts("VendorName"),
        "top_brand_counts": _top_counts("BrandName"),
        "correlation_matrix": _correlation(),
        "histogram_margin": _histogram("margins"),
        "histogram_margin_groups": _histogram("groups"),
        "histogram_all": _histogram("numbers"),
        "histogram_profitable": _histogram("good_numbers"),
        "density_all": _density("numbers"),
        "density_margin": _density("margins"),
        "density_margin_groups": _density("groups"),
        "boxplot_stats": _boxplot("numbers"),
        "boxplot_unit_price": _boxplot("unit_prices"),
        "margin_ci": _MARGIN_CI,
        "welch_ttest": _WELCH_TEST,
    }
