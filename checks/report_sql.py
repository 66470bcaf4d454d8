"""SQL for the questions asked of gold, told from the flat view.

``sold`` is every dated fact with its product and segment. Sums by group fill a table of
``cells`` (a week and a group); the cells of a group are numbered by week, and what a cell
looks back to is the one so many numbers before it.
"""

from checks.registry import END, START

RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"
HIDDEN = "('Other', 'Unknown', 'Uncategorized')"
SOLD = "(SELECT * FROM flat WHERE date IS NOT NULL AND pln IN (SELECT pln_id FROM dim_product))"


def growth_pct(now: str, before: str) -> str:
    return f"coalesce(({now} - {before}) / nullif({before}, 0) * 100, 0.0)"


def cells(column: str, hidden: bool = False) -> str:
    kept = f"{column} NOT IN {HIDDEN}" if hidden else "TRUE"
    return f"""SELECT date, {column} AS grp, sum(actual) AS current_sales,
    coalesce(sum(actual) FILTER (promo = 'Y'), 0.0) AS promo_sales FROM {SOLD} sold WHERE {kept} GROUP BY ALL"""


def cells_with_past(column: str, hidden: bool = False) -> str:
    return f"""SELECT now.*, week.current_sales AS prev_week_sales, year.current_sales AS prev_year_sales
  FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY date) AS place FROM ({cells(column, hidden)}) c) AS now
  LEFT JOIN (SELECT grp, current_sales, row_number() OVER (PARTITION BY grp ORDER BY date) + 1 AS place
             FROM ({cells(column, hidden)}) c) AS week
    ON week.place = now.place AND week.grp IS NOT DISTINCT FROM now.grp
  LEFT JOIN (SELECT grp, current_sales, row_number() OVER (PARTITION BY grp ORDER BY date) + 52 AS place
             FROM ({cells(column, hidden)}) c) AS year
    ON year.place = now.place AND year.grp IS NOT DISTINCT FROM now.grp"""


def groups(column: str, hidden: bool = False, dates: str = RANGE) -> str:
    return f"""SELECT grp, sum(current_sales) AS current_sales, sum(prev_week_sales) AS prev_week_sales,
    sum(promo_sales) AS promo_sales, sum(prev_year_sales) AS prev_year_sales
  FROM ({cells_with_past(column, hidden)}) c WHERE date {dates} GROUP BY ALL"""


def top(column: str, name: str, n: int, hidden: bool = False, dates: str = RANGE) -> str:
    return f"""SELECT grp AS {name}, current_sales, coalesce(prev_week_sales, 0.0) AS prev_week_sales, promo_sales,
    coalesce(prev_year_sales, 0.0) AS prev_year_sales,
    {growth_pct("current_sales", "prev_week_sales")} AS period_wow_pct,
    {growth_pct("current_sales", "prev_year_sales")} AS period_yoy_pct,
    coalesce(promo_sales / nullif(current_sales, 0) * 100, 0.0) AS promo_penetration_pct
  FROM (SELECT *, row_number() OVER (ORDER BY current_sales DESC, grp) AS rank FROM ({groups(column, hidden, dates)}) g) r
  WHERE rank <= {n}"""


def sums(names: dict[str, str], dates: str = RANGE, hidden: str | None = None) -> str:
    """Sales by columns of the flat view, under other names."""
    shown = ", ".join(f"{column} AS {name}" for column, name in names.items())
    kept = f"{hidden} NOT IN {HIDDEN}" if hidden else "TRUE"
    return f"SELECT {shown}, sum(actual) AS actual FROM {SOLD} sold WHERE date {dates} AND {kept} GROUP BY ALL"


def segment(dates: str = RANGE) -> str:
    return sums({"seg": "seg"}, dates)


def promo(dates: str = RANGE) -> str:
    return sums({"date": "date", "promo": "promo"}, dates)


def lift(dates: str = RANGE) -> str:
    return sums({"product_category": "product_category", "promo": "promo"}, dates)


def mix(dates: str = RANGE) -> str:
    return sums({"date": "date", "product_category": "product_category"}, dates, "product_category")
