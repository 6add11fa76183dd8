"""Product counts and top products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, products
from . import inputs
from .registry import query

# The test events are minutes apart, so windows of a day every six hours.
SIZE, SLIDE = "1 day", "6 hours"
SIZE_MS, SLIDE_MS = inputs.DAY, inputs.DAY // 4


def shop_rows(raw):
    return filters.product_events(inputs.shop_events(raw)).select(
        "eventId", "categoryId", "productId", "timestamp", "id"
    )


def shop(spark, folder):
    return shop_rows(inputs.table(spark, folder, "events"))


def counts_sql(size: int, slide: int) -> str:
    return f"""{inputs.SHOP_SQL},
    copies AS (
      SELECT "eventId", "categoryId", "productId",
             unnest(range("timestamp" // {slide} * {slide} - {size} + {slide},
                          "timestamp" // {slide} * {slide} + 1, {slide})) AS "windowStart"
      FROM shop),
    counts AS (
      SELECT "eventId", "categoryId", "productId", "windowStart", count(*) AS "count",
             "windowStart" + {size} AS "windowEnd"
      FROM copies GROUP BY ALL)"""


def top_sql(size: int, slide: int) -> str:
    return f"""{counts_sql(size, slide)},
    ranked AS (
      SELECT *, CAST(row_number() OVER (
                  PARTITION BY "categoryId", "eventId", "windowStart", "windowEnd"
                  ORDER BY "count" DESC, "productId") AS INTEGER) AS rank
      FROM counts)"""


@query("product_sliding_count", f"WITH {counts_sql(SIZE_MS, SLIDE_MS)} SELECT * FROM counts")
def _counts(spark, folder):
    return products.sliding_count(shop(spark, folder), size=SIZE, slide=SLIDE)


@query(
    "product_sliding_count_10m",
    f"WITH {counts_sql(600_000, 60_000)} SELECT * FROM counts",
)
def _counts_10m(spark, folder):
    return products.sliding_count(shop(spark, folder))


@query(
    "product_top3",
    f"WITH {top_sql(SIZE_MS, SLIDE_MS)} SELECT * FROM ranked WHERE rank <= 3",
)
def _top3(spark, folder):
    return products.top_products(shop(spark, folder), SIZE, SLIDE)


@query(
    "product_top3_lists",
    f"""WITH {top_sql(SIZE_MS, SLIDE_MS)}
    SELECT "categoryId", "eventId", "windowStart", "windowEnd",
           string_agg("productId" || ':' || "count", ',' ORDER BY rank) AS items
    FROM ranked WHERE rank <= 3 GROUP BY ALL""",
)
def _top3_lists(spark, folder):
    lists = products.top_lists(_top3(spark, folder))
    text = F.transform("items", lambda x: F.concat_ws(":", x["productId"], x["count"]))
    return lists.withColumn("items", F.array_join(text, ","))


@query(
    "sort_desc_limit",
    f"""WITH {inputs.SHOP_SQL},
    counts AS (SELECT "categoryId", "productId", count(*) AS "count" FROM shop GROUP BY ALL),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY "categoryId"
                       ORDER BY "count" DESC, "productId") AS INTEGER) AS rank FROM counts)
    SELECT * FROM ranked WHERE rank <= 3""",
)
def _sort_limit(spark, folder):
    counts = (
        shop(spark, folder)
        .groupBy("categoryId", "productId")
        .agg(F.count("*").alias("count"))
    )
    return products.top_n(counts, ["categoryId"])


@query(
    "filter_product_events",
    f'WITH {inputs.SHOP_SQL} SELECT "eventId", "categoryId", "productId", "timestamp", id FROM shop',
)
def _events(spark, folder):
    return shop(spark, folder)


TUMBLING_SQL = f"""{inputs.SHOP_SQL},
    counts AS (
      SELECT "eventId", "timestamp" // {inputs.DAY} * {inputs.DAY} AS "windowStart",
             "timestamp" // {inputs.DAY} * {inputs.DAY} + {inputs.DAY} AS "windowEnd",
             count(*) AS "count"
      FROM shop GROUP BY ALL)"""


@query("tumbling_event_count", f"WITH {TUMBLING_SQL} SELECT * FROM counts")
def _tumbling(spark, folder):
    return products.sliding_count(shop(spark, folder), ["eventId"], "1 day", "1 day")
