"""Sales: product averages, sales by country, and the monthly dashboard dataset."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.functions.dates import month_start
from goldseam.functions.fixed_point import exact_sum, exact_total, mean_of, rounded
from goldseam.operators.joins import enrich
from goldseam.operators.shaping import conform, filter_by

# Column names and types of the sales and product tables.
SALES_COLUMNS = "id STRING, fecha STRING, producto STRING, cantidad INT, precio DOUBLE"
PRODUCT_COLUMNS = (
    "product_id INT, nombre_producto STRING, categoria STRING, tipo_dispositivo STRING, "
    "es_periferico BOOLEAN, es_entrada BOOLEAN, es_salida BOOLEAN"
)


def sales_bronze(raw: DataFrame) -> DataFrame:
    """The sales file with its date text as a timestamp."""
    return conform(raw, {"fecha": "timestamp"})


def average_price(
    df: DataFrame, product: str, min_price: float, product_col: str = "producto", price_col: str = "precio"
) -> DataFrame:
    """Mean price of one product from a lowest price on."""
    chosen = filter_by(df, **{product_col: product}).filter(F.col(price_col) >= min_price)
    return chosen.agg(F.avg(price_col).alias("precio_medio"))


def average_price_sql(spark: SparkSession, table: str, product: str, min_price: str) -> DataFrame:
    """The same by SQL text; the values are bound as parameters, not pasted into the text."""
    return spark.sql(
        "SELECT avg(precio) AS precio_medio FROM IDENTIFIER(:t) "
        "WHERE producto = :product AND precio >= CAST(:min_price AS DOUBLE)",
        args={"t": table, "product": product, "min_price": min_price},
    )


def line_totals(df: DataFrame, units: str, price: str, total_as: str = "total_sales") -> DataFrame:
    return df.withColumn(total_as, F.col(units) * F.col(price))


def sales_by(df: DataFrame, key: str, units: str, total: str) -> DataFrame:
    """Units and amount per key, largest amount first."""
    sums = df.groupBy(key).agg(
        F.sum(units).alias("total_units"), exact_sum(total).alias("total_sales_amount")
    )
    return sums.orderBy(F.desc("total_sales_amount"), F.asc(key))


def sales_by_dim(df: DataFrame, dim: DataFrame, on: tuple[str, str], key: str, units: str, total: str) -> DataFrame:
    """``sales_by`` over a dimension attribute, for a fact that is large next to a large dimension.

    The fact is summed per join key first. That shuffle already places the rows for the
    join, and a hot key arrives as one row per map task.
    """
    fact_key, dim_key = on
    per_key = df.groupBy(fact_key).agg(F.sum(units).alias("_units"), exact_total(total).alias("_total"))
    named = enrich(per_key, dim, {fact_key: dim_key}, [key])
    sums = named.groupBy(key).agg(
        F.sum("_units").alias("total_units"), rounded(F.sum("_total")).alias("total_sales_amount")
    )
    return sums.orderBy(F.desc("total_sales_amount"), F.asc(key))


def monthly_sales(
    sales: DataFrame,
    products: DataFrame,
    since: datetime,
    until: datetime,
    category: str = "All",
    day: str = "fecha",
    product: str = "producto",
    units: str = "cantidad",
    price: str = "precio",
    name: str = "nombre_producto",
    group: str = "categoria",
) -> DataFrame:
    """Units, amount and mean price per month, category and product.

    Sales of unknown products are left out. Sales are summed per month and product before
    they meet the product table, so the join moves one row per month and product, and a
    product listed several times multiplies the sums just as it would multiply the rows.
    """
    def bound(value: datetime) -> Column:
        return F.lit(value).cast(dict(sales.dtypes)[day])

    summed = (
        sales.filter(F.col(day).between(bound(since), bound(until)))
        .groupBy(month_start(day).alias("mes"), product)
        .agg(
            F.sum(units).alias("_units"),
            exact_total(F.col(units) * F.col(price)).alias("_amount"),
            exact_total(price).alias("_price"),
            F.count(price).alias("_n"),
        )
    )
    listed = filter_by(products, **{group: category})
    joined = enrich(summed, listed, {product: name}, [group], how="inner")
    return joined.groupBy("mes", group, product).agg(
        F.sum("_units").alias("unidades_vendidas"),
        rounded(F.sum("_amount")).alias("importe_total"),
        mean_of(F.sum("_price"), F.sum("_n")).alias("precio_medio"),
    )


def monthly_sales_sql(
    spark: SparkSession, sales: str, products: str, since: datetime, until: datetime, category: str = "All"
) -> DataFrame:
    """``monthly_sales`` by SQL text over two tables, with bound parameters."""
    return spark.sql(
        """
        WITH sold AS (
            SELECT trunc(fecha, 'MONTH') AS mes, producto, sum(cantidad) AS units,
                sum(cast(cantidad * precio AS DECIMAL(38, 10))) AS amount,
                sum(cast(precio AS DECIMAL(38, 10))) AS price, count(precio) AS n
            FROM IDENTIFIER(:sales) WHERE fecha BETWEEN :since AND :until GROUP BY ALL
        )
        SELECT mes, categoria, producto, sum(units) AS unidades_vendidas, cast(round(sum(amount), 2) AS DOUBLE) AS importe_total,
            cast(round(sum(price) / sum(n), 2) AS DOUBLE) AS precio_medio
        FROM sold JOIN IDENTIFIER(:products) ON producto = nombre_producto
        WHERE :category IN ('All', categoria)
        GROUP BY ALL
        """,
        args={"sales": sales, "products": products, "since": since, "until": until, "category": category},
    )
