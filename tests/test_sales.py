from datetime import datetime

import pytest

from goldseam.plans import sales


@pytest.fixture
def sold(frame):
    raw = frame(
        [
            ("1", "2025-05-02", "Mouse", 2, 10.0), ("2", "2025-05-20", "Mouse", 1, 12.5), ("3", "2025-06-01", "USB", 4, 5.0),
            ("4", "2025-06-02", "Unknown", 4, 5.0), ("5", "2024-06-02", "USB", 4, 5.0), ("6", "bad", "USB", 1, 5.0),
        ],
        sales.SALES_COLUMNS,
    )
    return sales.sales_bronze(raw)


@pytest.fixture
def products(frame):
    rows = [(1, "Mouse", "Accesorios", "Entrada", True, True, False), (8, "USB", "Accesorios", "Almacenamiento", False, False, False)]
    return frame(rows, sales.PRODUCT_COLUMNS)


SPAN = datetime(2025, 1, 1), datetime(2025, 12, 31)


def test_monthly_sales(sold, products, values):
    out = sales.monthly_sales(sold, products, *SPAN)
    assert out.columns == ["mes", "categoria", "producto", "unidades_vendidas", "importe_total", "precio_medio"]
    assert [tuple(map(str, r)) for r in values(out)] == [
        ("2025-05-01", "Accesorios", "Mouse", "3", "32.5", "11.25"),
        ("2025-06-01", "Accesorios", "USB", "4", "20.0", "5.0"),
    ]
    assert sales.monthly_sales(sold, products, *SPAN, "Oficina").count() == 0


@pytest.mark.parametrize("category", ["All", "Accesorios", "Oficina"])
def test_monthly_sales_by_sql(spark, sold, products, values, category):
    sold.createOrReplaceTempView("sold")
    products.unionByName(products.filter("product_id = 1")).createOrReplaceTempView("listed")
    frames = sales.monthly_sales(spark.table("sold"), spark.table("listed"), *SPAN, category)
    assert values(sales.monthly_sales_sql(spark, "sold", "listed", *SPAN, category)) == values(frames)


def test_a_product_listed_twice_multiplies_its_sales(sold, products):
    twice = products.unionByName(products)
    row = sales.monthly_sales(sold, twice, *SPAN).filter("producto = 'Mouse'").first()
    assert (row["unidades_vendidas"], row["importe_total"], row["precio_medio"]) == (6, 65.0, 11.25)


def test_average_price_by_frame_and_by_sql(spark, sold):
    sold.createOrReplaceTempView("ventas")
    assert sales.average_price(sold, "Mouse", 10.0).first()[0] == 11.25
    assert sales.average_price(sold, "All", 0.0).count() == 1
    assert sales.average_price_sql(spark, "ventas", "Mouse", "11").first()[0] == 12.5
    assert sales.average_price_sql(spark, "ventas", "x' OR '1'='1", "0").first()[0] is None


def test_sales_by_dimension_equals_join_then_sum(frame, products, values):
    fact = frame([("Mouse", 1, 1.5), ("Mouse", 2, 2.5), ("USB", 3, 3.0), ("?", 4, 4.0), (None, 5, 5.0)], "p STRING, u INT, t DOUBLE")
    out = sales.sales_by_dim(fact, products, ("p", "nombre_producto"), "categoria", "u", "t")
    assert values(out) == [(None, 9, 9.0), ("Accesorios", 6, 7.0)]
    assert [r["p"] for r in sales.sales_by(fact, "p", "u", "t").collect()] == [None, "?", "Mouse", "USB"]
