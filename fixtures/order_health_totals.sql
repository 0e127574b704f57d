SELECT to_date(o_orderdate) AS metric_date, count(*) AS total_orders
FROM {orders}
GROUP BY ALL
