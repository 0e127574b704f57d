SELECT metric_date, priority, grouping_id() AS level_id,
       count(*) AS orders, count_if(status = 'F') AS finished, sum(amount) AS amount
FROM (
    SELECT to_date(o_orderdate) AS metric_date, o_orderpriority AS priority, o_orderstatus AS status,
           cast(o_totalprice AS decimal(18,2)) AS amount
    FROM {orders}
    WHERE o_orderdate >= :start_date AND o_orderdate < date_add(:end_date, 1)
)
GROUP BY GROUPING SETS ((metric_date), (metric_date, priority))
