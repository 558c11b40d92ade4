SELECT year_month AS item, COUNT(*) AS trip_count, MAX(total_amount) AS top_amount,
       :run_id AS run_id
FROM {trips}
WHERE taxi_type = :fleet
GROUP BY year_month
