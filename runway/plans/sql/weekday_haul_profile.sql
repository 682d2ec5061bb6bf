-- Weekday × haul profile: how a weekday's flights split over three distance bands.
WITH banded AS (
  SELECT dayofweek, reporting_airline, arrdelay,
         width_bucket(distance, 500, 1500, 1) AS band,
         cancelled + diverted = 0 AS flown
  FROM {silver}
  WHERE distance IS NOT NULL
),
per_cell AS (
  SELECT dayofweek, band, count(*) AS flights, count_if(flown) AS flown_flights,
         max(arrdelay) AS worst_arr_delay, min(reporting_airline) <> max(reporting_airline) AS contested
  FROM banded
  GROUP BY dayofweek, band
)
SELECT dayofweek, element_at(array('short', 'medium', 'long'), CAST(band + 1 AS INT)) AS haul,
       flights, flown_flights, worst_arr_delay, contested,
       sum(flights) OVER (PARTITION BY dayofweek) AS weekday_flights,
       rank() OVER (PARTITION BY dayofweek ORDER BY flights DESC) AS haul_rank
FROM per_cell
