"""Date queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.functions import dates as D
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import DATED, SQL_CLEAN_DATE, with_views

_SHOWN = "yyyy-MM-dd HH:mm:ss"
_SQL_MINUTE = "strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')"
_SQL_SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


@query(with_views(f"""SELECT event_id, journal, CASE journal WHEN 'dantri' THEN NULL
  WHEN 'saigontimes' THEN {_SQL_SECOND} ELSE {_SQL_MINUTE} END AS date FROM dated""", DATED))
def parse_dates_by_journal(spark, sf_dir):
    rows = views.dated(spark, sf_dir)
    return rows.select("event_id", "journal", F.date_format(D.parse_date("journal", "raw_date", "stream"), _SHOWN).alias("date"))


@query(with_views(f"""SELECT event_id, journal, CASE journal WHEN 'saigontimes' THEN NULL
  WHEN 'vtc' THEN strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')
  WHEN 'diendandoanhnghiep' THEN {_SQL_SECOND} ELSE {_SQL_MINUTE} END AS date FROM dated""", DATED))
def parse_dates_batch_route(spark, sf_dir):
    rows = views.dated(spark, sf_dir).withColumn("date", D.parse_date("journal", "raw_date", "batch"))
    # The zoned date of vtc is an instant: show it in UTC. The others are wall time.
    instant = F.to_utc_timestamp("date", F.current_timezone())
    shown = F.when(F.col("journal") == "vtc", instant).otherwise(F.col("date"))
    return rows.select("event_id", "journal", F.date_format(shown, _SHOWN).alias("date"))


@query(with_views(f"""SELECT event_id, CASE WHEN event_id % 9 = 0 OR journal IN ('vtc', 'saigontimes', 'diendandoanhnghiep')
  THEN {_SQL_SECOND} ELSE {_SQL_MINUTE} END AS date FROM dated""", DATED))
def parse_dates_any(spark, sf_dir):
    seconds = F.expr("cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string)")
    text = F.when(F.col("event_id") % 9 == 0, seconds).otherwise(F.col("raw_date"))
    rows = views.dated(spark, sf_dir)
    return rows.select("event_id", F.date_format(D.parse_date_any(text), _SHOWN).alias("date"))


@query(with_views(f"SELECT event_id, journal, {SQL_CLEAN_DATE} AS date_text FROM dated", DATED))
def clean_date_text(spark, sf_dir):
    rows = views.dated(spark, sf_dir).withColumn("shown", views.decorated_date())
    return rows.select("event_id", "journal", D.clean_date_text("journal", "shown").alias("date_text"))


@query(with_views("SELECT journal, strftime(ts, '%Y-%m') AS year_month, count(*) AS n FROM dated GROUP BY ALL", DATED))
def year_month_counts(spark, sf_dir):
    rows = views.dated(spark, sf_dir).select("journal", D.year_month(D.parse_date_any("raw_date")).alias("year_month"))
    return rows.groupBy("journal", "year_month").agg(F.count("*").alias("n"))


@query(with_views("""SELECT event_id, journal,
  CASE journal WHEN 'dantri' THEN NULL ELSE strftime(date_trunc('day', ts), '%Y-%m-%d') END AS day FROM dated""", DATED))
def day_trunc_dates(spark, sf_dir):
    rows = views.dated(spark, sf_dir)
    return rows.select("event_id", "journal", F.date_format(D.parse_day("journal", "raw_date"), "yyyy-MM-dd").alias("day"))


@query(with_views("""SELECT event_id, CASE WHEN journal IN ('vtc', 'saigontimes', 'diendandoanhnghiep')
  THEN epoch_ms(date_trunc('second', ts)) ELSE epoch_ms(date_trunc('minute', ts)) END AS millis FROM dated""", DATED))
def epoch_millis(spark, sf_dir):
    rows = views.dated(spark, sf_dir)
    return rows.select("event_id", D.to_epoch_millis(D.parse_date_any("raw_date")).alias("millis"))
