"""Job entry points over production tables (what a scheduler runs).

    spark-submit --py-files feedlens.zip run_job.py etl --feed P --messages P --out P --store P --as-of D
    python -m feedlens.plans.jobs report --store P --out P --as-of D
    python -m feedlens.plans.jobs report --feed P --messages P --out P --as-of D [--day-column C]
    python -m feedlens.plans.jobs dashboards --store P --out P [--feed P --first D --last D] [--cohort-day D]
    python -m feedlens.plans.jobs backfill --feed P --messages P --store P --first D --last D
    python -m feedlens.plans.jobs live --feed P | --messages P --out P [--once]
    python -m feedlens.plans.jobs aa --feed P --out P --first D --last D --groups 2 3
    python -m feedlens.plans.jobs ab --feed P --out P --first D --last D --groups 0 3

Batch jobs read Parquet event tables with fixed schemas, or the daily store that
the ETL keeps (``plans.daily_store``), run the library functions and write
Parquet.  Slices and store are published in one step per day; every other output
is the job's own folder, replaced as a whole, so a retried job leaves the same
result.  ``live`` runs until it is stopped, or once over what has arrived.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import as_date, time_in_days
from ..operators import activity, cohorts, experiments, slices
from ..session import build_session, materialize
from ..sources import readers, sinks
from ..streaming import realtime
from . import daily_store, reports


def _yesterday(as_of):
    d = as_date(as_of) - _dt.timedelta(days=1)
    return d, d


def daily_etl(spark: SparkSession, feed_path: str, messages_path: str, out_path: str,
              as_of, how: str = "inner", day_column: str | None = None, store: str | None = None) -> DataFrame:
    """Slices of day ``as_of - 1`` by gender, age and OS, published into the
    slices table (the day is replaced), and the day's rows of the daily
    store.  With ``day_column`` (event tables in day directories) only that day's
    directory is read."""
    day = _yesterday(as_of)
    feed = readers.read_feed_actions(spark, feed_path, day_column, day)
    msgs = readers.read_message_actions(spark, messages_path, day_column, day)
    out = slices.daily_slices(feed, msgs, as_of, how=how)
    sinks.publish_slices(out, out_path, day[0])
    if store:
        daily_store.load(spark, feed, msgs, *day, store)
    return sinks.read_slices(spark, out_path, *day)


def backfill(spark: SparkSession, feed_path: str, messages_path: str, store: str, first, last,
             day_column: str | None = None) -> None:
    """Load, or load again, the days [first, last] into the daily store: one scan
    of each event table for the whole range."""
    feed = readers.read_feed_actions(spark, feed_path, day_column, (first, last))
    msgs = readers.read_message_actions(spark, messages_path, day_column, (first, last))
    daily_store.load(spark, feed, msgs, first, last, store)


def _written(outs: dict[str, DataFrame], out_path: str, folder: str = "") -> dict[str, DataFrame]:
    """Write every output and return readers of what was written."""
    done = {}
    for name, df in outs.items():
        path = f"{out_path}/{name}{folder}"
        df.write.mode("overwrite").parquet(path)
        done[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return done


def _with_latest(outs: dict[str, DataFrame], out_path: str, folder: str) -> dict[str, DataFrame]:
    """Write the reports, then the rows of the daily message from the written
    key-metric and whole-app reports (a few rows each)."""
    done = _written(outs, out_path, folder)
    latest = reports.report_latest_day(done["main_metric_report"], done["full_report"])
    return done | _written({"report_latest_day": latest}, out_path, folder)


def daily_reports(spark: SparkSession, feed_path: str, messages_path: str, out_path: str,
                  as_of, n_days: int = 7, day_column: str | None = None) -> dict[str, DataFrame]:
    """Key-metric report, whole-app report, traffic tables and the
    latest-day rows, each written under ``out_path/<name>/as_of=<day>``, from the
    event tables.

    With ``day_column`` the window's directories are read, and for the previous
    day's values those of the week before it or, if they are empty, of the one
    day that the search over all directories finds.  The sender set needs all
    messages; ``daily_reports_from_store`` does without."""
    first = as_date(as_of) - _dt.timedelta(days=n_days)
    feed = lambda days: readers.read_feed_actions(spark, feed_path, day_column, days)
    messages = lambda days: readers.read_message_actions(spark, messages_path, day_column, days)
    last = _dt.date.max
    before = (reports.last_day_before(feed((first - _dt.timedelta(days=7), first)), first)
              or reports.last_day_before(feed(None), first))
    window = feed((first, last))
    outs = {
        "main_metric_report": reports.main_metric_report(feed((before or first, last)), as_of, n_days, before or first),
        "full_report": reports.full_report(window, messages((first, last)), as_of, n_days,
                                           reports.senders(messages(None))),
        "feed_traffic": reports.feed_traffic(window, as_of, n_days),
        "message_traffic": reports.message_traffic(messages((first, last)), as_of, n_days),
    }
    return _with_latest(outs, out_path, f"/as_of={as_of}")


def daily_reports_from_store(spark: SparkSession, store: str, out_path: str, as_of,
                             n_days: int = 7) -> dict[str, DataFrame]:
    """The same outputs from the daily store: no event file is opened."""
    outs = {name: getattr(daily_store, name)(spark, store, as_of, n_days)
            for name in ("main_metric_report", "full_report", "feed_traffic", "message_traffic")}
    return _with_latest(outs, out_path, f"/as_of={as_of}")


def dashboards(spark: SparkSession, store: str, out_path: str, cohort_day=None, horizons=(1, 14),
               feed_path: str | None = None, first=None, last=None, day_column: str | None = None) -> dict[str, DataFrame]:
    """Data sets of the dashboards from the daily store, each replaced under
    ``out_path/<name>``.  The drop of activity by city needs the events of
    [first, last] (``feed_path``), the campaign its cohort day."""
    f, m = (activity.load(spark, f"{store}/{t}_activity") for t in ("feed", "message"))
    both = lambda fn: fn(f).selectExpr("'feed' AS service", "*").unionByName(
        fn(m).selectExpr("'messenger' AS service", "*"))
    outs = {
        "main_metrics": daily_store.main_metrics(spark, store),
        "audience_by_source": both(activity.users_by_source),
        "retention_feed": activity.retention(f),
        "retention_messages": activity.retention(m),
        "new_users": both(activity.new_users),
        "weekly_audience": both(activity.weekly_audience),
        "service_overlap": activity.service_overlap(f, m),
        "rolling_users": daily_store.rolling_users(spark, store),
    }
    if cohort_day:
        outs["campaign_retention"] = activity.campaign_retention(f, cohort_day, horizons)
    if feed_path:
        feed = readers.read_feed_actions(spark, feed_path, day_column, (first, last))
        outs["city_activity_drop"] = cohorts.city_activity_drop(feed.filter(time_in_days(first, last)))
    return _written(outs, out_path)


def live(spark: SparkSession, out_path: str, feed_path: str | None = None, messages_path: str | None = None,
         once: bool = False) -> list:
    """Streams of live window metrics into published tables under ``out_path``;
    windows show while they are open.  ``once``: all that has arrived, then stop."""
    started = []
    if feed_path:
        started.append(realtime.start_live(realtime.read_feed_stream(spark, feed_path), "feed", f"{out_path}/feed", once))
    if messages_path:
        started.append(realtime.start_live(realtime.read_message_stream(spark, messages_path), "messages",
                                           f"{out_path}/messages", once))
    return started


def aa_check(spark: SparkSession, feed_path: str, out_path: str, first, last, group_a,
             group_b, sims: int = 10_000, sample_size: int = 500, seed: int = 42,
             replace: bool = True, day_column: str | None = None) -> DataFrame:
    """A/A check of the splitting system: one summary row, the simulated
    tests and their p-value histogram."""
    feed = readers.read_feed_actions(spark, feed_path, day_column, (first, last))
    users = materialize(experiments.user_ctr(feed, first, last, [group_a, group_b]))
    sims_df = experiments.aa_resample(spark, users, group_a, group_b, sims, sample_size, seed,
                                      replace=replace)
    sims_df.write.mode("overwrite").parquet(f"{out_path}/simulations")
    done = spark.read.parquet(f"{out_path}/simulations")   # written once, read twice
    experiments.pvalue_histogram(done).write.mode("overwrite").parquet(f"{out_path}/histogram")
    summary = experiments.aa_summary(users, done, group_a, group_b)
    summary.write.mode("overwrite").parquet(f"{out_path}/summary")
    return summary


def ab_test(spark: SparkSession, feed_path: str, out_path: str, first, last, control,
            treatment, day_column: str | None = None) -> DataFrame:
    """Welch tests of CTR and linearized likes for one pair of groups."""
    feed = readers.read_feed_actions(spark, feed_path, day_column, (first, last))
    out = experiments.ab_test(feed, first, last, control, treatment)
    out.write.mode("overwrite").parquet(f"{out_path}/ab_{control}_{treatment}")
    return out


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="feedlens.plans.jobs")
    p.add_argument("job", choices=["etl", "backfill", "report", "dashboards", "live", "aa", "ab"])
    p.add_argument("--feed")
    p.add_argument("--messages")
    p.add_argument("--store", help="daily store kept by etl and backfill")
    p.add_argument("--out")
    p.add_argument("--as-of", default=_dt.date.today().isoformat())
    p.add_argument("--first")
    p.add_argument("--last")
    p.add_argument("--cohort-day")
    p.add_argument("--groups", type=int, nargs=2)
    p.add_argument("--sims", type=int, default=10_000)
    p.add_argument("--sample-size", type=int, default=500)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--distinct-users", action="store_true", help="aa: sample without replacement")
    p.add_argument("--once", action="store_true", help="live: stop when all that has arrived is done")
    p.add_argument("--day-column", help="partition column of day-directory event tables")
    a = p.parse_args(argv)
    needs = {"etl": ["feed", "messages", "out"], "backfill": ["feed", "messages", "store", "first", "last"],
             "report": ["out"] + ([] if a.store else ["feed", "messages"]), "dashboards": ["store", "out"],
             "live": ["out"], "aa": ["feed", "out", "first", "last", "groups"],
             "ab": ["feed", "out", "first", "last", "groups"]}[a.job]
    missing = [n for n in needs if getattr(a, n) is None]
    if missing:
        p.error(f"{a.job} needs " + ", ".join("--" + n for n in missing))
    spark = build_session()
    if a.job == "etl":
        daily_etl(spark, a.feed, a.messages, a.out, a.as_of, day_column=a.day_column, store=a.store)
    elif a.job == "backfill":
        backfill(spark, a.feed, a.messages, a.store, a.first, a.last, a.day_column)
    elif a.job == "report" and a.store:
        daily_reports_from_store(spark, a.store, a.out, a.as_of)
    elif a.job == "report":
        daily_reports(spark, a.feed, a.messages, a.out, a.as_of, day_column=a.day_column)
    elif a.job == "dashboards":
        dashboards(spark, a.store, a.out, a.cohort_day, feed_path=a.feed, first=a.first, last=a.last,
                   day_column=a.day_column)
    elif a.job == "live":
        for q in live(spark, a.out, a.feed, a.messages, a.once):
            q.awaitTermination()
    elif a.job == "aa":
        aa_check(spark, a.feed, a.out, a.first, a.last, *a.groups, a.sims, a.sample_size, a.seed,
                 replace=not a.distinct_users, day_column=a.day_column)
    else:
        ab_test(spark, a.feed, a.out, a.first, a.last, *a.groups, day_column=a.day_column)


if __name__ == "__main__":
    main()
