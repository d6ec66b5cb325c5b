"""The model graph as plain Python calls.

``Warehouse`` builds each model on first use and memoises it. Models that
several others read (the reference's materialised tables) are written as
Parquet under the session's checkpoint folder and read back, which cuts the
lineage (a lost executor recomputes from the written table, not from the
raw feed) and lets later jobs prune columns and push filters into the scan.
Everything else stays a lazy DataFrame so Catalyst optimises across jobs.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.fixed_values import LOOKBACK_DAYS, MATCH_WINDOW_MINUTES
from cartwheel.operators import activity, events, matching, metrics, payments, quality, sessions, staging
from cartwheel.session import configure, new_run_id, scratch_path, session_key
from cartwheel.sources import fixtures

# Models read by several downstream jobs; these are written once per build. Not the payment-event candidates,
# which grow with the square of a shared session's clicks: jobs take them from the join as it finds them.
MATERIALISED = (
    "stg_payment_events", "payment_events_clean", "payment_intents", "charges", "refunds",
    "fct_events", "fct_payments", "map_payment_to_event",
    "sessions_base", "map_payment_to_session", "fct_sessions", "fct_user_daily_activity",
    "fct_product_daily_activity", "dim_users", "dim_products",
)
# Facts that later jobs read by time: written in time order, so that a time-bounded
# read (match window, look-back) skips files and row groups by their statistics.
TIME_ORDERED = {"fct_events": ("event_time", "event_pk")}
# Keys that models are joined on, for bucketed tables: intents with charges and payments with their
# session mapping by intent, the event mapping with sessions by session.
BUCKETED = {"payment_intents": "payment_intent_id", "charges": "payment_intent_id", "fct_payments": "payment_intent_id",
            "map_payment_to_session": "payment_intent_id", "map_payment_to_event": "event_user_session",
            "sessions_base": "session_id", "fct_sessions": "session_id"}
# KPI tables that the quality checks read.
KPI_TABLES = ("session_funnel_daily", "product_conversion_daily", "retention_cohorts",
              "repeat_retention_cohorts", "unit_economics_daily", "dau_wau_mau", "ltv_cohort_curve")


def in_time_order(name: str, df: DataFrame) -> DataFrame:
    """The model range-partitioned and sorted by its time, where later jobs read it by time."""
    order = TIME_ORDERED.get(name)
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, lookback_days: int = LOOKBACK_DAYS,
                 match_window_minutes: int = MATCH_WINDOW_MINUTES, materialise: bool = True,
                 landing: tuple[DataFrame, DataFrame] | None = None, buckets: int | None = None):
        """``buckets``: write the models of ``BUCKETED`` as tables of the session catalog, bucketed and sorted by their
        join keys, so that joins between them need no shuffle. All of a warehouse's tables have the same number."""
        self.spark = configure(spark)
        self.buckets = buckets
        self.sf_dir = sf_dir
        self.lookback_days = lookback_days
        self.match_window_minutes = match_window_minutes
        self.materialise = materialise
        self._landing = self._given = landing
        self._models: dict[str, DataFrame] = {}
        #: Row checks counted while a model was written: rows that break them, by check.
        self.observed: dict[str, dict[str, int]] = {}
        self._lock = threading.RLock()
        self.root = scratch_path(spark, "warehouse", new_run_id())

    # -- plumbing -----------------------------------------------------------
    def _model(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            if name not in self._models:
                df = build()
                if self.materialise and name in MATERIALISED:
                    path = f"{self.root}/{name}"
                    if self.buckets and name in BUCKETED:
                        df = df.repartition(self.buckets, BUCKETED[name])  # a file a bucket
                    checked, counts = quality.observe(in_time_order(name, df), name)
                    df = self._written(name, checked, path)
                    self.observed[name] = counts()
                self._models[name] = df
            return self._models[name]

    def _written(self, name: str, df: DataFrame, path: str) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if not self.buckets or name not in BUCKETED:
            writer.parquet(path)
            return self.spark.read.parquet(path)
        key, table = BUCKETED[name], f"{name}_{self.root.rsplit('/', 1)[1]}"
        writer.bucketBy(self.buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        return self.spark.table(table)

    def table(self, name: str) -> DataFrame:
        """A base table of the driver's data set."""
        return fixtures.read_table(self.spark, self.sf_dir, name)

    # -- landing ------------------------------------------------------------
    def _landings(self) -> tuple[DataFrame, DataFrame]:
        if self._landing is None:
            self._landing = fixtures.landing_tables(self.spark, self.sf_dir)
        return self._landing

    def landings_by_time(self) -> tuple[DataFrame, DataFrame]:
        """Both landing tables, made in tasks of one stretch of time each: for a writer by date."""
        return self._given or fixtures.landing_tables(self.spark, self.sf_dir, by_time=True)

    def landing_clickstream(self) -> DataFrame:
        return self._landings()[0]

    def landing_payments(self) -> DataFrame:
        return self._landings()[1]

    # -- staging / intermediate ---------------------------------------------
    def stg_clickstream_events(self) -> DataFrame:
        return self._model("stg_clickstream_events",
                           lambda: staging.stage_clickstream(self.landing_clickstream()))

    def stg_payment_events(self) -> DataFrame:
        return self._model("stg_payment_events",
                           lambda: staging.stage_payments(self.landing_payments()))

    def payment_events_clean(self) -> DataFrame:
        return self._model("payment_events_clean",
                           lambda: payments.clean_payment_events(self.stg_payment_events()))

    def payment_intents(self) -> DataFrame:
        return self._model("payment_intents",
                           lambda: payments.payment_intents(self.payment_events_clean()))

    def charges(self) -> DataFrame:
        return self._model("charges", lambda: payments.charges(self.stg_payment_events()))

    def refunds(self) -> DataFrame:
        return self._model("refunds", lambda: payments.refunds(self.stg_payment_events()))

    def charges_invalid(self) -> DataFrame:
        return self._model("charges_invalid",
                           lambda: payments.charges_invalid(self.stg_payment_events()))

    def payment_intents_invalid(self) -> DataFrame:
        return self._model("payment_intents_invalid",
                           lambda: payments.payment_intents_invalid(self.payment_events_clean()))

    # -- core facts ---------------------------------------------------------
    def fct_events(self) -> DataFrame:
        return self._model("fct_events", lambda: events.fct_events(self.stg_clickstream_events()))

    def fct_payments(self) -> DataFrame:
        return self._model("fct_payments", lambda: payments.fct_payments(
            self.payment_intents(), self.charges(), self.refunds()))

    def payment_event_candidates(self) -> DataFrame:
        return self._model("payment_event_candidates", lambda: matching.match_candidates(
            self.fct_payments(), self.fct_events(), self.match_window_minutes))

    def map_payment_to_event(self) -> DataFrame:
        # by a sweep: the candidates of a session that many users' clicks carry grow with its square
        return self._model("map_payment_to_event", lambda: matching.nearest_click(
            self.fct_payments(), self.fct_events(), self.match_window_minutes))

    def sessions_base(self) -> DataFrame:
        return self._model("sessions_base", lambda: sessions.sessions_base(self.fct_events()))

    def map_payment_to_session(self) -> DataFrame:
        return self._model("map_payment_to_session", lambda: matching.map_payment_to_session(
            self.map_payment_to_event(), self.sessions_base()))

    def fct_sessions(self) -> DataFrame:
        return self._model("fct_sessions", lambda: sessions.fct_sessions(
            self.sessions_base(), self.map_payment_to_session(), self.fct_payments()))

    def fct_user_daily_activity(self) -> DataFrame:
        return self._model("fct_user_daily_activity", lambda: activity.fct_user_daily_activity(
            self.fct_sessions(), self.fct_payments()))

    def fct_product_daily_activity(self) -> DataFrame:
        return self._model("fct_product_daily_activity",
                           lambda: activity.fct_product_daily_activity(
                               self.fct_events(), self.map_payment_to_event(),
                               self.fct_payments()))

    def dim_users(self) -> DataFrame:
        return self._model("dim_users", lambda: activity.dim_users(
            self.fct_sessions(), self.fct_payments()))

    def dim_products(self) -> DataFrame:
        return self._model("dim_products", lambda: activity.dim_products(self.fct_events()))

    # -- metrics ------------------------------------------------------------
    def dau_wau_mau(self) -> DataFrame:
        return metrics.dau_wau_mau(self.fct_user_daily_activity())

    def session_funnel_daily(self, distinct_paid: bool = False) -> DataFrame:
        return metrics.session_funnel_daily(self.fct_sessions(), distinct_paid)

    def product_conversion_daily(self) -> DataFrame:
        return metrics.product_conversion_daily(self.fct_product_daily_activity())

    def retention_cohorts(self) -> DataFrame:
        return metrics.retention_cohorts(self.dim_users(), self.fct_user_daily_activity())

    def repeat_retention_cohorts(self) -> DataFrame:
        return metrics.repeat_retention_cohorts(self.fct_payments())

    def ltv_cohort_curve(self, max_age: int = metrics.LTV_MAX_AGE, cohort_end=None,
                         fill: bool = False) -> DataFrame:
        return metrics.ltv_cohort_curve(self.dim_users(), self.fct_user_daily_activity(),
                                        max_age, cohort_end, fill)

    def unit_economics_daily(self) -> DataFrame:
        return metrics.unit_economics_daily(self.fct_user_daily_activity())


    MODELS = (
        "stg_clickstream_events", "stg_payment_events", "payment_events_clean",
        "payment_intents", "charges", "refunds", "charges_invalid", "payment_intents_invalid",
        "fct_events", "fct_payments", "payment_event_candidates", "map_payment_to_event",
        "sessions_base", "map_payment_to_session", "fct_sessions", "fct_user_daily_activity",
        "fct_product_daily_activity", "dim_users", "dim_products", "dau_wau_mau",
        "session_funnel_daily", "product_conversion_daily", "retention_cohorts",
        "repeat_retention_cohorts", "ltv_cohort_curve", "unit_economics_daily",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a temporary view, so SQL written against the
        model names runs unchanged through ``spark.sql``. Views are lazy: a
        model is computed (or read from its written table) only when a query
        uses it."""
        names = []
        for name in self.MODELS:
            getattr(self, name)().createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def quality_models(self) -> dict[str, DataFrame]:
        """Every model a data-quality check reads, by name."""
        names = ["stg_clickstream_events", "stg_payment_events", "payment_intents", "charges",
                 "refunds", "payment_events_clean", "payment_event_candidates",
                 "map_payment_to_event", "map_payment_to_session", "sessions_base", "fct_events",
                 "fct_payments", "fct_sessions", "fct_user_daily_activity",
                 "fct_product_daily_activity", "dim_users", "dim_products"]
        out = {n: getattr(self, n)() for n in names}
        for n in KPI_TABLES:
            out[n] = getattr(self, n)()
        return out


_WAREHOUSES: dict[tuple, Warehouse] = {}
_REG_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, **params) -> Warehouse:
    """The shared warehouse of (application, data set, parameters)."""
    key = (session_key(spark), sf_dir.rstrip("/"), tuple(sorted(params.items())))
    with _REG_LOCK:
        wh = _WAREHOUSES.get(key)
        if wh is None:
            wh = Warehouse(spark, sf_dir, **params)
            _WAREHOUSES[key] = wh
        return wh


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget the warehouses of a data set and delete their written models.

    Call it when the data in ``sf_dir`` has changed; the next use builds anew.
    """
    with _REG_LOCK:
        stale = [k for k in _WAREHOUSES if k[0] == session_key(spark) and k[1] == sf_dir.rstrip("/")]
        for key in stale:
            root = spark._jvm.org.apache.hadoop.fs.Path(_WAREHOUSES.pop(key).root)
            root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
