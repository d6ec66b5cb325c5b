"""Multi-batch incremental runs of the whole model graph, at the cost of a slice.

A batch reads the deliveries in the look-back past the landing watermark, stages
them alone and compares them with the ledger: the staged table, which holds the
best delivery of every payload so far, by the payload's own date. A payload that
is delivered again finds its earlier delivery in the part of that date, so only
parts of the batch's dates are read and written. What really changed, with the
version it replaces, drives everything after: a change propagates through the keys
of both the old and the new version of every rebuilt row (a session whose first
event arrives late moves to another day: both days are rebuilt), and touched keys
are rebuilt over their full history, which is read from the parts that hold it.

Every model is laid out by date (``PARTS``); a merge writes the dates that lose or
gain rows and no others. Tables and watermarks are committed together when all
models of the batch are there (``run_state``): a run that stops in between is
taken up by a new ``IncrementalModels`` over the same root, which does the batch
again. The result equals a full refresh; the registered ``*_incremental`` queries
check that for every model.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import blank_to_null
from cartwheel.operators import activity, events, matching, payments, sessions, staging
from cartwheel.operators import incremental as inc
from cartwheel.plans.run_state import PART, RunState, as_mark, part_of
from cartwheel.plans.warehouse import TIME_ORDERED
from cartwheel.session import MEASURED_BROADCASTS, configure, new_run_id, scratch_path, session_conf

# The date that a model is laid out by. Staged tables go by a date of the payload itself,
# so that every delivery of a payload has the same one. Dimensions are one part.
PARTS: dict[str, str | None] = {
    "stg_clickstream_events": "event_ts", "stg_payment_events": "provider_created_ts",
    "fct_events": "event_date", "sessions_base": "session_date", "payment_events_clean": "event_date",
    "payment_intents": "event_time", "charges": "event_time", "refunds": "event_time",
    "charges_invalid": "event_ts", "payment_intents_invalid": "event_time",
    "fct_payments": "payment_intent_event_ts", "payment_event_candidates": "payment_event_time",
    "map_payment_to_event": "payment_event_time", "map_payment_to_session": "payment_event_time",
    "fct_sessions": "session_date", "fct_user_daily_activity": "activity_date",
    "fct_product_daily_activity": "activity_date", "dim_users": None, "dim_products": None,
}
# What tells two deliveries of a payload apart.
DELIVERY = ["payload_hash", "ingested_at", "filename", "load_id"]


class _Tables(Mapping):
    """Committed tables, each read on demand."""

    def __init__(self, store: RunState):
        self._store = store

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._store.tables:
            raise KeyError(name)
        return self._store.read(name).drop(PART)

    def __iter__(self) -> Iterator[str]:
        return iter(self._store.tables)

    def __len__(self) -> int:
        return len(self._store.tables)


# A batch touches many dates with few rows each: let several tasks write them, and list a few
# hundred folders from the driver instead of by a job. Large parts are dealt as ever.
# Its joins are between written tables and broadcast by measured size alone.
_RUN_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
             "spark.sql.sources.parallelPartitionDiscovery.threshold": "256",
             **MEASURED_BROADCASTS,
             # A side whose partitions were all found to be small is hashed; the other one needn't be sorted.
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
             "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
             # What a job shuffled goes with the job: no later one reads it, and a batch has hundreds.
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


# Up to so many partitions (Spark's own default number among them) a map task opens a file for each of them, above it one
# file in all. A batch has thousands of tasks of few rows, which spent most of their time on opening files.
_PARTITIONS, _FILE_EACH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.shuffle.sort.bypassMergeThreshold"
_FEW = 32


def _initial_partitions(spark: SparkSession) -> int:
    """Partitions that the run's shuffles start from: the session's number, or the next one that needs no file each."""
    own = int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    limit = int(spark.conf.get(_FILE_EACH, None) or 200)
    return limit + 1 if _FEW < own <= limit else own


class IncrementalModels:
    """Incremental runs over one root folder; what is committed there is the state to go on from."""

    def __init__(self, spark: SparkSession, lookback_days: int = 3,
                 match_window_minutes: int = 60, root: str | None = None, candidates: bool = True):
        """``candidates``: keep the table of all matches too, whose rows grow with the square of a shared session's
        clicks. No other model is built from it. A root is run with it from its first batch on, or without it."""
        self.spark = configure(spark)
        self.candidates = candidates
        self.lookback_days = lookback_days
        self.minutes = match_window_minutes
        self.store = RunState(spark, root or scratch_path(spark, "incremental", new_run_id()))
        if self.store.batch and candidates != ("payment_event_candidates" in self.store.tables):
            raise ValueError(f"{root} was run {'without' if candidates else 'with'} the candidates")

    @property
    def batch(self) -> int:
        """The last committed batch."""
        return self.store.batch

    @property
    def state(self) -> Mapping[str, DataFrame]:
        """The committed tables by name."""
        return _Tables(self.store)

    def run(self, click_landing: DataFrame, pay_landing: DataFrame) -> None:
        """One batch over the landing tables; all its tables or none become the state."""
        with session_conf(self.spark, {**_RUN_CONF, _PARTITIONS: str(_initial_partitions(self.spark))}):
            self.store.begin()
            with ThreadPoolExecutor(2) as both:  # the two feeds don't meet before the attribution
                clicks = both.submit(self._clicks, click_landing)
                pays = both.submit(self._payments, pay_landing)
                click_mark, ev_old, ev_new, sb_old, sb_new = clicks.result()
                pay_mark, p_old, p_new = pays.result()
            self._attribution_and_facts(ev_old, ev_new, sb_old, sb_new, p_old, p_new)
            self.store.commit({"landing_clickstream": click_mark, "landing_payments": pay_mark})

    # -- plumbing ------------------------------------------------------------
    @staticmethod
    def _date(name: str) -> Column | None:
        return None if PARTS[name] is None else F.col(PARTS[name])

    def _merge(self, name: str, rebuilt: DataFrame, keys: list[str], touched: DataFrame | None = None,
               keep_old: bool = True, within: Iterable[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
        return self.store.merge(name, rebuilt, keys, self._date(name), touched, keep_old, TIME_ORDERED.get(name, ()), within)

    @staticmethod
    def _both(old: DataFrame | None, new: DataFrame, *cols) -> DataFrame:
        """Key columns taken from the old and the new version of rebuilt rows."""
        out = new.select(*cols)
        return out if old is None else out.unionByName(old.select(*cols))

    def _touched(self, name: str, keys: DataFrame) -> DataFrame:
        return self.store.scratch(f"touched-{name}", keys.distinct())

    def _stage(self, name: str, landing: DataFrame, mark: str,
               stage: Callable[[DataFrame], DataFrame]) -> tuple[str | None, DataFrame, DataFrame | None]:
        """Stage a batch alone and merge it into the ledger.

        Returns (landing watermark, staged rows that are new or another delivery than the ledger's, the ledger's rows
        that they replace). The best delivery of a payload in the slice is the best of all: what the ledger holds is
        either older than the slice or in it.
        """
        seen = self.store.marks.get(mark)
        slice_ = landing if seen is None else inc.lookback(landing, "ingested_at", dt.datetime.fromisoformat(seen), self.lookback_days)
        # of the raw documents later jobs read the payment payload alone
        staged = stage(slice_).drop(*(staging.RAW if name == "stg_clickstream_events" else staging.RAW[:2])).withColumn(PART, part_of(self._date(name)))
        if self.store.parts(name) is None:
            self.store.replace(name, staged)
            changed, prior = self.store.read(name), None
        else:
            fresh = self.store.scratch(f"{name}-slice", staged)
            # what lies in a part that the ledger hasn't is new: only the rest meets the ledger
            held = {r[0] for r in fresh.select(PART).distinct().collect()} & self.store.parts(name)
            ledger, known = self.store.read(name, held), fresh.where(F.col(PART).isin(sorted(held)))
            changed = self.store.scratch(f"{name}-new", fresh.where(~F.col(PART).isin(sorted(held))).unionByName(
                known.join(ledger, inc._null_safe_on(known, ledger, DELIVERY), "left_anti")))
            self.store.forget(f"{name}-slice")
            again = changed.where(F.col(PART).isin(sorted(held))).select("payload_hash")
            prior = self.store.scratch(f"{name}-old", inc.semi_null_safe(ledger, again, ["payload_hash"], False))
            parts = {r[0] for r in changed.select(PART).distinct().collect()}
            if parts:
                ledger = self.store.read(name, parts & held)
                kept = ledger.join(again, ledger["payload_hash"].eqNullSafe(again["payload_hash"]), "left_anti")
                self.store.replace(name, kept.unionByName(changed), parts)
        latest = changed.agg(F.max("ingested_at")).first()[0]
        newest = as_mark(latest)
        return max(filter(None, (newest, seen)), default=None), changed, prior

    # -- clickstream: events and sessions -------------------------------------
    def _clicks(self, landing: DataFrame):
        mark, changed, prior = self._stage("stg_clickstream_events", landing, "landing_clickstream", staging.stage_clickstream)
        pk = {"event_pk": F.coalesce(blank_to_null("event_id"), F.col("payload_hash"))}
        if prior is None:
            history, keys = changed, None
        else:
            keys = self._touched("events", self._both(prior, changed, pk["event_pk"].alias("event_pk")).where("event_pk is not null"))
            history = self.store.rows_of("stg_clickstream_events", keys, pk, distinct=False, born=True, nulls=False)
        ev_old, ev_new = self._merge("fct_events", events.fct_events(history.drop(PART)), ["event_pk"], touched=keys)

        # every session with a rebuilt event (old or new session id)
        if ev_old is None and self.store.parts("sessions_base") is None:
            sb_old, sb_new = self._merge("sessions_base", sessions.sessions_base(ev_new), ["session_id"])
        else:
            keys = self._touched("sessions", self._both(ev_old, ev_new, F.col("user_session").alias("session_id"))
                                 .where("session_id is not null"))
            sb_old, sb_new = self._merge("sessions_base", sessions.sessions_base(
                self.store.rows_of("fct_events", keys, {"session_id": F.col("user_session")}, distinct=False, born=True, nulls=False)),
                ["session_id"], touched=keys)
        return mark, ev_old, ev_new, sb_old, sb_new

    # -- payments: feed, intents, charges, refunds, rejects, fact -------------
    def _payments(self, landing: DataFrame):
        mark, changed, prior = self._stage("stg_payment_events", landing, "landing_payments", staging.stage_payments)
        store, obj_id, first = self.store, blank_to_null("object.id"), prior is None
        clean_pk = F.coalesce(blank_to_null("provider_event_id"), blank_to_null("envelope_event_id"), F.col("payload_hash"))

        def rebuilt(name: str, source: str, new: DataFrame, old: DataFrame | None, keys: dict[str, Column], build,
                    only: Column | None = None, nulls: bool = False, keep_old: bool = True):
            """Merge ``build`` over the history of all keys that rows of ``source`` changed for."""
            if first:
                return self._merge(name, build(new.drop(PART)), list(keys), keep_old=keep_old)
            both = self._both(old, new, "*") if only is None else self._both(old, new, "*").where(only)
            ids = both.select(*[c.alias(k) for k, c in keys.items()])
            if not nulls:
                ids = ids.dropna()
            ids = self._touched(name, ids)
            rows = store.rows_of(source, ids, keys, distinct=False, born=True, nulls=nulls)
            return self._merge(name, build((rows if only is None else rows.where(only)).drop(PART)), list(keys), touched=ids, keep_old=keep_old)

        def of_type(prefix: str) -> Column:
            return F.lower("event_type").startswith(prefix) & F.col("object.id").isNotNull()

        no_id = F.col("object.id").isNull()
        with ThreadPoolExecutor(4) as each:
            charges = each.submit(rebuilt, "charges", "stg_payment_events", changed, prior, {"charge_id": obj_id}, payments.charges, of_type("charge."))
            refunds = each.submit(rebuilt, "refunds", "stg_payment_events", changed, prior, {"refund_id": obj_id}, payments.refunds,
                                  of_type("refund."), nulls=True)
            # rejects: keyed on the provider event id (the reference's key is always NULL)
            no_charge = each.submit(rebuilt, "charges_invalid", "stg_payment_events", changed, prior, {"provider_event_id": F.col("provider_event_id")},
                                    payments.charges_invalid, F.lower("event_type").startswith("charge.") & no_id, nulls=True, keep_old=False)
            cl_old, cl_new = rebuilt("payment_events_clean", "stg_payment_events", changed, prior, {"event_pk": clean_pk},
                                     payments.clean_payment_events)
            no_intent = each.submit(rebuilt, "payment_intents_invalid", "payment_events_clean", cl_new, cl_old,
                                    {"provider_event_id": F.col("provider_event_id")}, payments.payment_intents_invalid,
                                    F.lower("event_type").startswith("payment_intent.") & no_id, nulls=True, keep_old=False)
            i_old, i_new = rebuilt("payment_intents", "payment_events_clean", cl_new, cl_old, {"payment_intent_id": obj_id},
                                   payments.payment_intents, of_type("payment_intent."))
            (c_old, c_new), (r_old, r_new), *_ = [x.result() for x in (charges, refunds, no_charge, no_intent)]

        if first:
            p_old, p_new = self._merge("fct_payments", payments.fct_payments(i_new, c_new, r_new), ["payment_intent_id"])
            return mark, p_old, p_new
        # intents whose fact changes: their own rows, their charges, refunds of those charges
        links = store.read("charges").select("charge_id", "payment_intent_id")
        if c_old is not None:
            links = links.unionByName(c_old.select("charge_id", "payment_intent_id"))
        keys = self._touched("payments", self._both(i_old, i_new, "payment_intent_id")
                             .unionByName(self._both(c_old, c_new, "payment_intent_id"))
                             .unionByName(self._both(r_old, r_new, "charge_id").join(links, "charge_id").select("payment_intent_id"))
                             .dropna())
        some = store.rows_of("payment_intents", keys, ["payment_intent_id"], distinct=False)
        theirs = store.scratch("charges-of-touched", store.rows_of("charges", keys, ["payment_intent_id"], distinct=False))
        refunds = store.rows_of("refunds", theirs.select("charge_id"), ["charge_id"])
        p_old, p_new = self._merge("fct_payments", payments.fct_payments(some, theirs, refunds), ["payment_intent_id"], touched=keys)
        return mark, p_old, p_new

    # -- what needs both feeds -------------------------------------------------
    def _attribution_and_facts(self, ev_old, ev_new, sb_old, sb_new, p_old, p_new) -> None:
        store, w = self.store, self.minutes
        first = store.parts("map_payment_to_event") is None
        pays = store.read("fct_payments")

        # rebuilt payments, plus payments within the window of a rebuilt click
        # (a late click can become an older payment's best match)
        if first:
            touched_p, cand_src = None, pays
        else:
            ev_changed = self._both(ev_old, ev_new, "event_pk", "event_time", "received_ts",
                                    "event_type", "user_id", "user_session", *matching.CARRIED)
            near = self._near(ev_changed)
            touched_p = self._touched("attribution", self._both(p_old, p_new, "payment_intent_id").unionByName(near))
            cand_src = store.scratch("touched-payment-rows", store.rows_of("fct_payments", touched_p, ["payment_intent_id"], distinct=False))
        around = self._clicks_around(cand_src)
        with ThreadPoolExecutor(1) as other:  # nothing else is built from the candidates
            pairs = other.submit(self._all_pairs, cand_src, around, touched_p) if self.candidates else None
            self._mappings_and_facts(first, pays, cand_src, around, touched_p, ev_old, ev_new, sb_old, sb_new, p_old, p_new)
            if pairs is not None:
                pairs.result()

    def _all_pairs(self, cand_src: DataFrame, around: DataFrame, touched_p: DataFrame | None) -> None:
        """Merge the candidates of these payments. They are many times the payments, whose days are the parts that can gain
        some, so the pairs are written once. Joined by sorting they come out in an order that takes few bytes."""
        day = part_of(F.col("payment_intent_event_ts"))
        within = None if touched_p is None else {r[0] for r in cand_src.select(day).distinct().collect()}
        self._merge("payment_event_candidates", matching.match_candidates(cand_src.hint("merge"), around, self.minutes, prefilter=False),
                    ["payment_intent_id"], touched=touched_p, keep_old=False, within=within)

    def _mappings_and_facts(self, first, pays, cand_src, around, touched_p, ev_old, ev_new, sb_old, sb_new, p_old, p_new) -> None:
        store, w = self.store, self.minutes
        me_old, me_new = self._merge("map_payment_to_event", matching.nearest_click(cand_src, around, w),
                                        ["payment_intent_id"], touched=touched_p)
        # session mapping: also payments whose matched session was rebuilt
        if first:
            touched_ps, mapped = None, me_new
            found = store.read("sessions_base")
        else:
            rebuilt = self._both(sb_old, sb_new, "session_id").distinct()
            via = store.rows_of("map_payment_to_event", rebuilt, {"session_id": F.col("event_user_session")})
            touched_ps = self._touched("payment-sessions", touched_p.unionByName(via.select("payment_intent_id")))
            mapped = store.scratch("mapped", store.rows_of("map_payment_to_event", touched_ps, ["payment_intent_id"], distinct=False))
            found = store.rows_of("sessions_base", mapped.select(F.col("event_user_session").alias("session_id")).dropna(), ["session_id"])
        ms_old, ms_new = self._merge("map_payment_to_session", matching.map_payment_to_session(mapped, found),
                                            ["payment_intent_id"], touched=touched_ps)

        with ThreadPoolExecutor(2) as both:  # the product facts don't need the sessions
            products = both.submit(self._product_facts, first, ev_old, ev_new, me_old, me_new, p_old, p_new)
            users = both.submit(self._user_facts, first, sb_old, sb_new, ms_old, ms_new, p_old, p_new)
            products.result()
            users.result()

    @staticmethod
    def _old_measures(measures: Callable[..., DataFrame], *versions: tuple[DataFrame | None, DataFrame]) -> DataFrame | None:
        """Measure rows of the old versions; None if nothing had one."""
        if all(old is None for old, _ in versions):
            return None
        return measures(*[new.limit(0) if old is None else old for old, new in versions])

    def _add_signed(self, name: str, added: DataFrame, removed: DataFrame | None, keys: list[str], measures: list[str], build) -> None:
        """Daily rows of touched keys from their stored sums, the new versions added and the old ones taken away.

        Only the stored rows of these keys are read, in the parts that are written anew.
        """
        added = self.store.scratch(f"{name}-added", added.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in [*measures, activity.SOURCE_ROWS]]))
        if removed is not None:
            removed = self.store.scratch(f"{name}-removed", removed.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in [*measures, activity.SOURCE_ROWS]]))
        touched = self._touched(name, self._both(removed, added, *keys))
        stored = self.store.rows_of(name, touched, keys, distinct=False)
        self._merge(name, build(activity.signed_change(stored, added, removed, keys, measures), True), keys, touched=touched, keep_old=False)

    def _span(self, lo: dt.datetime, hi: dt.datetime, days: int) -> list[str]:
        """Parts of the days from ``lo`` to ``hi``, widened by ``days``."""
        first, last = lo.date() - dt.timedelta(days=days), hi.date() + dt.timedelta(days=days)
        return [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]

    def _clicks_around(self, pays: DataFrame) -> DataFrame:
        """Clicks that lie within the window of one of these payments' times, read from the parts of those days."""
        lo, hi = pays.agg(F.min("payment_intent_event_ts"), F.max("payment_intent_event_ts")).first()
        clicks = self.store.read("fct_events", [] if lo is None else self._span(lo, hi, 1 + self.minutes // 1440))
        if lo is None:
            return clicks
        span = dt.timedelta(minutes=self.minutes)
        return clicks.where(F.col("event_time").between(F.lit(lo - span).cast("timestamp_ntz"), F.lit(hi + span).cast("timestamp_ntz")))

    def _near(self, clicks: DataFrame) -> DataFrame:
        """Payments within the window of one of these clicks."""
        lo, hi = clicks.agg(F.min("event_time"), F.max("event_time")).first()
        if lo is None:
            return self.store.read("fct_payments", []).select("payment_intent_id")
        span = dt.timedelta(minutes=self.minutes)
        pays = self.store.read("fct_payments", self._span(lo, hi, 1 + self.minutes // 1440)).where(
            F.col("payment_intent_event_ts").between(F.lit(lo - span).cast("timestamp_ntz"), F.lit(hi + span).cast("timestamp_ntz")))
        return matching.nearest_click(pays, clicks, self.minutes).select("payment_intent_id")  # one row, however many clicks

    def _user_facts(self, first, sb_old, sb_new, ms_old, ms_new, p_old, p_new) -> None:
        store = self.store
        if first:
            pays = store.read("fct_payments")
            _, fs_new = self._merge("fct_sessions", sessions.fct_sessions(store.read("sessions_base").drop(PART), ms_new, pays), ["session_id"])
            self._merge("fct_user_daily_activity", activity.user_days(activity.user_day_measures(fs_new, pays), True), activity.USER_DAY)
            self._merge("dim_users", activity.dim_users(fs_new, pays), ["user_id"])
            return
        # rebuilt sessions and sessions gaining / losing payments
        # (payments whose amount or status changed reach theirs via the session mapping)
        keys = self._touched("session-facts", self._both(sb_old, sb_new, "session_id")
                             .unionByName(self._both(ms_old, ms_new, "session_id")).dropna())
        theirs = store.scratch("payments-of-sessions", store.rows_of("map_payment_to_session", keys, ["session_id"], distinct=False).select("payment_intent_id", "session_id"))
        fs_old, fs_new = self._merge(
            "fct_sessions", sessions.fct_sessions(store.rows_of("sessions_base", keys, ["session_id"], distinct=False).drop(PART), theirs,
                                                  store.rows_of("fct_payments", theirs, ["payment_intent_id"])),
            ["session_id"], touched=keys)
        # (user, day): the stored sums and what old and new sessions and payments change in them
        added = activity.user_day_measures(fs_new, p_new)
        removed = self._old_measures(activity.user_day_measures, (fs_old, fs_new), (p_old, p_new))
        changed = self._both(fs_old, fs_new, "user_id").unionByName(self._both(p_old, p_new, "user_id"))
        with ThreadPoolExecutor(1) as other:
            days = other.submit(self._add_signed, "fct_user_daily_activity", added, removed, activity.USER_DAY, activity.USER_MEASURES, activity.user_days)
            keys = self._touched("users", changed.select("user_id"))
            self._merge("dim_users", activity.dim_users(store.rows_of("fct_sessions", keys, ["user_id"], distinct=False),
                                                         store.rows_of("fct_payments", keys, ["user_id"], distinct=False)),
                        ["user_id"], touched=keys, keep_old=False)
            days.result()

    def _product_facts(self, first, ev_old, ev_new, me_old, me_new, p_old, p_new) -> None:
        store = self.store
        if first:
            self._merge("fct_product_daily_activity", activity.product_days(activity.product_day_measures(ev_new, me_new, p_new), True),
                        activity.PRODUCT_DAY)
            self._merge("dim_products", activity.dim_products(ev_new), ["product_id"])
            return
        # (product, day): the stored sums and what old and new events and attributions change in them. A touched payment
        # that didn't change itself counts with its present values on both sides.
        now = store.scratch("payments-of-mappings", store.rows_of("fct_payments", self._both(me_old, me_new, "payment_intent_id"), ["payment_intent_id"]))
        added = activity.product_day_measures(ev_new, me_new, now)
        before = now
        if p_old is not None:
            known = p_new.select("payment_intent_id").unionByName(p_old.select("payment_intent_id")).distinct()
            before = now.join(known, "payment_intent_id", "left_anti").unionByName(p_old)
        removed = self._old_measures(lambda e, m: activity.product_day_measures(e, m, before), (ev_old, ev_new), (me_old, me_new))
        with ThreadPoolExecutor(1) as other:
            days = other.submit(self._add_signed, "fct_product_daily_activity", added, removed, activity.PRODUCT_DAY, activity.PRODUCT_MEASURES,
                                activity.product_days)
            keys = self._touched("products", self._both(ev_old, ev_new, "product_id").dropna())
            self._merge("dim_products", activity.dim_products(store.rows_of("fct_events", keys, ["product_id"], distinct=False)), ["product_id"],
                        touched=keys, keep_old=False)
            days.result()
