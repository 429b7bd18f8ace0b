"""Detection on a stream of lines, with the operators of the batch job.

Each micro-batch is normalised once and evaluated together with the state: the
recent candidates of the rate rules, 2 N at most for each cell of time of a (rule, ip).
The state is one small table per batch, keyed by rule name, so it survives a restart and
a change of rules. Events are committed under the key of the batch to an ``EventStore``,
which ``scan_events`` reads; all else a batch writes goes to paths named after the batch
and replaces what is there. A batch that is run again leaves the same result.

How long a candidate is kept is told by its age since arrival, not by its stamp, so no
stamp, in the future or long past, makes the stream forget others. Age is the running
time of the stream: a pause between two batches counts for ``PAUSE_SECONDS`` at most,
so a stream that was down finds its state, as the lines that waited expect it.

State of one address is not bound to one task, as it would be in a keyed
stateful operator: the batch's shuffles spread a flooding address by time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigilog.functions.timestamps import wall_clock
from vigilog.operators.detect import apply_rules, decide, spread_tests
from vigilog.operators.normalize import parse_lines
from vigilog.operators.outputs import alert_messages, event_feed_json
from vigilog.operators.rate import (
    constant_tests,
    edges_of_cells,
    must_count,
    rate_candidates,
    rate_firings,
    rate_outcomes,
    rate_rules,
)
from vigilog.operators.search import LIVE_ROWS, live_window
from vigilog.operators.stats import events_total
from vigilog.operators.timeline import timeline_counts
from vigilog.schema import EVENTS
from vigilog.sources.commits import COMMITS, EventStore, plain
from vigilog.sources.rules import Rule

STATE = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("ip_key", T.StringType()),
        T.StructField("us", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("age", T.LongType()),  # microseconds since arrival, as of ``at``
        T.StructField("at", T.LongType()),
    ]
)
# Events may be this late and still find the state of their time.
DELAY_SECONDS = 900
PAUSE_SECONDS = 60
_LIVE = T.StructType([*EVENTS.fields, T.StructField("batch", T.LongType())])
# A batch reads the state of the one before it, so three places are enough.
_STATE_SLOTS = 3

# seq of a line without one: the batch in the upper bits, its place in the batch below
_PLACE_BITS = 36


def number_lines(lines: DataFrame, batch_id: int) -> DataFrame:
    """``lines`` with ``seq``, the order of arrival over batches: up to 2^36 lines a batch.

    Places are counted without gaps: rows within their partition, and before them the
    rows of the partitions before, of which there is one number for each partition.
    """
    rows = lines.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    seq = F.lit(batch_id << _PLACE_BITS) + place
    return rows.join(F.broadcast(parts), "_part").select(seq.alias("seq"), *lines.columns)


class DetectionStream:
    """Writes events, rejected lines, alerts, feed messages, counters and timeline counts below ``out``.

    ``rules`` are a list, or a function that gives the list for a batch: it is called for
    each batch, so rules can change while the stream runs. ``rate_clock`` is ``event``
    (time in the line) or ``processing`` (time of the micro-batch). ``initial_state``
    takes over the state of another stream. Every ``compact_every`` batches the event
    folders are gathered. ``clock`` gives the time, for tests.
    """

    def __init__(
        self,
        rules: Sequence[Rule] | Callable[[int], Sequence[Rule]],
        out: str,
        *,
        ref_year: int | None = None,
        rate_clock: str = "event",
        delay_seconds: int = DELAY_SECONDS,
        initial_state: str | None = None,
        compact_every: int = COMMITS,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    ) -> None:
        if rate_clock not in ("event", "processing"):
            raise ValueError(f"rate_clock must be event or processing: {rate_clock!r}")
        self.rules_of = rules if callable(rules) else lambda batch_id, fixed=list(rules): fixed
        self.out = out.rstrip("/")
        self.ref_year = ref_year
        self.rate_clock = rate_clock
        self.delay_seconds = delay_seconds
        self.initial_state = initial_state
        self.compact_every = compact_every
        self.clock = clock

    def start(self, lines: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on a stream of ``(source, line)``, with or without ``seq``."""
        writer = lines.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()

    def path(self, output: str, batch_id: int) -> str:
        return f"{self.out}/{output}/batch={batch_id}"

    def state_path(self, batch_id: int) -> str | None:
        if batch_id < 0:
            return self.initial_state
        return f"{self.out}/state/slot={batch_id % _STATE_SLOTS}"

    def process(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        # one fixed time for the batch: all its jobs must see the same
        at = self.clock().astimezone(timezone.utc).replace(tzinfo=None)
        now = wall_clock(at)
        rules = list(self.rules_of(batch_id))
        store = self.store(spark)
        if "ingest_ts" not in lines.columns:
            lines = lines.withColumn("ingest_ts", now)
        numbered = "seq" in lines.columns
        if not numbered:
            lines = lines.persist(StorageLevel.DISK_ONLY)  # places are counted and then given: one order for both
        # what is stored is all that the batch parses: events and rejected lines
        placed = lines if numbered else number_lines(lines, batch_id)
        parsed = parse_lines(placed, ref_year=self.ref_year).persist(StorageLevel.DISK_ONLY)
        try:
            events = parsed.where("is_event").drop("is_event", "line")
            store.commit(self._detect(events, rules, at, batch_id), _key(batch_id))
            dated = store.scan(key=_key(batch_id))
            stored, newest = dated.drop("event_date"), dated.where(store.newest_of_each(LIVE_ROWS, _key(batch_id))).drop("event_date")
            _write_all(
                spark,
                {
                    self.path("rejected", batch_id): parsed.where(~F.col("is_event")).select("seq", "source", "line"),
                    self.path("feed", batch_id): event_feed_json(stored),
                    self._live_path(batch_id): self._newest(newest, batch_id),
                    self.path("alerts", batch_id): alert_messages(stored),
                    self.path("timeline", batch_id): timeline_counts(stored),
                    self.path("counters", batch_id): events_total(stored),
                },
            )
        finally:
            parsed.unpersist()
            if not numbered:
                lines.unpersist()
        if self.compact_every and len(store.keys()) > self.compact_every:
            store.compact()

    def store(self, spark: SparkSession) -> EventStore:
        return EventStore(spark, f"{self.out}/events")

    def _live_path(self, batch_id: int) -> str:
        return f"{self.out}/live/slot={batch_id % _STATE_SLOTS}"

    def _newest(self, stored: DataFrame, batch_id: int) -> DataFrame:
        """The newest LIVE_ROWS of every source and severity, up to this batch: what any filter of the live view can show."""
        spark = stored.sparkSession
        before = spark.createDataFrame([], _LIVE) if batch_id <= 0 else spark.read.schema(_LIVE).parquet(self._live_path(batch_id - 1))
        rows = stored.unionByName(before.drop("batch"))
        rank = F.row_number().over(Window.partitionBy("source", "severity").orderBy(F.desc("ts"), F.desc("seq")))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= LIVE_ROWS).select(*EVENTS.names, F.lit(batch_id).cast("long").alias("batch"))

    def live(self, spark: SparkSession, severity: str | None = None, source: str | None = None) -> DataFrame:
        """The live view after the last batch, as ``live_window`` gives it over all events."""
        slots = spark.read.schema(_LIVE).option("recursiveFileLookup", True).parquet(f"{self.out}/live")
        last = slots.agg(F.max("batch")).first()[0]
        return live_window(slots.where(F.col("batch") == F.lit(last)).drop("batch"), severity, source)

    def _detect(self, events: DataFrame, rules: Sequence[Rule], at: datetime, batch_id: int) -> DataFrame:
        rated = rate_rules(rules)
        clock, now_us = "ts", (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        if self.rate_clock == "processing":
            clock = "_clock"
            events = events.withColumn(clock, wall_clock(at))
        state = self.state_path(batch_id)
        if not must_count(rated):
            # rules without rates come and go: the state stays for those that have one
            self._previous(events.sparkSession, batch_id).write.mode("overwrite").parquet(state)
            return apply_rules(events, rules, spread_tests(rules, constant_tests(rated)), EVENTS.names)
        fresh = rate_candidates(events, rated, clock).withColumn("age", F.lit(0).cast("long"))
        edges = edges_of_cells(fresh.unionByName(self._state(events.sparkSession, rated, now_us, batch_id)), rated)
        named = edges.groupBy(_rule_name(rated).alias("rule"), "ip_key", "us", "seq").agg(F.min("age").alias("age"))
        named.withColumn("at", F.lit(now_us)).write.mode("overwrite").parquet(state)

        written = _numbered(events.sparkSession.read.schema(STATE).parquet(state), rated)
        outcomes = rate_outcomes(rate_firings(written.drop("age"), rated), rated)
        return decide(events, rules, outcomes, EVENTS.names, clock, store=lambda df, name: self._kept(df, name, batch_id))

    def _kept(self, table: DataFrame, name: str, batch_id: int) -> DataFrame:
        """A table that the batch needs itself, written and read back; as the batch's state, it is replaced later on."""
        path = f"{self.out}/{name}/slot={batch_id % _STATE_SLOTS}"
        table.write.mode("overwrite").parquet(path)
        return table.sparkSession.read.schema(table.schema).parquet(path)

    def _previous(self, spark: SparkSession, batch_id: int) -> DataFrame:
        previous = self.state_path(batch_id - 1)
        return spark.createDataFrame([], STATE) if previous is None else spark.read.schema(STATE).parquet(previous)

    def _state(self, spark: SparkSession, rated: Sequence[Rule], now_us: int, batch_id: int) -> DataFrame:
        """Candidates of earlier batches, as old as now, that a rate window can still reach."""
        passed = F.least(F.greatest(F.lit(now_us) - F.col("at"), F.lit(0)), F.lit(PAUSE_SECONDS * 1_000_000))
        aged = _numbered(self._previous(spark, batch_id).withColumn("age", F.col("age") + passed), rated)
        reach = F.element_at(F.array(*[F.lit((r.rate[1] + self.delay_seconds) * 1_000_000) for r in rated]), F.col("rule_no") + 1)
        return aged.where(F.col("age") <= reach)

    def outputs(self, spark, output: str, schema: T.StructType) -> DataFrame:
        """What all batches have written, e.g. ``outputs(spark, 'events', EVENTS)``."""
        if output == "events":
            return self.store(spark).scan().select(*schema.names)
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.out}/{output}")


def _write_all(spark: SparkSession, outputs: dict[str, DataFrame]) -> None:
    """Write independent results side by side, so that cores left idle by the end of one serve the next."""
    def write(item: tuple[str, DataFrame]) -> None:
        path, frame = item
        frame.write.mode("overwrite").options(**plain("raw", "line", "message")).parquet(path)

    # the threads belong to the batch's job group, so stopping the stream stops them
    with ThreadPoolExecutor(len(outputs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write), item) for item in outputs.items()]:
            done.result()


def _key(batch_id: int) -> str:
    return f"batch-{batch_id}"


def _rule_name(rated: Sequence[Rule]) -> Column:
    return F.element_at(F.array(*[F.lit(r.name) for r in rated]), F.col("rule_no") + 1)


def _numbered(state: DataFrame, rated: Sequence[Rule]) -> DataFrame:
    """State by position of the rule; rows of rules that are gone are dropped."""
    position = reduce(lambda col, ir: col.when(F.col("rule") == ir[1].name, F.lit(ir[0])), enumerate(rated), F)
    return state.select(position.alias("rule_no"), "ip_key", "us", "seq", "age").where(F.col("rule_no").isNotNull())
