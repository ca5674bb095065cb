"""The daily run — I11 — as a chain of DataFrame operators.

Stages are lazy DataFrames; only configuration-sized control values are
computed on the driver (gates, slot list, widths, lookup names, seed count).
Recipient data flows: profiles + segments → audience (one shuffle join) →
content keys (partial-aggregated distinct) → render (row-local) → join back
(broadcast when checked small, else shuffle join with AQE skew splitting) →
rank (WindowGroupLimit, partial before the shuffle) → tokens → seeds →
dedupe → loyalty → write.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.config import RunParams
from slotwise.operators import allocate, audience, campaigns, deliver, integrity, render, select, skew, slots
from slotwise.operators.util import broadcast_checked, fits_broadcast, gate_rows, measured_size, row_width
from slotwise.plans.ledger import StageLedger, fingerprint
from slotwise.sources import delivery, runlog, tables
from slotwise.session import ensure_checkpoint_dir
from slotwise.sources.runlog import RunLog

# Recipient columns carried to the output (fixed list of the reference).
OUTPUT_RECIPIENT_COLUMNS = [
    "tpid", "eapid", "email_address", "expuserid", "first_name", "mer_status",
    "lang_id", "last_name", "locale", "paid", "test_keys",
]


@dataclass
class Inputs:
    """Everything one run reads. Lookup tables are keyed by the names the
    configuration uses; those it names beyond ``lookups`` are read from
    ``source`` when the launch's bindings are known (A12). Token/seed/loyalty
    tables are already chosen for the scope."""

    config: campaigns.CampaignConfig
    profiles: DataFrame
    segments: DataFrame
    lookups: dict[str, DataFrame]
    account_tokens: DataFrame | None = None
    subscriber_tokens: DataFrame | None = None
    seeds: DataFrame | None = None
    members: DataFrame | None = None
    source: tables.TableSource | None = None


@dataclass
class CampaignRun:
    spark: SparkSession
    params: RunParams
    inputs: Inputs
    log: RunLog | None = None
    counts: dict = field(default_factory=dict)
    cached_lookups: list = field(default_factory=list)
    ledger: StageLedger | None = None
    observed: dict = field(default_factory=dict)
    heavy: dict = field(default_factory=dict)

    def _watched(self, name: str, df: DataFrame, **more) -> DataFrame:
        """The frame with its rows (and ``more`` aggregates) observed by whatever pass
        computes it first: gates and size checks then need no job of their own."""
        obs = self.observed[name] = Observation()
        return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in more.items()])

    def _seen(self, name: str, df: DataFrame) -> dict:
        """What a pass observed. A plan that turned out empty at run time is dropped together
        with its observation; the frame itself is counted then."""
        try:
            return self.observed[name].get
        except Py4JJavaError:
            return defaultdict(lambda: None, rows=df.count())

    # ---- configuration path -------------------------------------------------
    @cached_property
    def module_vars(self) -> DataFrame:
        return self._watched("module variables", campaigns.scoped_module_vars(self.inputs.config.module_vars, self.params.scope, self.params.compat))

    @cached_property
    def meta(self) -> DataFrame:
        """Expanded metadata (configuration-sized); persisted as ``content`` is."""
        df = campaigns.expand_campaigns(self.inputs.config, self.params)
        return self._watched("campaign metadata", df, bytes=F.sum(row_width(df))).persist()

    @cached_property
    def content(self) -> DataFrame:
        """Expanded campaign content (configuration-sized); persisted because
        every later stage and several control values read it."""
        df = campaigns.expand_content(self.meta, self.module_vars)
        return self._watched("expanded content", df, bytes=F.sum(row_width(df))).persist()

    @cached_property
    def config_counts(self) -> dict[str, int]:
        """Row counts of the configuration stages, by the pass that builds them.

        One query over the two persisted frames counts what is distinct in them;
        the rows of the frames themselves are observed on the way.
        """
        groups = F.struct(*campaigns.VERSION_GROUP)
        joined = F.col("module_type_id").isNotNull() & F.col("placement_type").isNotNull()
        versions = self.meta.agg(F.lit("version counts").alias("stage"), F.count_distinct(F.when(joined, groups)).alias("n"))
        modules = self.content.agg(F.lit("module content").alias("stage"), F.count_distinct(F.when(F.col("var_position").isNotNull(), F.col("module_id").cast("int"))).alias("n"))
        found = {r.stage: r.n for r in versions.unionByName(modules).collect()}
        frames = {"module variables": self.module_vars, "campaign metadata": self.meta, "expanded content": self.content}
        return {n: self._seen(n, df)["rows"] for n, df in frames.items()} | found

    @cached_property
    def config_size(self) -> tuple[int, int]:
        """Rows and bytes of the expanded content and the metadata together.
        Every configuration-derived frame (offered modules, module variables,
        launch campaigns, module counts) is a projection or aggregate of one of
        the two, so this bounds each of them."""
        self.config_counts  # noqa: B018 - builds both frames
        seen = [self._seen("expanded content", self.content), self._seen("campaign metadata", self.meta)]
        return sum(x["rows"] for x in seen), sum(x["bytes"] or 0 for x in seen)

    @cached_property
    def layout(self) -> dict:
        """Slot list + widths, recipient attributes, lookup joins."""
        return render.launch_layout(self.content)

    @cached_property
    def slots(self) -> list[tuple[int, int]]:
        """Launch-wide (slot, width) list — configuration metadata."""
        return self.layout["slots"]

    @cached_property
    def lookup_specs(self) -> list[render.LookupSpec]:
        specs = self.layout["lookups"]
        if self.inputs.source is not None:
            names = sorted({s.table for s in specs} - self.inputs.lookups.keys())
            self.inputs.lookups |= tables.load_lookups(self.spark, names, self.inputs.source)
        missing = render.missing_lookups(specs, self.inputs.lookups)
        if missing:
            raise RuntimeError("lookup tables/columns not available: " + ", ".join(f"{t}.{c}" for t, c in missing))
        return specs

    @cached_property
    def attributes(self) -> list[str]:
        return self.layout["attributes"]

    # ---- recipient path -----------------------------------------------------
    @cached_property
    def audience(self) -> DataFrame:
        """Recipients × campaigns. Persisted: cohorts, content keys and the
        join-back all read it, and it is the one table built by a shuffle
        join of two recipient-sized inputs."""
        assigned = audience.assign_campaigns(self.inputs.segments, self.meta, self.params.max_broadcast_rows, self.config_size)
        columns = [c for c in (*OUTPUT_RECIPIENT_COLUMNS, *self.attributes) if c not in assigned.columns or c in audience.RECIPIENT_KEYS]
        profiles = audience.read_profiles(self.inputs.profiles)
        build = lambda: audience.build_audience(assigned, profiles, columns, self.params.heavy_share)
        if self.params.checkpoint_audience and self.ledger is None:
            ensure_checkpoint_dir(self.spark)
            return build().checkpoint(eager=True).persist()
        if self.ledger is not None:
            return self.ledger.stage("audience", build)
        return build().persist()

    def _heavy(self, kind: str) -> list[str]:
        """Frequent accounts, campaigns or content keys of the audience, counted over its persisted rows."""
        if not self.params.heavy_share:
            return []
        if kind not in self.heavy:
            keys = {"accounts": ["paid"], "campaigns": ["campaign_id"]}.get(kind)
            keys, null_safe = (keys, False) if keys else (audience.content_key_columns(self.attributes), True)
            self.heavy[kind] = skew.heavy_keys(self.audience, keys, self.params.heavy_share, null_safe)
        return self.heavy[kind]

    @cached_property
    def key_rows(self) -> int:
        """Content keys; counting them builds the audience."""
        return self.content_keys.count()

    @cached_property
    def audience_rows(self) -> int:
        self.key_rows  # noqa: B018
        return self.audience.count()

    @cached_property
    def cohorts(self) -> DataFrame:
        return audience.cohorts(self.audience)

    @cached_property
    def cohort_rows(self) -> int:
        return self.cohorts.count()

    @cached_property
    def allocated(self) -> DataFrame:
        """Per-cohort candidates; persisted because their size decides how they are joined."""
        p = self.params
        return allocate.allocation(self.cohorts, self.content, p.rotation_seed(), p.max_broadcast_rows, self.config_size).persist()

    @cached_property
    def allocation(self) -> DataFrame:
        """The cohorts that have candidates, from the persisted rows."""
        return self.allocated.filter(F.size("slot_cands") > 0)

    @cached_property
    def allocation_size(self) -> tuple[int, int]:
        """Rows and bytes of the allocation, by the pass that builds it; the cohorts are counted with it."""
        self.cohort_rows  # noqa: B018
        return measured_size(self.allocation)

    @cached_property
    def content_keys(self) -> DataFrame:
        """Distinct content keys; persisted because it is counted (sharing
        decision) and then rendered."""
        return audience.content_keys(self.audience, self.attributes).persist()

    @cached_property
    def share_content(self) -> bool:
        """Render once per content key and join back, or render in place?

        Sharing pays when keys repeat: with ``share_ratio`` audience rows per
        key or more, rendering once per key saves more than the join back
        costs (a broadcast while the rendered table is small, else a shuffle
        join whose hot keys AQE splits). When keys are about as many as rows (a
        template naming a per-recipient attribute), every audience row is
        rendered where it sits.
        """
        if self.params.share_content is not None:
            return self.params.share_content
        return self.key_rows * self.params.share_ratio <= self.audience_rows

    def _render(self, rows: DataFrame) -> DataFrame:
        """Lookup values, allocation, rendering and slot fold on any frame
        holding the content-key columns (keys or whole audience rows)."""
        p = self.params
        rows = render.attach_values(
            rows, self.attributes, self.lookup_specs, self.inputs.lookups, p.scope, p.max_broadcast_rows, p.max_broadcast_bytes,
            self.cached_lookups, self.audience_rows,
        )
        rows = render.content_rows(
            rows, self.allocation, self.content, p.missing, p.max_broadcast_rows, p.max_broadcast_bytes, self.config_size, self.allocation_size,
            [] if fits_broadcast(self.config_size, p.max_broadcast_rows) else self._heavy("campaigns"),
        )
        return slots.fill_slots(render.render_slots(rows, p.rotation_seed(), p.missing), self.slots)

    @cached_property
    def slot_contents(self) -> DataFrame:
        """One row per content key: wide slot columns, trace, campaign priority."""
        keys = audience.content_key_columns(self.attributes)
        return self._render(self.content_keys).select(*keys, *slots.personalise_columns(self.slots, self.params.compat))

    @cached_property
    def rendered(self) -> DataFrame:
        """``slot_contents`` for the join back. Persisted: its size check materialises it."""
        return self.slot_contents.persist()

    @cached_property
    def rendered_size(self) -> tuple[int, int]:
        return measured_size(self.rendered)

    @cached_property
    def personalised(self) -> DataFrame:
        """C14 + C15: content for every recipient, launch time attached.

        Shared: content joined back by content key (null-safe on the attribute
        columns, Q7), broadcast under the checked bound. In place: the same
        rendering applied to the audience rows directly.
        """
        keys = audience.content_key_columns(self.attributes)
        slot_cols = slots.personalise_columns(self.slots, self.params.compat)
        if self.share_content:
            out_cols = [c for c in self.rendered.columns if c not in keys]
            content = self.rendered.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *out_cols)
            cond = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
            seen = self.rendered_size
            if seen[0] <= self.params.max_broadcast_rows and seen[1] <= self.params.max_broadcast_bytes:
                joined = self.audience.join(F.broadcast(content), cond)
            else:
                # a content key that many recipients share would fill one partition
                joined = skew.salted_join(self.audience, self.rendered, keys, "inner", self._heavy("contents"), skew.salts_for(self.audience), null_safe=True)
            joined = joined.select(*OUTPUT_RECIPIENT_COLUMNS, "campaign_id", *out_cols)
        else:
            joined = self._render(self.audience).select(*OUTPUT_RECIPIENT_COLUMNS, "campaign_id", *slot_cols)
        joined = joined.withColumn("ModuleCount", F.lit(len(self.slots)))
        # Launch times of the day's campaigns. Taken from the metadata: a row of
        # the result always belongs to a campaign that made it into ``meta``.
        launch = self.meta.select("campaign_id", "locale", "LaunchDateTimeUTC").distinct()
        return joined.join(broadcast_checked(launch, self.params.max_broadcast_rows, self.config_size, closer=True), ["campaign_id", "locale"])

    @cached_property
    def best(self) -> DataFrame:
        """Rank, then suppress (Q18); campaign id as int."""
        return self.ledger.stage("best", self._best) if self.ledger is not None else self._best()

    def _best(self) -> DataFrame:
        ranked = select.best_campaign(self.personalised)
        kept = select.suppress(ranked, self.params.required_slots)
        return kept.withColumn("campaign_id", F.col("campaign_id").cast("int"))

    @cached_property
    def with_tokens(self) -> DataFrame:
        """I8: accounts only, click tokens attached."""
        return deliver.add_tokens(deliver.has_account(self.best), self.inputs.account_tokens, self.inputs.subscriber_tokens, self._heavy("accounts"))

    @cached_property
    def sendable(self) -> DataFrame:
        """``with_tokens`` for the seeds. Persisted: the output and the sample both read it,
        and each would render every recipient."""
        return self.with_tokens.persist()

    @cached_property
    def seeds(self) -> DataFrame:
        return select.active_seeds(self.inputs.seeds, self.params.scope).persist()

    @cached_property
    def n_seeds(self) -> int:
        return self.seeds.count() if self.inputs.seeds is not None else 0

    @cached_property
    def seeded(self) -> DataFrame:
        """Seed rows appended (a marker column keeps seeds per campaign apart, Q10)."""
        if self.n_seeds == 0:
            return self.with_tokens.withColumn("_seed_campaign", F.lit(None).cast("int"))
        base = self.sendable.withColumn("_seed_campaign", F.lit(None).cast("int"))
        extra = select.seed_rows(
            self.sendable, self.seeds, self.n_seeds, self.params.max_broadcast_rows, self.params.max_broadcast_bytes
        ).withColumn("_seed_campaign", F.col("campaign_id"))
        return select.append_seeds(base, extra)

    @cached_property
    def deduped(self) -> DataFrame:
        counted = deliver.add_module_count(self.seeded, campaigns.module_counts(self.content), self.params.max_broadcast_rows, self.config_size)
        per_campaign = "_seed_campaign" if self.params.seeds_per_campaign and not self.params.compat else None
        return deliver.dedupe_recipients(counted, per_campaign_col=per_campaign).drop("_seed_campaign")

    @cached_property
    def output(self) -> DataFrame:
        """The delivered table."""
        return deliver.finalize(self.deduped, self.inputs.members)

    def release(self) -> None:
        """Unpersist every cached stage of this run (after delivery)."""
        stages = [self.__dict__.get(name) for name in ("meta", "content", "audience", "allocated", "content_keys", "rendered", "sendable", "seeds")]
        for df in [*stages, *self.cached_lookups]:
            if df is not None and df.is_cached:
                df.unpersist()

    # ---- control ------------------------------------------------------------
    def stage_rows(self, name: str) -> int:
        """D-9: rows of a gated stage: of the configuration by the pass that builds it
        (which may count a task that ran again twice), of the recipients counted.
        """
        if name in self.config_counts:
            return self.config_counts[name]
        if name == "audience":
            return self.audience_rows
        return self.cohort_rows if name == "cohorts" else self.allocation_size[0]

    def check_gate(self, name: str) -> int:
        """A stage without rows ends the run."""
        self.counts[name] = gate_rows(self.stage_rows(name), name)
        return self.counts[name]


GATED = (
    "module variables", "campaign metadata", "version counts", "expanded content", "audience", "cohorts", "allocation", "module content",
)


@dataclass
class OutputPaths:
    """Where a run delivers: result parquet, one-row manifest, config snapshot.

    With ``run_id`` the output folder holds whole deliveries side by side
    (``sources/delivery.py``): the run writes its own and is published last, so
    a failure leaves the delivery before it readable. ``manifest`` and
    ``snapshot`` then lie in the same folder and are not given.
    """

    output: str
    manifest: str | None = None
    snapshot: str | None = None
    run_id: str | None = None


def run_campaign(
    spark: SparkSession,
    params: RunParams,
    inputs: Inputs,
    writer=None,
    log: RunLog | None = None,
    paths: OutputPaths | None = None,
    log_writer=None,
    central_writer=None,
    ledger_root: str | None = None,
) -> DataFrame:
    """Build the day's output and deliver it.

    With ``paths`` the result, the manifest and the configuration snapshot are
    written (A9–A11); the output row count for the log is observed on the
    write itself (``Observation``), not by a second job. ``writer`` is an
    alternative sink taking the output frame.

    I10: every stage is a logged step with its row count; a failing step is
    logged with its cause and re-raised. ``log_writer(df)`` appends the step
    rows at the end of the run, failed or not. ``central_writer(df)`` appends
    the run's row of the central log at its start, and at its end with the
    output path (``IsComplete = 1``) or as failed.

    ``ledger_root``: a shared folder in which the large stages are kept, so that
    the same run started again goes on after the last whole one.
    """
    ledger = run_ledger(spark, params, inputs, ledger_root) if ledger_root else None
    run = CampaignRun(spark, params, inputs, log, ledger=ledger)
    log = log or RunLog("campaign run", 0)
    start = log.clock()
    log_id = int(start.timestamp() * 1000)
    central = (lambda done, path=" ": central_writer(log.central_frame(spark, log_id, done, start, path))) if central_writer else (lambda *a: None)
    central(0)
    delivered = " "
    try:
        if params.check_config:
            with log.step("configuration integrity") as box:
                box["rows"] = integrity.check_config(inputs.config, params.scope)
        with log.step("launch layout"):
            run.lookup_specs  # noqa: B018 - parses the bindings and checks the lookups
        for name in GATED:
            with log.step(name) as box:
                box["rows"] = run.check_gate(name)
        with log.step("plan output"):
            out = run.output
        if paths is not None:
            delivered = _deliver(spark, run, out, paths, log)
        if writer is not None:
            with log.step("write output"):
                writer(out)
        central(1, delivered)
    except Exception:
        central(0)
        raise
    finally:
        if log_writer is not None:
            log.write(spark, log_writer)
    if paths is not None or writer is not None:
        run.release()
    return out


def _deliver(spark: SparkSession, run: CampaignRun, out: DataFrame, paths: OutputPaths, log: RunLog) -> str:
    """A9–A11 as logged steps; returns the path of the output."""
    if paths.run_id is not None:
        with log.step("write output", paths.output) as box:
            done = delivery.write_delivery(out, paths.output, paths.run_id, run.params.result_files)
            box["rows"] = done.rows
        with log.step("write snapshot", paths.output):
            delivery.write_run_snapshot(run.content, paths.output, paths.run_id)
        with log.step("publish", done.path):
            delivery.publish(spark, paths.output, done)
        return done.path
    obs = Observation("output")
    with log.step("write output", paths.output) as box:
        tables.write_output(out.observe(obs, F.count(F.lit(1)).alias("rows")), paths.output, run.params.result_files)
        box["rows"] = obs.get["rows"]
    if paths.manifest:
        with log.step("write manifest", paths.manifest):
            tables.write_manifest(spark, paths.output, paths.manifest)
    if paths.snapshot:
        with log.step("write snapshot", paths.snapshot):
            tables.write_snapshot(run.content, paths.snapshot)
    return paths.output


def run_ledger(spark: SparkSession, params: RunParams, inputs: Inputs, root: str) -> StageLedger:
    """The ledger of these parameters and inputs: configuration by its rows, large tables by their files."""
    small = dict(vars(inputs.config)) | {f"lookup {n}": df for n, df in inputs.lookups.items()}
    large = {n: getattr(inputs, n) for n in ("profiles", "segments", "account_tokens", "subscriber_tokens", "seeds", "members")}
    return StageLedger(spark, root, fingerprint(params, small, large))


@dataclass(frozen=True)
class ControlTables:
    """Names under which a run's control tables and producers are known."""

    environment: str | None = None
    schedules: str = "schedule_config"
    run_log: str = "run_log"
    processes: str = "process_config"
    token_config: str = "token_config"
    subscriber_tokens: str | None = "subscriber_tokens"  # this one and the next two may be absent
    seeds: str | None = "seed_list"
    members: str | None = "loyalty_members"
    profile_producer: str = "ETL"
    segment_producer: str = "Segment_mapping"


def daily_inputs(
    spark: SparkSession, source: tables.TableSource, locale: str, launch_date: str, brand: str, names: ControlTables = ControlTables(), as_of=None
):
    """Resolve a day's run from its sources: (params, inputs).

    A5 → A6 → A3: the locale's schedule, its newest complete run, the profiles
    at that run's path; their scope (B2). A7 → A6 → A4: the brand's process and
    its newest segment run. Then the configuration (A2) and the token table of
    the scope (I8); the lookup tables are read by the run, once it knows which
    its bindings name (A12). ``as_of``: a back-dated run takes the newest runs
    that had ended by that time.
    """
    def one(df: DataFrame, what: str):
        row = df.first()
        if row is None:
            raise LookupError(f"no {what} for {locale}, {brand}")
        return row

    log = source.read(spark, names.run_log)
    schedule = one(runlog.latest_schedule(source.read(spark, names.schedules), locale), "schedule")
    produced = one(runlog.latest_run(log, schedule.ID, names.profile_producer, "StartDate", as_of), "complete profile run")
    profiles = tables.read_profiles(spark, produced.FilePath)
    scope = runlog.scope_of(profiles)
    process = one(runlog.process_identity(source.read(spark, names.processes), locale, brand), "process")
    mapped = one(runlog.latest_run(log, process.id, names.segment_producer, "EndDate", as_of), "complete segment run")
    cfg = tables.load_config(spark, source, names.environment)
    config = campaigns.CampaignConfig(
        campaigns=cfg["campaign_definition"], templates=cfg["template_definition"], segment_modules=cfg["segment_module"],
        module_defs=cfg["module_definition"], segment_defs=cfg["segment_definition"], module_vars=cfg["module_variable_definition"],
    )
    params = RunParams(scope=scope, launch_date=launch_date)
    optional = lambda name: source.read(spark, name) if name else None
    tokens = one(deliver.token_table_for_scope(source.read(spark, names.token_config), scope), "token table")
    inputs = Inputs(
        config, profiles, tables.read_segments(spark, mapped.FilePath), {}, source.read(spark, tokens.UserTokenTableName),
        optional(names.subscriber_tokens), optional(names.seeds), optional(names.members), source,
    )
    return params, inputs
