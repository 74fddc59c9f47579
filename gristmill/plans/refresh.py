"""The full sequence: raw batches, staging, features, vectors, each gated by its quality suite.

Every step writes its table before the next reads it. Raw batches are only ever added, and the staging of a date is
built from all batches of the date that count, so a run that died at any point can simply be started again: nothing
is lost and nothing counts twice. A watermark moves only after the rows before it are staged and checked.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.parse import unpacked
from gristmill.operators import checks, quality
from gristmill.operators.contracts import require_rows
from gristmill.operators.dedup import first_per_key, newest
from gristmill.operators.embedding import EncoderFactory
from gristmill.operators.upsert import merge_into
from gristmill.plans import features, staging, suites, vectors
from gristmill.session import hadoop, scratch
from gristmill.sources import raw, tables
from gristmill.sources.commitlog import Conflict
from gristmill.streaming import cursor

FEATURE_TABLES = ("product_features", "user_features", "product_review_stats", "user_product_interactions")
VECTOR_TABLE = "review_embeddings"


@dataclass(frozen=True)
class VectorDraft:
    """Buckets written on top of a version, and the embedded rows they come from."""

    before: tables.Version
    batch: DataFrame
    empty: DataFrame
    parts: dict[int, str]
    embedded: str


@dataclass
class Run:
    """One scheduled run over one ingestion date, working below ``root``.

    With a ``namespace`` the feature tables are published to the catalog under it, otherwise they are
    Parquet folders with a pointer to the current version. ``vector_buckets`` is the number of parts of the
    vector table; choose it when the table is new, so that a part is a few gigabytes.
    """

    spark: SparkSession
    root: str
    ingest_dt: str
    run_date: str
    now: str
    namespace: str | None = None
    provider: str = "parquet"
    records_per_file: int = raw.JOB_RECORDS_PER_FILE
    vector_buckets: int = 64

    # Locations

    def manifest_path(self, entity: str) -> str:
        return raw.manifest_path(self.root, entity, self.ingest_dt)

    def staging_path(self, entity: str) -> str:
        return f"{self.root}/staging/{entity}"

    def feature_path(self, table: str) -> str:
        return f"{self.root}/features/{table}"

    def report_path(self, entity: str) -> str:
        return f"{self.root}/reports/{entity}/{self.run_date}"

    @property
    def vector_path(self) -> str:
        return f"{self.root}/vectors"

    def feature(self, table: str) -> DataFrame:
        if self.namespace:
            return tables.read_table(self.spark, f"{self.namespace}.{table}")
        return tables.current_version(self.spark, self.feature_path(table)).read(self.spark)

    def vector_table(self) -> DataFrame:
        """The vector table as the last run that was checked left it."""
        if self.namespace and self.provider in tables.REPLACING_PROVIDERS:
            return tables.read_table(self.spark, f"{self.namespace}.{VECTOR_TABLE}")
        return tables.current_version(self.spark, self.vector_path).read(self.spark)

    def staged(self, entity: str) -> DataFrame:
        return tables.read_partition(self.spark, self.staging_path(entity), self.ingest_dt)

    def staged_over_dates(self, entity: str) -> DataFrame:
        """The newest row of each key over all dates: what increments of several dates add up to."""
        key, order = {"products": ("asin", ["updated_at", "ingest_dt"]), "reviews": ("review_id", ["ingest_dt"])}[entity]
        return first_per_key(tables.read_all(self.spark, self.staging_path(entity)), [key], newest(*order))

    # Steps

    def ingest(
        self,
        source: DataFrame,
        entity: str,
        cursor_field: str | None = None,
        incremental: bool = False,
        expected_records: int | None = None,
        overlap: str | int | None = None,
    ) -> raw.Manifest:
        """Write a source as a raw batch with its manifest; returns the manifest.

        An incremental run takes the rows that no committed run has taken, late ones that share the watermark among
        them; ``overlap`` widens the stretch below the watermark in which late rows are looked for. What is stored is
        read back and compared with what came from the source; ``expected_records`` is a count the source itself
        gave, if there is one.
        """
        state, kind = cursor.State(), None
        if incremental:
            state, kind = cursor.read_state(self.spark, self.root, entity), source.schema[cursor_field].dataType
            source = cursor.pending(source, cursor_field, state, overlap)
        batch = raw.write_batch(source, self.root, entity, self.ingest_dt, self.records_per_file, cursor_field)
        after = cursor.reached(self.spark, state, batch.last_cursor, kind) if incremental else None
        path = self.manifest_path(entity)
        built = raw.build_manifest(
            self.spark,
            batch,
            entity,
            self.ingest_dt,
            f"{self.now.replace(' ', 'T')}Z",
            mode="incremental" if incremental else "one_shot",
            cursor=raw.Cursor(
                cursor_field, incremental, state.watermark, after, state.number, kind and kind.simpleString(),
                None if overlap is None else json.dumps(overlap),
            ),
            batch_no=raw.next_batch_no(self.spark, path),
        )
        raw.write_manifest(built, path)
        manifest = raw.read_manifest(self.spark, path, batch.name)
        found = raw.reconcile(manifest, expected_records)
        if not found.lines_match:
            raise raw.StoredLinesDiffer(f"{entity}, {batch.name}: {found}")
        return manifest

    def stage(self, entity: str, schema: T.StructType) -> None:
        """Replace the date's staging partition by what all its raw batches hold, the latest row of each key."""
        build = {"products": staging.products, "reviews": staging.reviews}[entity]
        manifest = raw.read_manifest(self.spark, self.manifest_path(entity))
        records = require_rows(raw.read_raw(self.spark, manifest, schema), f"raw {entity}")
        tables.write_partitions(build(records, self.ingest_dt), self.staging_path(entity), sort_by="asin")
        partition = f"{self.staging_path(entity)}/ingest_dt={self.ingest_dt}"
        about = {"ingest_dt": self.ingest_dt, "partition_path": partition}
        self.gate(self.staged(entity), f"staging_{entity}", **about)

    def commit(self, manifest: raw.Manifest, entity: str) -> None:
        """Move the watermark of an increment that is staged and checked, and remember what it took at the boundary."""
        row = manifest.header.first()
        found, where, began = row["incremental"], row["s3"], row["extraction"]
        if not found["enabled"] or not row["counts"]["records"]:
            return
        batch = raw.Batch(where["bucket"], where["prefix"], where["batch"], row["counts"]["records"], row["counts"]["hash_sum"], row["counts"]["hash_xor"])
        state = cursor.read_state(self.spark, self.root, entity)
        if state.number != began["state"]:
            raise Conflict(f"another run moved the watermark of {entity} from entry {began['state']}; extract again")
        cursor.commit(
            self.spark, self.root, entity, found["cursor_field"], state, found["watermark_out"], batch,
            T.DataType.fromDDL(began["cursor_type"]), began["overlap"] and json.loads(began["overlap"]),
        )

    def build_features(self, over_dates: bool = False) -> None:
        """The feature tables of the date's partition, or of all dates when partitions are increments."""
        staged = self.staged_over_dates if over_dates else self.staged
        self.publish("product_features", features.product_features(staged("products"), self.run_date))
        with scratch(self.spark) as keep:
            reviews = keep(features.review_facts(staged("reviews")), "review-facts")
            self.publish("user_features", features.user_features(reviews, self.run_date))
            self.publish("product_review_stats", features.product_review_stats(reviews, self.run_date))
            base = [self.feature(name) for name in FEATURE_TABLES[:3]]
            # The gate of the staging reviews has made sure that review ids are unique.
            interactions = features.user_product_interactions(reviews, *base, self.run_date, reviews_are_unique=True)
            self.publish("user_product_interactions", interactions)

    def publish(self, table: str, df: DataFrame) -> None:
        """Store a feature table. The checked version becomes the current one, a failed one never does.

        Only providers that replace the table themselves show it before it is checked.
        """
        if self.namespace:
            name = f"{self.namespace}.{table}"
            check = partial(self.gate, name=table, execution_date=self.run_date, table_name=name)
            tables.publish_table(df, name, self.provider, f"{self.root}/features", check)
            return
        base = self.feature_path(table)
        path = tables.new_version_path(base)
        df.write.parquet(path)
        self.gate(self.spark.read.parquet(path), table, execution_date=self.run_date, table_name=table)
        tables.commit_version(self.spark, base, tables.current_version(self.spark, base), {0: path})

    def build_vectors(
        self, encoder: EncoderFactory, dim: int, model_version: str = vectors.DEFAULT_MODEL, backfill: bool = False
    ) -> DataFrame:
        """Embed what is not stored yet and bring the lasting vector table up to date.

        The run's date is prepared; ``backfill`` prepares all dates, for a new model or after a date whose vectors
        were never built. Where the provider merges in place the catalog table is merged into. Otherwise only the
        buckets with changes are written anew, and the pointer moves when the whole is checked; a run without
        changes writes nothing.
        """
        prepared_path = self.staging_path("reviews_for_embedding")
        reviews = tables.read_all(self.spark, self.staging_path("reviews")) if backfill else self.staged("reviews")
        tables.write_partitions(vectors.prepare(reviews, model_version), prepared_path)
        read = tables.read_all(self.spark, prepared_path) if backfill else self.staged("reviews_for_embedding")
        prepared = require_rows(read, "the prepared reviews")
        if self.namespace and self.provider in tables.REPLACING_PROVIDERS:
            return self._merge_vectors(prepared, encoder)
        return self.commit_vectors(self.draft_vectors(prepared, encoder, written=True), dim)

    def _merge_vectors(self, prepared: DataFrame, encoder: EncoderFactory) -> DataFrame:
        name = f"{self.namespace}.{VECTOR_TABLE}"
        if not self.spark.catalog.tableExists(name):
            self.empty_vectors(vectors.embedded_schema(prepared)).writeTo(name).using(self.provider).create()
        path = self._embed(prepared, tables.read_table(self.spark, name), encoder)
        columns = [c for c in vectors.EMBEDDED_COLUMNS if c != "ingest_dt"]
        batch = vectors.newest_per_review(tables.read_all(self.spark, path))
        merge_into(batch.select(*columns), name, ["review_id"], vectors.CONTENT_CHANGED)
        self._remove(path)
        return tables.read_table(self.spark, name)

    def _remove(self, path: str) -> None:
        """Remove a folder that only this run knows."""
        files, folder = hadoop(self.spark, path)
        files.delete(folder, True)

    def _embed(self, prepared: DataFrame, stored: DataFrame | None, encoder: EncoderFactory) -> str:
        """Write vectors of the prepared rows, less those that are stored, to a folder of this run alone; returns it.

        Dealing reads its rows twice. What the join with the stored rows leaves is written for that, and goes when it is embedded;
        prepared rows of which none are stored are taken as they lie.
        """
        path = f"{self.root}/embedded/{self.run_date}/{uuid.uuid4().hex}"
        if stored is None:
            vectors.embed_reviews(prepared, encoder).write.parquet(path)
            return path
        with scratch(self.spark) as keep:
            waiting = keep(vectors.pending(prepared, stored), "waiting")
            vectors.embed_reviews(waiting, encoder).write.parquet(path)
        return path

    def draft_vectors(self, prepared: DataFrame, encoder: EncoderFactory, written: bool = False) -> VectorDraft:
        """Embed what is not stored and write the buckets it changes; nothing counts before :meth:`commit_vectors`.

        ``prepared`` is read several times: if it is not ``written`` yet, its texts are cleaned once and kept until they are embedded.
        """
        before = tables.current_version(self.spark, self.vector_path)
        stored = before.read(self.spark) if before.parts else None
        empty = self.empty_vectors(vectors.embedded_schema(prepared))
        with scratch(self.spark) as keep:
            path = self._embed(prepared if written else keep(prepared, "prepared"), stored, encoder)
        batch = tables.read_all(self.spark, path)
        return VectorDraft(before, batch, empty, self._changed_buckets(before, batch, empty), path)

    def _changed_buckets(self, version: tables.Version, batch: DataFrame, empty: DataFrame) -> dict[int, str]:
        """Write the buckets of a version that the batch changes, merged with it; returns where they are."""
        bucket = F.pmod(F.xxhash64(unpacked(F.col("review_id"))), F.lit(self.vector_buckets)).cast("int").alias("bucket")
        now = F.lit(self.now).cast("timestamp")
        empty, batch = vectors.with_packed_digests(empty), vectors.with_packed_digests(batch)
        stored = vectors.with_packed_digests(version.read(self.spark)) if version.parts else empty
        with scratch(self.spark) as keep:
            changed = keep(vectors.changed_vectors(stored, batch, now), "changed")
            touched = [row["bucket"] for row in changed.select(bucket).distinct().collect()]
            if not touched:
                return {}
            before = {b: version.parts[b] for b in touched if b in version.parts}
            old = vectors.with_packed_digests(tables.Version(version.number, before).read(self.spark)) if before else empty
            path = tables.new_version_path(self.vector_path)
            merged = vectors.apply_changes(old, changed, now).select("*", bucket)
            vectors.with_plain_digests(merged.hint("rebalance", "bucket")).write.partitionBy("bucket").parquet(path)
        return {b: f"{path}/bucket={b}" for b in touched}

    def commit_vectors(self, draft: VectorDraft, dim: int) -> DataFrame:
        """Check the table with the draft's buckets and make it the current version; returns the table.

        If another run committed meanwhile, its buckets stay, and the ones that both changed are merged again: the draft's
        vectors go into what the other run left. A draft without changes commits nothing. What was embedded for the draft goes
        with its commit.
        """
        if not draft.parts:
            table = draft.before.read(self.spark)
            self.check_vectors(table, dim)
            self._remove(draft.embedded)
            return table
        bucket = F.pmod(F.xxhash64("review_id"), F.lit(self.vector_buckets)).cast("int")

        def again(current: tables.Version, both: list[int]) -> dict[int, str]:
            theirs = tables.Version(current.number, {b: current.parts[b] for b in both})
            merged = self._changed_buckets(theirs, draft.batch.where(bucket.isin(both)), draft.empty)
            # Where the other run stored the same, its bucket is the result.
            return theirs.parts | merged

        check = partial(self._check_version, dim=dim)
        version = tables.commit_version(self.spark, self.vector_path, draft.before, draft.parts, again, check)
        self._remove(draft.embedded)
        return version.read(self.spark)

    def _check_version(self, version: tables.Version, dim: int) -> None:
        self.check_vectors(version.read(self.spark), dim)

    def check_vectors(self, table: DataFrame, dim: int) -> None:
        results = checks.vector_report(table, dim, VECTOR_TABLE, self.now)
        results.coalesce(1).write.mode("overwrite").json(self.report_path(VECTOR_TABLE))
        status = self.spark.read.json(self.report_path(VECTOR_TABLE)).first()
        if status["overall_status"] != "success":
            raise quality.SuiteFailed(f"{VECTOR_TABLE}: {status['checks']}")

    def sweep(self, keep: int = 5, grace_seconds: float = 7 * 86400) -> int:
        """Remove the folders of versions that no longer count, of the vector table and the features kept in folders."""
        bases = [self.vector_path] + ([] if self.namespace else [self.feature_path(t) for t in FEATURE_TABLES])
        return sum(tables.sweep_versions(self.spark, base, keep, grace_seconds) for base in bases)

    def empty_vectors(self, batch: DataFrame) -> DataFrame:
        columns = [c for c in vectors.EMBEDDED_COLUMNS if c != "ingest_dt"]
        blank = F.lit(None).cast("timestamp")
        return batch.select(*columns, blank.alias("created_at"), blank.alias("updated_at")).where(F.lit(False))

    def gate(self, df: DataFrame, name: str, **about: str) -> None:
        """Evaluate the table's suite, save the report, stop when a check failed."""
        suite = suites.BY_TABLE[name]
        outcome = quality.run_suite(df, name, suite)
        document = json.dumps(quality.report(outcome, suite, **about), default=str, ensure_ascii=False)
        line = self.spark.range(1).select(F.lit(document).alias("value"))
        line.write.mode("overwrite").text(self.report_path(name))
        quality.enforce(outcome)

    def all(
        self,
        products: DataFrame,
        reviews: DataFrame,
        encoder: EncoderFactory,
        dim: int = vectors.DEFAULT_DIMENSION,
        model_version: str = vectors.DEFAULT_MODEL,
        cursors: Mapping[str, str] | None = None,
        backfill: bool = False,
    ) -> DataFrame:
        """Run everything in order; returns the row count of each finished table.

        An entity with a cursor column in ``cursors`` is taken incrementally. The features then cover all dates. An
        increment without rows leaves staging as it is; what follows is still built, since an earlier run may have
        died before it.
        """
        cursors = cursors or {}
        for entity, source in (("products", products), ("reviews", reviews)):
            field = cursors.get(entity)
            manifest = self.ingest(source, entity, field, incremental=field is not None)
            if field is None or manifest.header.first()["counts"]["records"]:
                self.stage(entity, source.schema)
                self.commit(manifest, entity)
        self.build_features(over_dates=bool(cursors))
        if cursors and not backfill and self.staged("reviews").isEmpty():
            table = self.vector_table()
        else:
            table = self.build_vectors(encoder, dim, model_version, backfill)
        finished = {name: self.feature(name) for name in FEATURE_TABLES}
        return checks.row_counts({**finished, VECTOR_TABLE: table})
