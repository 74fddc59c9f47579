"""What must hold when runs meet, die half way, or find what others left: extraction, commits, retention, reconciliation."""

import gzip
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from gristmill.operators.embedding import hashed_tokens
from gristmill.plans import refresh, vectors
from gristmill.sources import raw, tables
from gristmill.sources.commitlog import CommitLog, Conflict
from gristmill.streaming import cursor

NOW = "2024-03-01 12:00:00"


def a_run(spark, tmp_path, now=NOW, **more):
    return refresh.Run(spark, str(tmp_path), "2024-01-01", "2024-01-02", now, **more)


# The log


@pytest.mark.parametrize("claim", ["_link", "_rename"])
def test_an_entry_is_written_once(spark, tmp_path, claim, monkeypatch):
    monkeypatch.setattr(CommitLog, "_link", getattr(CommitLog, claim))
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.last() == (0, {}) and log.numbers() == []
    assert log.add(1, {"a": "é"}) and not log.add(1, {"a": "other"}) and log.add(2, {"b": [1]})
    assert log.last() == (2, {"b": [1]}) and log.read(1) == {"a": "é"}
    log.drop_before(2)
    assert log.numbers() == [2]
    assert not [f for f in (tmp_path / "log").iterdir() if f.name.startswith(".draft")]


def test_of_many_writers_one_gets_a_number(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.add(1, {"writer": i}), range(16)))
    assert sum(won) == 1 and log.read(1)["writer"] == won.index(True)


# Extraction


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id bigint, day date, note string").withColumn("tags", F.array("note"))


def ids(spark, manifest):
    if not manifest.header.first()["counts"]["records"]:
        return []
    return sorted(r["id"] for r in raw.read_raw(spark, manifest, "id bigint").collect())


DAY = [None, *(f"2024-01-0{i}" for i in range(1, 9))]


def dated(spark, *values):
    return rows(spark, *[(i, None, n) for i, _, n in values]).drop("day").join(
        spark.createDataFrame([(i, n, DAY[d]) for i, d, n in values], "id bigint, note string, day string").selectExpr(
            "id", "note", "CAST(day AS DATE) AS day"
        ),
        ["id", "note"],
    )


def test_late_rows_of_the_watermark_are_taken_once(spark, tmp_path):
    run = a_run(spark, tmp_path)
    seen = [(1, 1, "a"), (2, 2, "a"), (3, 2, "a"), (4, 0, "a")]
    extract = lambda *r, **how: run.ingest(dated(spark, *r), "things", "day", incremental=True, **how)
    first = extract(*seen)
    assert ids(spark, first) == [1, 2, 3, 4]
    run.commit(first, "things")
    # The day's later rows, one without a cursor, one changed, and one that is older than the watermark.
    seen += [(5, 2, "a"), (6, 0, "a"), (7, 1, "a")]
    seen[1] = (2, 2, "changed")
    second = extract(*seen)
    assert ids(spark, second) == [2, 5, 6]
    run.commit(second, "things")
    third = extract(*seen)
    assert ids(spark, third) == []
    run.commit(third, "things")
    fourth = extract(*seen, (8, 3, "a"), (9, 2, "a"))
    assert ids(spark, fourth) == [8, 9]
    run.commit(fourth, "things")
    state = cursor.read_state(spark, str(tmp_path), "things")
    assert (state.number, state.watermark) == (3, "2024-01-03")


def test_overlap_reaches_below_the_watermark(spark, tmp_path):
    run = a_run(spark, tmp_path)
    extract = lambda *r: run.ingest(dated(spark, *r), "things", "day", incremental=True, overlap="2 days")
    run.commit(extract((1, 2, "a"), (2, 5, "a")), "things")
    second = extract((1, 2, "a"), (2, 5, "a"), (3, 2, "late"), (4, 3, "late"), (5, 5, "late"), (6, 6, "new"))
    assert ids(spark, second) == [4, 5, 6]
    run.commit(second, "things")
    third = extract((2, 5, "a"), (4, 3, "late"), (5, 5, "late"), (6, 6, "new"), (7, 4, "late"), (8, 3, "too late"))
    assert ids(spark, third) == [7]


def test_numbers_and_texts_as_cursors(spark, tmp_path):
    for kind, overlap in (("bigint", 2), ("double", 2), ("string", None)):
        base = spark.range(10).selectExpr("id", f"CAST(id AS {kind}) AS at")
        run = a_run(spark, tmp_path / kind)
        run.commit(run.ingest(base.where("id < 6"), "t", "at", incremental=True, overlap=overlap), "t")
        more = base.union(spark.sql(f"SELECT 100, CAST(5 AS {kind}) UNION ALL SELECT 101, CAST(3 AS {kind})"))
        second = run.ingest(more, "t", "at", incremental=True, overlap=overlap)
        assert ids(spark, second) == [6, 7, 8, 9, 100] + [101] * (overlap is not None)


def test_only_rows_without_a_cursor(spark, tmp_path):
    run = a_run(spark, tmp_path)
    for seen, new in (([1, 2], [1, 2]), ([1, 2, 3], [3]), ([1, 2, 3], [])):
        manifest = run.ingest(dated(spark, *[(i, 0, "a") for i in seen]), "things", "day", incremental=True)
        assert ids(spark, manifest) == new
        run.commit(manifest, "things")
    manifest = run.ingest(dated(spark, (1, 0, "a"), (9, 4, "a")), "things", "day", incremental=True)
    assert ids(spark, manifest) == [9]


def test_a_run_that_dies_before_the_commit_is_repeated(spark, tmp_path):
    run = a_run(spark, tmp_path)
    seen = [(1, 1, "a"), (2, 2, "a"), (3, 0, "a")]
    run.commit(run.ingest(dated(spark, *seen[:1]), "things", "day", incremental=True), "things")
    run.ingest(dated(spark, *seen), "things", "day", incremental=True)
    again = run.ingest(dated(spark, *seen), "things", "day", incremental=True)
    assert ids(spark, again) == [2, 3]
    run.commit(again, "things")
    assert ids(spark, run.ingest(dated(spark, *seen), "things", "day", incremental=True)) == []


def test_a_run_that_dies_while_it_commits_leaves_the_state(spark, tmp_path, monkeypatch):
    run = a_run(spark, tmp_path)
    manifest = run.ingest(dated(spark, (1, 1, "a")), "things", "day", incremental=True)

    def die(self, number, entry):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="lost"):
        patched.setattr(CommitLog, "add", die)
        run.commit(manifest, "things")
    assert cursor.read_state(spark, str(tmp_path), "things") == cursor.State()
    run.commit(manifest, "things")
    assert ids(spark, run.ingest(dated(spark, (1, 1, "a")), "things", "day", incremental=True)) == []


def test_of_two_runs_from_one_state_the_second_is_a_conflict(spark, tmp_path):
    run, other = a_run(spark, tmp_path), a_run(spark, tmp_path)
    mine = run.ingest(dated(spark, (1, 1, "a")), "things", "day", incremental=True)
    theirs = other.ingest(dated(spark, (1, 1, "a"), (2, 1, "a")), "things", "day", incremental=True)
    other.commit(theirs, "things")
    with pytest.raises(Conflict, match="extract again"):
        run.commit(mine, "things")


def test_boundary_folders_are_joined_into_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cursor, "MOST_FOLDERS", 2)
    run, seen = a_run(spark, tmp_path), []
    for i in range(5):
        seen += [(i, 1, "a"), (100 + i, 0, "a")]
        manifest = run.ingest(dated(spark, *seen), "things", "day", incremental=True)
        assert ids(spark, manifest) == [i, 100 + i]
        run.commit(manifest, "things")
        assert len(cursor.read_state(spark, str(tmp_path), "things").folders) <= 2


def test_rows_past_the_watermark_are_not_compared(spark, tmp_path):
    source = spark.range(100).selectExpr("id", "id AS at")
    source.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    run = a_run(spark, tmp_path)
    run.commit(run.ingest(source.where("id < 50"), "t", "at", incremental=True), "t")
    state = cursor.read_state(spark, str(tmp_path), "t")
    plan = cursor.pending(source, "at", state)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at,49)" in plan and "GreaterThanOrEqual(at,49)" in plan


# Two writers of the vector table


def review_rows(spark, *texts):
    data = [(f"R{i}", "A", "U", t) for i, t in texts]
    df = spark.createDataFrame(data, "review_id string, asin string, reviewer_id string, review_text string")
    return df.selectExpr("*", "TIMESTAMP'2024-01-01' AS review_timestamp", "DATE'2024-01-01' AS ingest_dt", "CAST(NULL AS string) AS summary")


def stored_texts(run):
    hashes = {r["review_id"]: r["text_hash"] for r in run.vector_table().collect()}
    return hashes


def hashes_of(spark, *texts):
    return {r["review_id"]: r["text_hash"] for r in vectors.prepare(review_rows(spark, *texts), "v1").collect()}


@pytest.mark.parametrize("buckets", [1, 4])
def test_two_interleaved_writers_keep_both_updates(spark, tmp_path, buckets):
    encoder = hashed_tokens(8)
    base = [(i, f"text {i}") for i in range(30)]
    first = a_run(spark, tmp_path, vector_buckets=buckets)
    first.commit_vectors(first.draft_vectors(vectors.prepare(review_rows(spark, *base), "v1"), encoder), 8)
    mine, theirs = [(0, "mine"), (1, "both, mine"), (40, "new, mine")], [(1, "both, theirs"), (2, "theirs"), (41, "new, theirs")]
    one, two = a_run(spark, tmp_path, "2024-04-01 12:00:00", vector_buckets=buckets), a_run(spark, tmp_path, "2024-05-01 12:00:00", vector_buckets=buckets)
    drafts = [r.draft_vectors(vectors.prepare(review_rows(spark, *t), "v1"), encoder) for r, t in ((one, mine), (two, theirs))]
    two.commit_vectors(drafts[1], 8)
    table = one.commit_vectors(drafts[0], 8)
    want = dict(base) | dict(theirs) | dict(mine)
    assert stored_texts(one) == hashes_of(spark, *want.items())
    assert table.count() == table.select("review_id").distinct().count() == 32
    assert tables.current_version(spark, one.vector_path).number == 3
    both = table.where("review_id = 'R1'").first()
    assert str(both["created_at"]) == NOW and str(both["updated_at"]) == "2024-04-01 12:00:00"


def test_a_writer_between_check_and_commit_is_seen(spark, tmp_path, monkeypatch):
    encoder = hashed_tokens(8)
    run, other = a_run(spark, tmp_path, vector_buckets=3), a_run(spark, tmp_path, vector_buckets=3)
    draft = run.draft_vectors(vectors.prepare(review_rows(spark, (1, "a"), (2, "b")), "v1"), encoder)
    real, calls = refresh.Run.check_vectors, []

    def check(self, table, dim):
        real(self, table, dim)
        calls.append(self is run)
        if len(calls) == 1:
            other.commit_vectors(other.draft_vectors(vectors.prepare(review_rows(spark, (2, "B"), (3, "c")), "v1"), encoder), dim)

    monkeypatch.setattr(refresh.Run, "check_vectors", check)
    run.commit_vectors(draft, 8)
    assert calls == [True, False, True]
    assert stored_texts(run) == hashes_of(spark, (1, "a"), (2, "b"), (3, "c"))


def test_what_a_vector_run_needs_between_its_steps_goes_with_it(spark, tmp_path):
    """Only versions, the prepared rows and reports stay; a run without changes leaves nothing either."""
    run = a_run(spark, tmp_path, vector_buckets=2)
    for texts in ([(1, "a"), (2, "b")], [(1, "A"), (3, "c")], [(1, "A")]):
        run.commit_vectors(run.draft_vectors(vectors.prepare(review_rows(spark, *texts), "v1"), hashed_tokens(8)), 8)
    left = {f.relative_to(tmp_path).parts[0] for f in tmp_path.rglob("*.parquet") if "version-" not in str(f)}
    assert not left
    assert stored_texts(run) == hashes_of(spark, (1, "A"), (2, "b"), (3, "c"))


def test_a_third_run_finds_what_the_second_staged(spark, tmp_path):
    run = a_run(spark, tmp_path, vector_buckets=2)
    tables.write_partitions(review_rows(spark, (1, "a"), (2, "b")), run.staging_path("reviews"))
    for _ in range(2):
        table = run.build_vectors(hashed_tokens(8), 8, "v1")
    assert tables.current_version(spark, run.vector_path).number == 1 and table.count() == 2


# Retention


def write_versions(spark, base, numbers):
    for number in numbers:
        path = tables.new_version_path(base)
        spark.range(number).write.parquet(path)
        tables.commit_version(spark, base, tables.current_version(spark, base), {0: path})


def folders(tmp_path):
    return sorted(f.name for f in tmp_path.glob("version-*"))


def test_sweep_keeps_the_newest_and_what_readers_may_hold(spark, tmp_path):
    base = str(tmp_path)
    assert tables.sweep_versions(spark, base) == 0
    write_versions(spark, base, range(1, 5))
    old = tables.current_version(spark, base)
    reader = old.read(spark)
    write_versions(spark, base, range(5, 7))
    assert tables.sweep_versions(spark, base, keep=1) == 0 and reader.count() == 4
    assert tables.sweep_versions(spark, base, keep=3, grace_seconds=0) == 3
    assert reader.count() == 4 and tables.version_log(spark, base).numbers() == [4, 5, 6]
    assert tables.sweep_versions(spark, base, keep=3, grace_seconds=0) == 0
    assert tables.sweep_versions(spark, base, keep=1, grace_seconds=0) == 2 and len(folders(tmp_path)) == 1
    assert tables.current_version(spark, base).read(spark).count() == 6
    with pytest.raises(ValueError):
        tables.sweep_versions(spark, base, keep=0)
    write_versions(spark, base, [7])
    assert tables.current_version(spark, base).number == 7


def test_sweep_that_dies_after_the_log_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    write_versions(spark, base, range(1, 5))
    real = CommitLog.drop_before

    def die(self, number):
        real(self, number)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="lost"):
        patched.setattr(CommitLog, "drop_before", die)
        tables.sweep_versions(spark, base, keep=2, grace_seconds=0)
    named = {p for n in tables.version_log(spark, base).numbers() for p in tables.version_log(spark, base).read(n)["parts"].values()}
    assert len(named) == 2 and all(spark.read.parquet(p).count() for p in named) and len(folders(tmp_path)) == 4
    assert tables.sweep_versions(spark, base, keep=2, grace_seconds=0) == 2 and len(folders(tmp_path)) == 2


def test_sweep_spares_what_a_writer_is_about_to_name(spark, tmp_path):
    base = str(tmp_path)
    write_versions(spark, base, [1, 2])
    path = tables.new_version_path(base)
    spark.range(9).write.parquet(path)
    assert tables.sweep_versions(spark, base, keep=1, grace_seconds=3600) == 0
    tables.commit_version(spark, base, tables.current_version(spark, base), {0: path})
    assert tables.sweep_versions(spark, base, keep=1, grace_seconds=0) == 2
    assert tables.current_version(spark, base).read(spark).count() == 9


def test_sweep_of_buckets_keeps_those_carried_over(spark, tmp_path):
    run = a_run(spark, tmp_path, vector_buckets=4)
    encoder = hashed_tokens(8)
    for texts in ([(i, f"t{i}") for i in range(20)], [(0, "changed")], [(0, "changed again")]):
        run.commit_vectors(run.draft_vectors(vectors.prepare(review_rows(spark, *texts), "v1"), encoder), 8)
    before = sorted(map(tuple, run.vector_table().collect()))
    assert run.sweep(keep=1, grace_seconds=0) == 2
    assert sorted(map(tuple, run.vector_table().collect())) == before


# Reconciliation


def a_batch(spark, tmp_path):
    source = spark.range(25).selectExpr("id", "CAST(id AS string) AS name", "TIMESTAMP'2024-01-01' AS at").coalesce(1)
    return raw.write_batch(source, str(tmp_path), "things", "2024-01-01", records_per_file=10)


def stored_files(tmp_path, batch):
    return sorted((tmp_path / batch.prefix / batch.name).glob("part-*"))


def change(path, how):
    lines = gzip.decompress(path.read_bytes()).splitlines(keepends=True)
    changed = {
        "cut short": lines[:-1],
        "doubled": lines + lines,
        "one twice, one lost": lines[:-1] + lines[:1],
        "another value": [lines[0].replace(b'"id":', b'"id":9'), *lines[1:]],
    }[how]
    path.write_bytes(gzip.compress(b"".join(changed)))
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)


CHANGES = ["cut short", "doubled", "one twice, one lost", "another value"]


@pytest.mark.parametrize("how", CHANGES)
def test_files_that_differ_from_the_source_are_found(spark, tmp_path, how):
    batch = a_batch(spark, tmp_path)
    path = raw.manifest_path(str(tmp_path), "things", "2024-01-01")
    change(stored_files(tmp_path, batch)[1], how)
    raw.write_manifest(raw.build_manifest(spark, batch, "things", "2024-01-01", "t"), path)
    found = raw.reconcile(raw.read_manifest(spark, path))
    assert found.source_records == 25 and not found.matches and not found.lines_match
    assert found.written_records == {"cut short": 24, "doubled": 35}.get(how, 25)


@pytest.mark.parametrize("how", [*CHANGES, "lost"])
def test_files_that_change_after_the_manifest_are_named(spark, tmp_path, how):
    batch = a_batch(spark, tmp_path)
    path = raw.manifest_path(str(tmp_path), "things", "2024-01-01")
    raw.write_manifest(raw.build_manifest(spark, batch, "things", "2024-01-01", "t"), path)
    manifest = raw.read_manifest(spark, path)
    assert raw.reconcile(manifest).matches and raw.audit(spark, manifest).isEmpty()
    assert {r["records"] for r in manifest.files.collect()} == {10, 5}
    touched = stored_files(tmp_path, batch)[0]
    touched.unlink() if how == "lost" else change(touched, how)
    odd = raw.audit(spark, manifest).collect()
    assert [r["file"].rsplit("/", 1)[1] for r in odd] == [touched.name] and odd[0]["listed_records"] == 10
    assert odd[0]["stored_records"] == {"cut short": 9, "doubled": 20, "lost": 0}.get(how, 10)


def test_ingestion_stops_where_lines_are_not_the_sources(spark, tmp_path, monkeypatch):
    real = raw.write_batch

    def damaged(*args, **how):
        batch = real(*args, **how)
        change(stored_files(tmp_path, batch)[0], "cut short")
        return batch

    monkeypatch.setattr(raw, "write_batch", damaged)
    with pytest.raises(raw.StoredLinesDiffer):
        a_run(spark, tmp_path).ingest(spark.range(5).coalesce(1), "things")


def test_many_batches_are_one_scan(spark, tmp_path):
    source = spark.range(3).coalesce(1)
    path = raw.manifest_path(str(tmp_path), "things", "2024-01-01")
    batches = [raw.write_batch(source, str(tmp_path), "things", "2024-01-01") for _ in range(12)]
    for number, batch in enumerate(batches, 1):
        built = raw.build_manifest(spark, batch, "things", "2024-01-01", "t", mode="incremental", batch_no=number)
        raw.write_manifest(built, path)
    manifest = raw.read_manifest(spark, path)
    assert raw.read_raw(spark, manifest, "id bigint").count() == 36
    for plan in (raw.read_raw(spark, manifest, "id bigint"), raw._stored_files(spark, raw._folders(manifest))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Scan") == 1 and "Union" not in text
    plan = raw.compare_files(spark, manifest)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("binaryFile") == 1 and "Union" not in plan
