"""Real files through binaryFile, sources and sinks, and streams."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from twinsift.operators import files as file_ops
from twinsift.plans.jobs import output_path, run_file_job, run_job, run_sources_job
from twinsift.session import scratch_path
from twinsift.sources import sinks
from twinsift.sources.files import scan_files
from twinsift.sources.tables import read_lines, read_table
from twinsift.streaming.dedup import (
    BloomSeenTableSink,
    SeenTableSink,
    file_arrivals,
    read_parquet_stream,
    run_available,
    within_watermark,
)
from twinsift.operators.bloom import BloomSpec

PEOPLE_SCHEMA = "id string, name string, email string, address string"


def _write(path: str, data: bytes) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _file_tree() -> str:
    root = tempfile.mkdtemp(prefix="twinsift-files-")
    _write(f"{root}/a.txt", b"same content\n")
    _write(f"{root}/sub/b.txt", b"same content\n")
    _write(f"{root}/c.txt", b"other content\n")
    _write(f"{root}/empty.txt", b"")
    _write(f"{root}/sub/void file.txt", b"")
    _write(f"{root}/über.txt", b"other content\n")
    return root


def test_file_job_groups_and_savings(spark):
    root = _file_tree()
    out = run_file_job(spark, root, output_dir=tempfile.mkdtemp(prefix="twinsift-out-"))
    rep = out["report"].first()
    # two with equal bytes, two with others, two without any
    assert rep.total_files == 6 and rep.unique_files == 3 and rep.duplicate_groups == 3
    assert rep.saved_bytes == len(b"same content\n") + len(b"other content\n")
    assert out["unique"].count() == 3 and out["unreadable"].count() == 0
    names = {r.file_name for r in out["hashed"].collect()}
    assert {"über.txt", "void file.txt"} <= names


def test_chunked_hashing_equals_whole_content_hashing(spark):
    root = _file_tree()
    _write(f"{root}/big.bin", os.urandom(3 * 1024 * 1024 + 17))
    for kind in ("md5", "sha256"):
        whole = {(r.file_path, r.file_hash) for r in file_ops.hash_files(scan_files(spark, root, recursive=True), kind).collect()}
        chunked = {(r.file_path, r.file_hash) for r in file_ops.hash_files_chunked(spark, root, kind, recursive=True, chunk_bytes=1 << 20).collect()}
        assert whole == chunked and len(whole) == 7
    plan = file_ops.hash_files_chunked(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # no bytes read by the listing
    rep = run_file_job(spark, root)["report"].first()
    assert rep.total_files == 7 and rep.duplicate_groups == 3


def test_non_recursive_scan_and_glob(spark):
    root = _file_tree()
    assert scan_files(spark, root).count() == 4  # sub/ not entered
    assert scan_files(spark, root, glob="c.*").count() == 1
    assert [r.file_size for r in scan_files(spark, root, glob="e*").collect()] == [0]


def test_equal_and_empty_files_in_every_file_function(spark):
    from twinsift import compat

    root = tempfile.mkdtemp(prefix="twinsift-empty-")
    for name, data in (("a", b"x"), ("b", b"x"), ("c", b"y"), ("d", b""), ("e", b"")):
        _write(f"{root}/{name}", data)
    paths = [f"{root}/{n}" for n in "abcde"]
    rep = run_file_job(spark, root)["report"].first()
    assert (rep.total_files, rep.unique_files, rep.duplicate_groups) == (5, 3, 2)
    unique, groups = compat.file_level_deduplication(spark, [*paths, f"{root}/missing"])
    assert (unique.count(), groups.count()) == (3, 2)
    unique, groups = compat.exact_file_deduplication(spark, paths, "sha256")
    assert (unique.count(), groups.count()) == (3, 2)
    hll = compat.hyperloglog_file_count(spark, paths)
    assert (hll["total_files"], hll["exact_unique"], hll["duplicates"]) == (5, 3, 2)
    assert compat.bloom_filter_file_deduplication(spark, paths[:2], paths[2:]).count() == 3
    assert compat.file_level_deduplication(spark, [f"{root}/missing"]) == (None, None)
    assert compat.compute_file_hash(paths[3]) == "d41d8cd98f00b204e9800998ecf8427e"


def test_unreadable_files_are_reported_with_a_reason():
    from twinsift.functions.digest import file_digest

    assert file_digest("/no/such/file") [0] is None
    digest, why = file_digest("nofs://bucket/x")
    assert digest is None and why


def test_image_files_by_glob(spark):
    root = tempfile.mkdtemp(prefix="twinsift-images-")
    for name, data in (("a.jpg", b"\xff\xd8img"), ("b.png", b"\x89PNGimg"), ("c.jpg", b"\xff\xd8img"), ("d.txt", b"text")):
        _write(f"{root}/{name}", data)
    rep = run_file_job(spark, root, glob="*.{jpg,png}")["report"].first()
    assert (rep.total_files, rep.unique_files, rep.duplicate_groups, rep.saved_bytes) == (3, 2, 1, 5)


def test_join_path_keeps_schemes():
    from twinsift.sources.tables import join_path

    assert join_path("s3a://bucket/data/", "/x", "y.parquet") == "s3a://bucket/data/x/y.parquet"
    assert join_path("/tmp/a", "b") == "/tmp/a/b"


def test_space_savings_on_lab_fixture(spark):
    """Pairs of 484, 797 and 981 bytes: keeping one copy saves 2262 bytes."""
    rows = [(f"f{i}{c}", s, f"h{i}") for i, s in enumerate([484, 797, 981]) for c in "ab"]
    df = spark.createDataFrame(rows, "file_path string, file_size long, file_hash string")
    from twinsift.operators.groups import space_savings

    assert space_savings(df, "file_hash", "file_size").first().saved_bytes == 2262


def test_unreadable_hash_is_not_a_duplicate(spark):
    df = spark.createDataFrame(
        [("p1", "p1", 1, None), ("p2", "p2", 1, None), ("p3", "p3", 1, "h")],
        "file_path string, file_name string, file_size long, file_hash string",
    )
    assert file_ops.unique_files(df).count() == 3
    assert file_ops.file_report(df).first().duplicate_groups == 0


def test_sha256_and_bad_hash_type(spark):
    root = _file_tree()
    h = file_ops.hash_files(scan_files(spark, root), "sha256")
    assert all(len(r.file_hash) == 64 for r in h.collect())
    try:
        file_ops.content_hash("content", "crc")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_text_lines_with_source(spark):
    root = _file_tree()
    lines = read_lines(spark, f"{root}/*.txt")
    assert lines.filter(F.col("value") == "same content").count() == 1
    whole = read_lines(spark, f"{root}/*.txt", whole_file=True)
    assert whole.count() == 3


def test_csv_with_and_without_schema_and_run_job(spark, sample):
    folder = tempfile.mkdtemp(prefix="twinsift-csv-")
    sample.toPandas().to_csv(f"{folder}/people.csv", index=False)  # keeps the blank-padded name
    inferred = read_table(spark, f"{folder}/people.csv")
    typed = read_table(spark, f"{folder}/people.csv", schema=PEOPLE_SCHEMA)
    assert inferred.count() == typed.count() == 6
    out_dir = tempfile.mkdtemp(prefix="twinsift-job-")
    path, report = run_job(spark, f"{folder}/people.csv", out_dir, "exact", schema=PEOPLE_SCHEMA)
    assert path == output_path(f"{folder}/people.csv", out_dir) and path.endswith("deduplicated_people.parquet")
    r = report.first()
    assert (r.original_count, r.deduplicated_count) == (6, 5)


def test_run_job_with_shuffle_tuning(spark, sample):
    folder = tempfile.mkdtemp(prefix="twinsift-tune-")
    sample.toPandas().to_csv(f"{folder}/people.csv", index=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        _, report = run_job(spark, f"{folder}/people.csv", folder, "normalized", schema=PEOPLE_SCHEMA, tune=True)
        assert report.first().deduplicated_count == 3
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sources_job_reports_per_file_and_skips_outputs(spark, sample):
    folder = tempfile.mkdtemp(prefix="twinsift-src-")
    for name in ("one", "two", "deduplicated_one"):
        sample.toPandas().to_csv(f"{folder}/{name}.csv", index=False)
    by_name = lambda df: {os.path.basename(r.source_file): r for r in df.collect()}
    rep = by_name(run_sources_job(spark, folder, PEOPLE_SCHEMA))
    assert set(rep) == {"one.csv", "two.csv", "deduplicated_one.csv", "(all)"}
    assert rep["one.csv"].rows == 6 and rep["one.csv"].unique_rows == 5 and rep["one.csv"].corrupt_rows == 0
    assert rep["deduplicated_one.csv"].status == "skipped" and rep["(all)"].rows == 12
    assert by_name(run_sources_job(spark, folder, PEOPLE_SCHEMA, skip_prefix=None))["(all)"].rows == 18


def test_sources_job_writes_and_survives_a_bad_file(spark, sample):
    folder, out = tempfile.mkdtemp(prefix="twinsift-many-"), tempfile.mkdtemp(prefix="twinsift-many-out-")
    for name in ("one", "two words"):
        sample.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    with open(f"{folder}/one.parquet/part-broken.parquet", "wb") as f:
        f.write(b"this is no parquet file")
    files = [f"{folder}/one.parquet", f"{folder}/two words.parquet"]
    rep = run_sources_job(spark, files, PEOPLE_SCHEMA, fmt="parquet", output_dir=f"{out}/all", method="normalized").collect()
    assert sorted((r.rows, r.unique_rows, r.status) for r in rep if r.source_file != "(all)" and r.rows) == [(6, 3, "done")] * 2
    assert [r.status for r in rep if "broken" in r.source_file] == ["no rows read"]
    written = spark.read.parquet(f"{out}/all")
    assert written.count() == 6 and written.select("source_file").distinct().count() == 2


def test_similar_values_name_their_representative(spark):
    from twinsift.plans.methods import similar_values

    df = spark.createDataFrame([("1", "Ann Ode", "a@x.org"), ("2", "Anne Ode", "b@y.net"), ("3", "Ann Ode", None), ("4", "Zoe Quill", "")], "id string, name string, email string")
    got = sorted(tuple(r) for r in similar_values(df, "fuzzy_levenshtein").collect())
    assert got == [("name", "ann ode", "ann ode", 2), ("name", "anne ode", "ann ode", 1)]


def test_sources_job_counts_malformed_rows(spark):
    folder = tempfile.mkdtemp(prefix="twinsift-bad-")
    with open(f"{folder}/n.csv", "w") as f:
        f.write("n,v\n1,a\n1,a\nnot-a-number,b\n2,c\n")
    r = run_sources_job(spark, folder, "n int, v string", keys=["n", "v"]).filter("source_file <> '(all)'").first()
    assert (r.rows, r.unique_rows, r.duplicate_rows, r.corrupt_rows) == (3, 2, 1, 1)


def test_append_unseen_and_rewrite(spark, sample):
    target = scratch_path(spark, "append-target")
    assert sinks.append_unseen(spark, sample, target, "email") == 6
    more = spark.createDataFrame([("ID7", "New", "new@example.com", "x"), ("ID8", "Dup", "pelle@lindenpost.org", "y")], PEOPLE_SCHEMA)
    assert sinks.append_unseen(spark, more, target, "email") == 1
    assert spark.read.parquet(target).count() == 7
    from twinsift.operators.exact import exact_dedup

    sinks.rewrite_deduplicated(spark, target, lambda df: exact_dedup(df, ["email"]))
    assert spark.read.parquet(target).count() == 5


def test_bucketed_table_dedup_has_no_exchange(spark, sample):
    from twinsift.operators.exact import partitioned_dedup

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_bucketed(sample, "people_bucketed", ["name", "email"], buckets=4)
        t = spark.table("people_bucketed")
        plan = partitioned_dedup(t, ["name", "email"], 4)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 1
        from twinsift.operators.survivors import keep_one

        plan2 = keep_one(t, ["name", "email"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP TABLE IF EXISTS people_bucketed")


def _event_files(spark, sf_dir):
    folder = tempfile.mkdtemp(prefix="twinsift-events-")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ev.repartition(3, "event_id").write.mode("overwrite").parquet(f"{folder}/in")
    first = sorted(p for p in os.listdir(f"{folder}/in") if p.endswith(".parquet"))[0]
    # the first file again under another name: every row in it repeats
    with open(f"{folder}/in/{first}", "rb") as src, open(f"{folder}/in/again-{first}", "wb") as dst:
        dst.write(src.read())
    return folder, ev


def test_stream_dedup_equals_batch_and_restart_adds_nothing(spark):
    from tests.conftest import SF0001

    folder, ev = _event_files(spark, SF0001)
    stream = read_parquet_stream(spark, f"{folder}/in", ev.schema, max_files_per_trigger=1)
    keys = ["event_id"]
    out, ck = f"{folder}/out", f"{folder}/ck"
    run_available(within_watermark(stream, keys, "ts", "3650 days"), ck, path=out)
    got = spark.read.parquet(out)
    assert got.count() == ev.count() == got.select("event_id").distinct().count()
    run_available(within_watermark(read_parquet_stream(spark, f"{folder}/in", ev.schema), keys, "ts", "3650 days"), ck, path=out)
    assert spark.read.parquet(out).count() == ev.count()


def test_watermark_dedup_drops_late_rows(spark):
    import datetime as dt

    folder = tempfile.mkdtemp(prefix="twinsift-late-")
    schema = "k string, ts timestamp"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 10)), ("b", dt.datetime(2024, 1, 10))], schema).write.mode("append").parquet(f"{folder}/in")
    stream = read_parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
    run_available(within_watermark(stream, ["k"], "ts", "1 day"), f"{folder}/ck", path=f"{folder}/out")
    # a repeat of 'a' in time, and 'c' five days older than the watermark: both dropped
    spark.createDataFrame([("a", dt.datetime(2024, 1, 10, 1)), ("c", dt.datetime(2024, 1, 4))], schema).write.mode("append").parquet(f"{folder}/in")
    stream = read_parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
    run_available(within_watermark(stream, ["k"], "ts", "1 day"), f"{folder}/ck", path=f"{folder}/out")
    assert sorted(r.k for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b"]


def test_seen_table_sinks_equal_batch(spark):
    from tests.conftest import SF0001

    folder, ev = _event_files(spark, SF0001)
    keys = ["user_id", "event_type"]
    want = ev.select(*keys).distinct().count()
    t1 = f"{folder}/t1"
    run_available(read_parquet_stream(spark, f"{folder}/in", ev.schema, max_files_per_trigger=1), f"{folder}/ck1", sink=SeenTableSink(t1, keys, ["ts"]))
    got = spark.read.parquet(t1)
    assert got.count() == want == got.select(*keys).distinct().count()
    t2 = f"{folder}/t2"
    sink = BloomSeenTableSink(t2, "user_id", f"{folder}/filter", BloomSpec.for_items(2000, 0.01), ["ts"])
    run_available(read_parquet_stream(spark, f"{folder}/in", ev.schema, max_files_per_trigger=1), f"{folder}/ck2", sink=sink)
    got2 = spark.read.parquet(t2)
    assert got2.count() == ev.select("user_id").distinct().count() == got2.select("user_id").distinct().count()


def test_replayed_batches_append_nothing_twice(spark):
    """NULL is a key like any other; a batch that comes again adds nothing, and
    a crash between filter and append loses nothing."""
    folder = tempfile.mkdtemp(prefix="twinsift-replay-")
    one = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), (None, 4)], "k string, v int")
    two = spark.createDataFrame([(None, 5), ("a", 6), ("b", 7)], "k string, v int")
    rows = lambda t: sorted((tuple(r) for r in spark.read.parquet(t).collect()), key=str)
    want = sorted([(None, 1), ("a", 2), ("b", 7)], key=str)
    plain = SeenTableSink(f"{folder}/t1", ["k"], ["v"])
    bloomed = BloomSeenTableSink(f"{folder}/t2", "k", f"{folder}/f", BloomSpec.for_items(50, 0.01), ["v"])
    for sink in (plain, bloomed):
        for batch, number in ((one, 0), (one, 0), (two, 1), (two, 1)):
            sink(batch, number)
        assert rows(sink.target) == want
        assert not os.path.exists(f"{sink.target}.staged/batch=1")
    assert bloomed.newest(spark, 5) == 1 and not os.path.exists(f"{folder}/f/batch=0")
    # the filter of batch 2 is complete, but its rows never reached the target
    from twinsift.operators import bloom

    three = spark.createDataFrame([("c", 8), ("a", 9)], "k string, v int")
    filt = bloom.merge(spark.read.parquet(f"{folder}/f/batch=1"), bloom.build(three, "k", bloomed.spec))
    filt.write.parquet(f"{folder}/f/batch=2")
    bloomed(three, 2)
    assert rows(bloomed.target) == sorted([*want, ("c", 8)], key=str)
    # half a filter (no _SUCCESS) is not read
    os.makedirs(f"{folder}/f/batch=3")
    bloomed(spark.createDataFrame([("c", 10), ("d", 11)], "k string, v int"), 3)
    assert ("d", 11) in rows(bloomed.target) and len(rows(bloomed.target)) == 5


def test_registered_streams_run_several_batches(spark):
    from tests.conftest import SF0001
    from twinsift.registry import queries
    from twinsift.session import checkpoint_dir

    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    for name in ("stream_dedup", "stream_seen_table", "stream_bloom_seen_table"):
        assert queries()[name](spark, SF0001).count() > 0
    for folder in sorted(set(os.listdir(root)) - before):
        if folder.startswith("stream-"):
            commits = [c for c in os.listdir(f"{root}/{folder}/checkpoint/commits") if c.isdigit()]
            assert len(commits) >= 3, folder


def test_state_stores_follow_cores_and_input(spark):
    """Many shuffle partitions are not as many state stores, which each batch
    would commit one by one; rows and the session's setting stay."""
    import datetime as dt

    from twinsift.plans.sizing import input_bytes, state_stores
    from twinsift.registry import queries
    from twinsift.session import checkpoint_dir

    sf = tempfile.mkdtemp(prefix="twinsift-stores-")
    day = dt.datetime(2024, 3, 1)
    rows = [(i, day + dt.timedelta(minutes=17 * i), i % 9, "view" if i % 2 else "click", i / 4, None) for i in range(300)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/events.parquet")
    two_each = 2 * spark.sparkContext.defaultParallelism
    root, was = checkpoint_dir(spark).removeprefix("file:"), spark.conf.get("spark.sql.shuffle.partitions")
    before = set(os.listdir(root))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(two_each + 9))
        got = {name: queries()[name](spark, sf).collect() for name in ("stream_dedup", "stream_keyed_state")}
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(two_each + 9)
        # a larger input has more stores, up to the session's partitions
        size = input_bytes(spark, f"{sf}/events.parquet")
        assert state_stores(spark, f"{sf}/events.parquet") == two_each
        assert state_stores(spark, f"{sf}/events.parquet", size // (two_each + 3)) in (two_each + 3, two_each + 4)
        assert state_stores(spark, f"{sf}/events.parquet", 1) == two_each + 9
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert state_stores(spark, f"{sf}/events.parquet") == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(tuple(r) for r in got["stream_dedup"]) == rows
    first = {}
    for r in rows:
        first.setdefault((r[2], r[3]), r)
    assert sorted(tuple(r) for r in got["stream_keyed_state"]) == sorted(first.values())
    folders = [f for f in set(os.listdir(root)) - before if f.startswith(("stream-dedup-", "stream-state-"))]
    assert len(folders) == 2
    for folder in folders:
        assert len([x for x in os.listdir(f"{root}/{folder}/checkpoint/state/0") if x.isdigit()]) == two_each, folder


def test_file_arrival_stream(spark):
    root = _file_tree()
    folder = tempfile.mkdtemp(prefix="twinsift-arrivals-")
    target = f"{folder}/target"
    run_available(file_arrivals(spark, root, glob="*.txt"), f"{folder}/ck", sink=SeenTableSink(target, ["file_hash"], ["file_path"]))
    sizes = sorted(r.file_size for r in spark.read.parquet(target).collect())
    assert sizes == [0, len(b"same content\n"), len(b"other content\n")]  # the file without bytes too; sub/ is not listed
    # what comes later, below another folder, in another run; contents that are there already add nothing
    _write(f"{root}/d.txt", b"same content\n")
    _write(f"{root}/later.txt", b"later content\n")
    run_available(file_arrivals(spark, root, glob="*.txt"), f"{folder}/ck", sink=SeenTableSink(target, ["file_hash"], ["file_path"]))
    assert sorted(r.file_name for r in spark.read.parquet(target).collect())[-1] == "later.txt" and spark.read.parquet(target).count() == 4


def test_listing_is_split_by_folders(spark):
    from twinsift.sources.files import list_files, list_paths
    from twinsift.sources.listing import Lister, glob_pattern

    root = tempfile.mkdtemp(prefix="twinsift-listing-")
    for k in range(40):
        _write(f"{root}/d{k % 5}/e{k % 10}/f{k}.{'bin' if k % 2 else 'txt'}", b"x" * k)
    _write(f"{root}/top.txt", b"")
    _write(f"{root}/_hidden/no.txt", b"no")
    parts = Lister({"path": root, "recursive": "true", "want": "8"}).folders()
    assert len(parts) == 1 + 5 + 10 and sum(p.below for p in parts) == 10  # the folders of the third level go along whole
    got = {r.file_name: r.file_size for r in list_files(spark, root, recursive=True, want=8).collect()}
    assert got == {"top.txt": 0} | {f"f{k}.{'bin' if k % 2 else 'txt'}": k for k in range(40)}
    assert list_files(spark, root).count() == 1 and list_files(spark, root, glob="*.{bin,jpg}", recursive=True).count() == 20
    assert list_files(spark, f"{root}/nothing", recursive=True).count() == 0
    paths = [f"{root}/d1", f"{root}/d*/e[0-2]/*.txt", f"file://{root}/top.txt", f"{root}/gone.txt"]
    listed = {r.file_name for r in list_paths(spark, paths).collect()}
    assert listed == {"top.txt"} | {f"f{k}.txt" for k in range(40) if k % 10 in (0, 2) and k % 2 == 0}
    import re

    assert re.fullmatch(glob_pattern("a{b,c}?.{x,y}"), "acz.y") and not re.fullmatch(glob_pattern("*.{x,y}"), "a.z")


def test_keyed_state_lets_a_key_pass_once(spark):
    """Batches, restarts, NULL keys, values that pandas would change, repeats in one batch."""
    from twinsift.streaming.state import first_seen, keyed_state

    folder = tempfile.mkdtemp(prefix="twinsift-state-")
    schema = "k string, v long, w double, tags array<string>"
    empty = spark.createDataFrame([], schema)

    def arrive(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        with keyed_state(spark):
            run_available(first_seen(read_parquet_stream(spark, f"{folder}/in", empty.schema), ["k"], ["v"]), f"{folder}/ck", path=f"{folder}/out")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    arrive([("a", 2**60 + 1, 0.5, ["x"]), ("a", 2**60, None, None), (None, 7, float("nan"), []), (None, 7, 1.5, []), ("b", None, 1.0, None), ("b", 1, 1.0, None)])
    arrive([("a", 1, 0.0, None), (None, 1, 0.0, None), ("c", 3, 0.1, ["y", None])])
    arrive([("c", 1, 0.0, None)])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = {r.k: (r.v, r.w, r.tags) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {"a": (2**60, None, None), None: (7, 1.5, []), "b": (None, 1.0, None), "c": (3, 0.1, ["y", None])}
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_keyed_state_forgets_after_its_time(spark):
    import time

    from twinsift.streaming.state import first_seen, keyed_state

    folder = tempfile.mkdtemp(prefix="twinsift-ttl-")
    schema = spark.createDataFrame([], "k string, v long").schema

    def arrive(rows, ttl):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        with keyed_state(spark):
            run_available(first_seen(read_parquet_stream(spark, f"{folder}/in", schema), ["k"], ["v"], ttl_seconds=ttl), f"{folder}/ck", path=f"{folder}/out")

    arrive([("a", 1)], 3)
    time.sleep(4)
    arrive([("a", 2), ("b", 1)], 3)  # a is forgotten, and passes again
    assert sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_sink_does_not_shuffle_the_target(spark):
    """A batch of the sink: the target's keys meet the batch's by a broadcast
    (of the batch's), and only what is left of them is shuffled."""
    folder = tempfile.mkdtemp(prefix="twinsift-sinkplan-")
    target = f"{folder}/target"
    spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).write.parquet(target)
    batch = spark.createDataFrame([("7", 1), (None, 2), ("x", 3)], "k string, v long")
    new = SeenTableSink(target, ["k"], ["v"]).new_rows(batch)
    assert sorted((r.k is None, r.k) for r in new.collect()) == [(False, "x"), (True, None)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    # from the semi join down to the scan of the target there is no exchange
    semi = final.index("LeftSemi")
    assert "BroadcastHashJoin" in final[semi - 200 : semi]
    assert "Exchange" not in final[semi : final.index("FileScan parquet", semi)].replace("BroadcastExchange", "")


def test_append_unseen_takes_null_for_a_key(spark):
    folder = tempfile.mkdtemp(prefix="twinsift-append-")
    new = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    added = [sinks.append_unseen(spark, new, f"{folder}/t", "k") for _ in range(3)]
    assert added == [2, 0, 0] and spark.read.parquet(f"{folder}/t").count() == 2


def test_rewrite_survives_a_crash_at_each_step(spark, monkeypatch):
    """After a crash at any step the old or the new table is whole once
    ``recover_rewrite`` has run; before it, one of them is somewhere."""
    import pytest

    from twinsift.operators.exact import exact_dedup

    steps = {"rename_path": 2, "remove_path": 2, "write_marker": 1, "write_parquet": 1}
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    fields = lambda p: sorted((r.k or "", r.v) for r in spark.read.parquet(p).collect())
    old, new = [("", 4), ("a", 1), ("a", 2), ("b", 3)], [("", 4), ("a", 1), ("b", 3)]
    seen = set()
    for name, times in steps.items():
        for nth in range(1, times + 1):
            for after in (False, True):
                path = f"{tempfile.mkdtemp(prefix='twinsift-swap-')}/t"
                sinks.write_parquet(rows, path)
                real, calls = getattr(sinks, name), []

                def broken(*args, real=real, calls=calls, nth=nth, after=after, **how):
                    calls.append(1)
                    if len(calls) == nth:
                        if after:
                            real(*args, **how)
                        raise RuntimeError("crash")
                    return real(*args, **how)

                with monkeypatch.context() as m:
                    m.setattr(sinks, name, broken)
                    with pytest.raises(RuntimeError):
                        sinks.rewrite_deduplicated(spark, path, lambda df: exact_dedup(df, ["k"], order_by=["v"]))
                said = sinks.recover_rewrite(spark, path)
                seen.add(said)
                assert fields(path) == (new if said == "finished" else old if said == "undone" else fields(path)), (name, nth, after)
                assert fields(path) in (old, new)
                assert sorted(os.listdir(os.path.dirname(path))) == ["t"], (name, nth, after)
                assert sinks.recover_rewrite(spark, path) == "clean"
                sinks.rewrite_deduplicated(spark, path, lambda df: exact_dedup(df, ["k"], order_by=["v"]))
                assert fields(path) == new
    assert {"undone", "finished"} <= seen
